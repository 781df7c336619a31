"""Fitted statistics: dataset-wide amounts, per-user amounts, bucket counts."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnfeatures.functions.cleaning import coerce_double
from txnfeatures.functions.scalar import as_double, time_bucket
from txnfeatures.operators.joins import attach_by_key
from txnfeatures.operators.quantiles import SKETCH_ACCURACY, _present, quantiles_with_counts
from txnfeatures.schema import BUCKET_SECONDS


@dataclass(frozen=True)
class AmountStats:
    """Dataset-wide amount statistics, after the fallbacks.  ``n`` is the
    number of rows with an amount, ``rows`` of all rows."""

    mean: float
    std: float
    p95: float
    n: int
    rows: int

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([asdict(self)], "mean double, std double, p95 double, n bigint, rows bigint")

    @classmethod
    def from_df(cls, df: DataFrame) -> "AmountStats":
        return cls(**df.select("mean", "std", "p95", "n", "rows").first().asDict())


def fit_amount_stats(df: DataFrame, amount: str = "Amount", method: str = "disc", fill: float | None = None) -> AmountStats:
    """Mean, sample deviation and 95th percentile of an amount column.

    ``method`` is one of ``disc`` (exact, the default), ``linear``, ``approx``
    and ``gk``.  A missing or zero deviation becomes 1, a missing or zero
    percentile twice the mean.  The scoring side passes ``fill=0`` for
    unreadable amounts and keeps a zero percentile.
    """
    values = df.select((as_double(amount) if fill is None else coerce_double(amount, fill)).alias("amount"))
    x = _present("amount")
    aggs = [F.count("*").alias("rows"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std")]
    if method in SKETCH_ACCURACY:
        aggs.append(F.percentile_approx(x, 0.95, SKETCH_ACCURACY[method]).alias("p95"))
    row = values.agg(*aggs).first()
    p95 = (
        row["p95"]
        if method in SKETCH_ACCURACY
        else quantiles_with_counts(values, {"amount": 0.95}, {"amount": row["n"]}, method)["amount"]
    )
    mean = row["mean"] or 0.0
    return AmountStats(mean=mean, std=row["std"] or 1.0, p95=p95 or (mean * 2 if fill is None else 0.0), n=row["n"], rows=row["rows"])


# -- per user ---------------------------------------------------------------

USER_VALUES = ["user_mean_amount", "user_std_amount", "user_txn_count"]


def user_stats(df: DataFrame, user: str, amount: str = "Amount") -> DataFrame:
    """Mean, sample deviation and row count per user, null user included."""
    x = as_double(amount)
    return df.groupBy(user).agg(
        F.avg(x).alias("user_mean_amount"),
        F.stddev_samp(x).alias("user_std_amount"),
        F.count("*").alias("user_txn_count"),
    )


def user_stats_serving(df: DataFrame, user: str, amount: str = "Amount") -> DataFrame:
    """The scoring side: counts readable amounts only, a missing deviation is
    1, and rows without a user form no group."""
    x = coerce_double(amount, None)
    return (
        df.where(F.col(user).isNotNull())
        .groupBy(user)
        .agg(
            F.avg(x).alias("user_mean_amount"),
            F.coalesce(F.stddev_samp(x), F.lit(1.0)).alias("user_std_amount"),
            F.count(x).alias("user_txn_count"),
            F.count("*").alias("user_rows"),
        )
    )


def attach_user_stats(
    df: DataFrame,
    user: str,
    amount: str = "Amount",
    stats: DataFrame | None = None,
    total: int | None = None,
    salts: int = 1,
) -> DataFrame:
    """Left join the per-user table; rows without a user keep null values."""
    stats = user_stats(df, user, amount) if stats is None else stats
    weight = "user_rows" if "user_rows" in stats.columns else "user_txn_count"
    return attach_by_key(df, stats, user, weight, USER_VALUES, total, salts)


# -- per five-minute bucket ---------------------------------------------------


def bucket_counts(df: DataFrame, seconds: str, width: int = BUCKET_SECONDS) -> DataFrame:
    return (
        df.groupBy(time_bucket(seconds, width).alias("bucket_5m")).agg(F.count("*").alias("txn_count_5m"))
    )


def attach_velocity(
    df: DataFrame,
    seconds: str,
    counts: DataFrame | None = None,
    width: int = BUCKET_SECONDS,
    total: int | None = None,
) -> DataFrame:
    """Left join the number of rows in the same time bucket; null time stays null."""
    counts = bucket_counts(df, seconds, width) if counts is None else counts
    keyed = df.withColumn("bucket_5m", time_bucket(seconds, width))
    return attach_by_key(keyed, counts, "bucket_5m", "txn_count_5m", ["txn_count_5m"], total).drop("bucket_5m")
