"""Feature engineering with training semantics."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnfeatures.functions import cleaning as C
from txnfeatures.functions import scalar as S
from txnfeatures.operators.ranks import with_percent_rank
from txnfeatures.operators.stats import (
    AmountStats,
    attach_user_stats,
    attach_velocity,
    bucket_counts,
    fit_amount_stats,
    user_stats,
)
from txnfeatures.schema import (
    CARD_FRAUD,
    CREDITCARD,
    FINANCIAL,
    PCA_COLS,
    UNIVERSAL_TYPES,
    UNIVERSAL_TYPES_V1,
    SourceSpec,
)
from txnfeatures.sources.readers import read_source

# -- feature groups -----------------------------------------------------------


def _amount_exprs(amount, stats: AmountStats) -> dict:
    return {
        "log_amount": S.log_amount(amount),
        "amount_z": S.zscore(amount, F.lit(stats.mean), F.lit(stats.std)),
        "is_high_amount": S.high_flag(amount, F.lit(stats.p95)),
    }


def _clock_exprs(hour) -> dict:
    return {
        "hour": hour,
        "hour_sin": S.hour_sin(hour),
        "hour_cos": S.hour_cos(hour),
        "is_night": S.night_flag(hour),
    }


def _calendar_exprs(ts) -> dict:
    dow = S.day_of_week(ts)
    return {"day_of_week": dow, "is_weekend": S.weekend_flag(dow), "txn_month": S.month(ts)}


def _pca_exprs(cols) -> dict:
    return {"pca_l2": S.pca_l2(cols), "pca_max_abs": S.pca_max_abs(cols), "pca_mean": S.pca_mean(cols)}


def add_amount_features(
    df: DataFrame, amount: str = "Amount", stats: AmountStats | None = None, version: str = "v2", method: str = "disc"
) -> DataFrame:
    """Log, z-score and high flag; ``version="v1"`` adds the global rank."""
    stats = stats or fit_amount_stats(df, amount, method)
    out = df.withColumns(_amount_exprs(amount, stats))
    return with_percent_rank(out, amount) if version == "v1" else out


def add_time_features_numeric(df: DataFrame, time: str, with_year: bool = False) -> DataFrame:
    """Clock features of seconds since the start; the calendar is unknown."""
    exprs = {**_clock_exprs(S.hour_fraction(S.as_double(time))), **C.constants("calendar")}
    if with_year:
        exprs["txn_year"] = S.txn_year()
    return df.withColumns(exprs)


def add_time_features_datetime(df: DataFrame, time: str, with_year: bool = False) -> DataFrame:
    """Clock and calendar features, and ``ts`` as epoch seconds."""
    ts = S.parse_ts(time)
    seconds = S.epoch_seconds(ts)
    exprs = {"ts": seconds, **_clock_exprs(S.hour_fraction(seconds)), **_calendar_exprs(ts)}
    if with_year:
        exprs["txn_year"] = S.txn_year(seconds)
    return df.withColumns(exprs)


def add_user_features(df: DataFrame, user: str, amount: str = "Amount", stats: DataFrame | None = None) -> DataFrame:
    return attach_user_stats(df, user, amount, stats).withColumn(
        "user_amount_z", S.user_amount_z(amount, "user_mean_amount", "user_std_amount")
    )


def add_velocity_features(df: DataFrame, seconds: str, counts: DataFrame | None = None) -> DataFrame:
    return attach_velocity(df, seconds, counts)


def add_pca_features(df: DataFrame, cols: list[str] = PCA_COLS) -> DataFrame:
    return df.withColumns(_pca_exprs(cols))


# -- whole datasets -----------------------------------------------------------


def build_features(
    df: DataFrame,
    spec: SourceSpec,
    amount_stats: AmountStats | None = None,
    user_table: DataFrame | None = None,
    bucket_table: DataFrame | None = None,
    version: str = "v2",
    method: str = "disc",
) -> DataFrame:
    """All universal features of one dataset.

    Only what the joins and the row-local features need travels through the
    shuffles: the components are folded to three numbers before, everything
    computable from amount, time and the joined values is added after.  Frozen
    tables may be passed in place of statistics of ``df`` itself.
    """
    narrow = {"amount": S.as_double(spec.amount), "raw_label": C.label(spec.label, spec.label_kind)}
    if spec.time_kind == "numeric":
        narrow["seconds"] = S.as_double(spec.time)
    else:
        narrow["clock"] = S.parse_ts(spec.time)
        narrow["seconds"] = S.epoch_seconds(narrow["clock"])
    if spec.user:
        narrow["user"] = F.col(spec.user)
    if spec.pca:
        narrow.update(_pca_exprs(spec.pca))
    base = df.select(*[e.alias(c) for c, e in narrow.items()])

    rows = None  # of ``base``, when fitting tells
    if amount_stats is None:
        amount_stats = fit_amount_stats(base, "amount", method)
        rows = amount_stats.rows
    out = base
    if version == "v1":
        out = with_percent_rank(out, "amount")
    # A table made of ``base`` weighs as many rows as ``base`` has; the total
    # weight of a frozen one is summed where it is attached.
    if spec.user:
        own = user_table is None
        users = user_stats(base, "user", "amount") if own else user_table.withColumnRenamed(spec.user, "user")
        out = attach_user_stats(out, "user", "amount", users, rows if own else None)
    own = bucket_table is None
    buckets = bucket_counts(base, "seconds") if own else bucket_table
    out = attach_velocity(out, "seconds", buckets, total=rows if own else None)

    exprs = {**_amount_exprs("amount", amount_stats), **_clock_exprs(S.hour_fraction("seconds"))}
    exprs |= C.constants("calendar") if spec.time_kind == "numeric" else _calendar_exprs("clock")
    exprs |= (
        {"user_amount_z": S.user_amount_z("amount", "user_mean_amount", "user_std_amount")}
        if spec.user
        else C.constants("user")
    )
    if not spec.pca:
        exprs |= C.constants("pca")
    exprs |= {"label": F.col("raw_label"), "source": F.lit(spec.name)}
    types = UNIVERSAL_TYPES_V1 if version == "v1" else UNIVERSAL_TYPES
    return C.select_universal(out.withColumns(exprs), types)


def features_financial(df: DataFrame, **options) -> DataFrame:
    return build_features(C.rename_ci(df, FINANCIAL.renames), FINANCIAL, **options)


def features_creditcard(df: DataFrame, **options) -> DataFrame:
    return build_features(df, CREDITCARD, **options)


def features_card_fraud(df: DataFrame, **options) -> DataFrame:
    return build_features(df, CARD_FRAUD, **options)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of frames in the universal contract."""
    return reduce(DataFrame.unionByName, frames)


def universal_features(financial: DataFrame, creditcard: DataFrame, card_fraud: DataFrame, **options) -> DataFrame:
    """The combined feature table of the three training datasets.

    Each dataset is fitted by a few short jobs; those of different datasets are
    submitted side by side so that they share the cluster.
    """
    parts = [(features_financial, financial), (features_creditcard, creditcard), (features_card_fraud, card_fraud)]
    build = inheritable_thread_target(financial.sparkSession)(lambda part: part[0](part[1], **options))
    with ThreadPoolExecutor(len(parts)) as pool:
        return union_sources(list(pool.map(build, parts)))


def universal_features_v1(financial: DataFrame, creditcard: DataFrame, card_fraud: DataFrame, method: str = "gk") -> DataFrame:
    """First contract version: global amount rank, coarser quantile sketch."""
    return universal_features(financial, creditcard, card_fraud, version="v1", method=method)


def universal_features_from(spark: SparkSession, financial: str, creditcard: str, card_fraud: str, **options) -> DataFrame:
    """The same from CSV locations."""
    return universal_features(
        *[read_source(spark, s.at(u)) for s, u in ((FINANCIAL, financial), (CREDITCARD, creditcard), (CARD_FRAUD, card_fraud))],
        **options,
    )
