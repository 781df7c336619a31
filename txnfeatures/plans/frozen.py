"""Statistics fitted once, stored, and used again.

Stored tables have known sizes, so Spark chooses their joins by what they
really hold, and scoring or streaming jobs start from them without touching the
training data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from txnfeatures.functions import scalar as S
from txnfeatures.operators.stats import AmountStats, bucket_counts, fit_amount_stats, user_stats
from txnfeatures.schema import SourceSpec


@dataclass
class FrozenStats:
    amount: AmountStats
    users: DataFrame | None
    buckets: DataFrame

    def for_training(self) -> dict:
        """Arguments for ``build_features``."""
        return {"amount_stats": self.amount, "user_table": self.users, "bucket_table": self.buckets}

    def for_scoring(self) -> dict:
        """Arguments for ``extract_features_serving`` and ``score_source``."""
        return {"amount_stats": self.amount, "user_table": self.users}


def freeze_stats(df: DataFrame, spec: SourceSpec, uri: str, method: str = "disc") -> FrozenStats:
    """Fit the statistics of one dataset and store them under ``uri``."""
    spark = df.sparkSession
    fit_amount_stats(df, spec.amount, method).to_df(spark).write.mode("overwrite").parquet(f"{uri}/amount")
    if spec.user:
        user_stats(df, spec.user, spec.amount).write.mode("overwrite").parquet(f"{uri}/users")
    seconds = S.as_double(spec.time) if spec.time_kind == "numeric" else S.epoch_seconds(S.parse_ts(spec.time))
    counts = bucket_counts(df.select(seconds.alias("seconds")), "seconds")
    counts.write.mode("overwrite").parquet(f"{uri}/buckets")
    return load_stats(spark, spec, uri)


def load_stats(spark: SparkSession, spec: SourceSpec, uri: str) -> FrozenStats:
    return FrozenStats(
        amount=AmountStats.from_df(spark.read.parquet(f"{uri}/amount")),
        users=spark.read.parquet(f"{uri}/users") if spec.user else None,
        buckets=spark.read.parquet(f"{uri}/buckets"),
    )
