"""How far training and scoring features of the same rows are apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnfeatures.schema import FEATURE_COLS


def train_serve_report(
    df: DataFrame,
    train: Callable[[DataFrame], DataFrame],
    serve: Callable[[DataFrame], DataFrame],
    columns: list[str] = FEATURE_COLS,
) -> DataFrame:
    """One row per feature: mean and missing values of both plans over ``df``, and the gap of the means.

    The two plans differ on purpose in some features; a gap elsewhere is a
    mistake.  One aggregate per plan; nothing is joined.
    """

    def summary(features: DataFrame, name: str) -> DataFrame:
        values = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns]
        long = features.select(F.explode(F.array(*values)).alias("v")).select("v.feature", F.nanvl("v.x", F.lit(None)).alias("x"))
        return long.groupBy("feature").agg(F.avg("x").alias(f"{name}_mean"), F.count_if(F.col("x").isNull()).alias(f"{name}_missing"))

    both = summary(train(df), "train").join(summary(serve(df), "serve"), "feature")
    return both.withColumn("gap", F.abs(F.col("train_mean") - F.col("serve_mean")))
