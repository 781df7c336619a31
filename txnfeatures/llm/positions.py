"""Running totals over keys that are numbers, without sorting all of them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def running(df: DataFrame, key: str, value: str, out: str, width: int = 4096) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows with a smaller ``key`` (bigint from 0, one row each).

    Two levels: totals of ``width`` neighbouring keys first, so the one window
    over all of them has a ``width``-th of the rows.
    """
    span = F.expr(f"`{key}` DIV {width}")
    totals = df.groupBy(span.alias("_span")).agg(F.sum(value).alias("_sum"))
    before = W.orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("_span", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_ahead"))
    inside = W.partitionBy("_span").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    return (
        df.withColumn("_span", span)
        .withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(totals, "_span")
        .withColumn(out, F.col("_ahead") + F.col("_inside"))
        .drop("_span", "_ahead", "_inside")
    )
