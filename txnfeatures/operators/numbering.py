"""Numbers along an order, without a sort of all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnfeatures.sources.writers import scratch_uri


def numbered(df: DataFrame, order: list[str | Column], name: str = "number") -> DataFrame:
    """Add ``name``: 0, 1, 2, ... along ``order`` (ties in any order, but once and for all).

    Rows are sorted by ranges and stored; a range then needs only the number of
    rows before it, and there is one row for each range to add those up.
    """
    spark = df.sparkSession
    uri = scratch_uri(spark, "numbered")
    df.orderBy(*order).withColumn("_placed", F.monotonically_increasing_id()).write.parquet(uri)
    placed = spark.read.schema(df.withColumn("_placed", F.lit(0).cast("bigint")).schema).parquet(uri)
    part = F.shiftright("_placed", 33)  # the task that wrote the row; its rows count from 0
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    out = placed.withColumn("_part", part).join(F.broadcast(sizes), "_part")  # as many rows as tasks
    inside = F.col("_placed").bitwiseAND(F.lit((1 << 33) - 1))
    return out.withColumn(name, inside + F.col("_ahead")).drop("_part", "_placed", "_ahead")
