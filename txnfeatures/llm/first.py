"""The first rows of every group, where a group may hold most of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

PARTS = 256


def first_rows(df: DataFrame, by: str, order: list, most: int) -> DataFrame:
    """The first ``most`` rows of each ``by``, with their ``rank`` from 1.

    A task sorts a part of a group; then one sorts the parts' first rows, of
    which there are ``PARTS * most`` at most.  ``order`` has to tell rows apart.
    """
    part = F.pmod(F.xxhash64(*df.columns), F.lit(PARTS))
    ahead = df.withColumn("_part", part).withColumn("_n", F.row_number().over(W.partitionBy(by, "_part").orderBy(*order)))
    ahead = ahead.where(F.col("_n") <= most).drop("_part", "_n")
    return ahead.withColumn("rank", F.row_number().over(W.partitionBy(by).orderBy(*order))).where(F.col("rank") <= most)
