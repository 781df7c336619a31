"""The five-minute activity count on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnfeatures.functions.scalar import epoch_seconds, time_bucket
from txnfeatures.schema import BUCKET_SECONDS


def stream_velocity(stream: DataFrame, ts: str, watermark: str = "10 minutes") -> DataFrame:
    """Rows per five-minute window, emitted once the watermark has passed it.

    Rows later than the watermark are dropped; on ordered input the closed
    windows equal the batch bucket counts.  Watermarks need an instant, so a
    ``timestamp_ntz`` is read as UTC, whatever the session time zone.
    """
    instant = F.col(ts)
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        instant = F.timestamp_seconds(epoch_seconds(ts))
    windows = (
        stream.select(instant.alias("instant"))
        .withWatermark("instant", watermark)
        .groupBy(F.window("instant", f"{BUCKET_SECONDS} seconds"))
        .agg(F.count("*").alias("txn_count_5m"))
    )
    return windows.select(time_bucket(epoch_seconds("window.start")).alias("bucket_5m"), "txn_count_5m")
