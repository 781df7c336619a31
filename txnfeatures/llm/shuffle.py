"""A global shuffle of documents into shards in two passes.

Pass one scatters rows into buckets by a seeded hash of id and text, so that a
bucket fits into memory whatever the table's size; pass two puts each bucket
into a canonical order, shuffles it (Fisher-Yates, seeded by the bucket) and
writes it.  Buckets laid end to end are the shuffled order.  A shard is a
contiguous stretch of that order, so a bucket is written to one or two shards.

Repeating a task gives the same rows in the same order: nothing depends on
arrival.  Rows equal in id and text share a bucket, so those alone are assumed to fit into memory.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnfeatures.llm.positions import running
from txnfeatures.llm.store import stored
from txnfeatures.sources.writers import scratch_uri

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text of a bucket, and about how many a task deals.
BUCKET_BYTES, TASK_BYTES = 8 << 20, 32 << 20


def _deal(seed: int):
    def deal(rows: pa.Table, place: pa.Table) -> pa.Table:
        bucket, before = place.column("_bucket")[0].as_py(), place.column("_before")[0].as_py()
        order = np.array(pc.sort_indices(rows, sort_keys=[("_hash", "ascending")]))
        # Generator.shuffle is Fisher-Yates.
        np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
        rows = rows.take(pa.array(order)).drop_columns(["_hash", "_bucket"])
        return rows.append_column("_at", pa.array(before + np.arange(len(rows)), pa.int64()))

    return deal


def shuffle_into_shards(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 17,
    bucket_bytes: int = BUCKET_BYTES,
    uri: str | None = None,
) -> DataFrame:
    """Write ``docs`` to ``uri`` as Parquet in folders ``shard=0 ...`` and return what was written.

    All columns stay; ``shard`` and ``slot`` (place in the shard, from 0) are
    added and replace columns of these names.  Numbers of rows differ by at most
    one between shards.  Null ids and texts are hashed as such; rows that share
    an id or are equal are all kept.  An empty table gives an empty result.
    """
    docs = docs.drop("shard", "slot")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + 1
    total = docs.agg(F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    buckets = max(1, -(-total["bytes"] // bucket_bytes))
    # The row travels as one struct, so no name of a column can clash with those needed here.
    hashed = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64(F.lit(seed), id_col, text_col).alias("_hash"))
    hashed = hashed.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "_hash"), F.lit(buckets)))
    counts = stored(hashed.groupBy("_bucket").agg(F.count("*").alias("_rows")), "buckets")
    places = running(counts, "_bucket", "_rows", "_before").drop("_rows")
    schema = T.StructType([T.StructField("_row", docs.schema), T.StructField("_at", T.LongType())])
    # Tasks follow the data, not a setting: some buckets each, one of them in memory at a time.
    parallelism = docs.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-total["bytes"] // max(TASK_BYTES, bucket_bytes)), min(buckets, 2 * parallelism))
    left, right = (df.repartition(tasks, "_bucket").groupBy("_bucket") for df in (hashed, places))
    dealt = left.cogroup(right).applyInArrow(_deal(seed), schema)
    small, longer = divmod(total["rows"], shards)
    edge = longer * (small + 1)
    # The first ``longer`` shards have a row more than the others.
    least = max(small, 1)
    shard = F.expr(f"IF(_at < {edge}, _at DIV {small + 1}, {longer} + (_at - {edge}) DIV {least})").cast("int")
    slot = F.expr(f"IF(_at < {edge}, _at % {small + 1}, (_at - {edge}) % {least})")
    out = dealt.select("_row.*", shard.alias("shard"), slot.cast("bigint").alias("slot"))
    uri = uri or scratch_uri(docs.sparkSession, "shards")
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(uri)
    return docs.sparkSession.read.schema(out.schema).parquet(uri)
