"""Writing features, scores and metrics."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the session names for checkpoints.

    Where none is named it lies in the warehouse.  A warehouse in a folder of the
    driver's machine is refused on a cluster: executors would not share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        if root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, uri: str) -> None:
    """Delete what was written to a scratch path; nothing happens where there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A scratch path that is deleted on the way out: for tables needed only until a result is stored."""
    uri = scratch_uri(spark, name)
    try:
        yield uri
    finally:
        discard(spark, uri)


def write_features(
    df: DataFrame, uri: str, mode: str = "overwrite", dynamic: bool = False, rebalance: bool = False
) -> dict:
    """Parquet partitioned by source; returns row and fraud counts.

    The counts are observed on the write itself instead of by further jobs.
    ``dynamic`` replaces only the sources present in ``df``.  ``rebalance``
    pays one shuffle for files of even size: adaptive execution merges small
    pieces and splits a source that holds most of the rows.
    """
    seen = Observation()
    if rebalance:
        df = df.hint("rebalance", F.col("source"))
    out = df.observe(seen, F.count("*").alias("rows"), F.coalesce(F.sum("label"), F.lit(0)).alias("fraud"))
    writer = out.write.mode(mode).partitionBy("source")
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(uri)
    return seen.get


def write_scores(df: DataFrame, uri: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(uri)


def write_metrics(df: DataFrame, uri: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(uri)


def replicate(spark: SparkSession, uris: list[str], write: Callable[[str], int | None]) -> DataFrame:
    """``write`` to a primary and further locations.

    A failure of the primary is raised; later ones are reported in the returned
    status rows ``(uri, rows, ok, error)``.
    """
    status = []
    for i, uri in enumerate(uris):
        try:
            status.append((uri, write(uri), True, None))
        except Exception as e:
            if i == 0:
                raise
            status.append((uri, None, False, _reason(e)))
    return spark.createDataFrame(status, "uri string, rows bigint, ok boolean, error string")


def _reason(e: Exception) -> str:
    cause = getattr(e, "java_exception", None)
    return (str(e if cause is None else cause.toString()).splitlines() or [type(e).__name__])[0]


def fingerprint(df: DataFrame) -> tuple[Column, Column, Column]:
    """Aggregates that tell tables apart whatever the order of their rows: row count, sum and exclusive or of row hashes.

    Repeated rows count as often as they are there: a pair of equal rows cancels
    in the exclusive or but not in the sum.  Columns take part in order of name,
    with their nulls; a map is hashed as its sorted entries.  An empty table has
    sum and exclusive or 0.  Needs no shuffle beyond one row per task.
    """
    values = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        c = F.col("`" + f.name.replace("`", "``") + "`")
        # A hash passes over nulls, so that a null in one column and in the next would look alike.
        values += [c.isNull(), F.array_sort(F.map_entries(c)) if isinstance(f.dataType, T.MapType) else c]
    row = F.xxhash64(*values) if values else F.lit(0).cast("bigint")
    total = F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("string")
    return F.count("*").alias("rows"), total.alias("sum"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("xor")


def check_replicas(spark: SparkSession, uris: list[str], schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Reads every copy once and compares it with the first: ``(uri, rows, same, error)``.

    ``same`` is whether the copy holds the rows of the first location, repeated
    ones as often, in any order; null where a copy cannot be read.
    """

    def seen(uri: str):
        # The schema in force is the one of the data, so a copy of other columns is no copy of these.
        stored = spark.read.schema(schema).format(fmt).load(uri)
        return stored.agg(*fingerprint(stored)).first()

    first, status = seen(uris[0]), []
    for i, uri in enumerate(uris):
        try:
            mine = seen(uri) if i else first
            status.append((uri, mine["rows"], mine == first, None))
        except Exception as e:
            status.append((uri, None, None, _reason(e)))
    return spark.createDataFrame(status, "uri string, rows bigint, same boolean, error string")


def write_replicated(df: DataFrame, uris: list[str], fmt: str = "parquet") -> DataFrame:
    """The same rows to several locations.

    ``df`` is computed for the primary only; the others are copied from what
    was stored there, which needs no cache to survive a lost executor.  A copy is
    ``ok`` only if the rows read back for it have the fingerprint of the rows
    given; formats without types of their own may store other values than they
    were given, so only self-describing ones are held to it.  ``check_replicas``
    reads what lies at every location.
    """
    spark, first = df.sparkSession, {}
    typed = fmt in ("parquet", "orc", "avro")

    def write(uri: str) -> int:
        rows = df if uri == uris[0] else spark.read.schema(df.schema).format(fmt).load(uris[0])
        seen = Observation()
        rows.observe(seen, *fingerprint(rows)).write.mode("overwrite").format(fmt).save(uri)
        found = seen.get
        if first.setdefault("found", found) != found and typed:
            raise ValueError(f"rows read from {uris[0]} are not the rows written there")
        return found["rows"]

    return replicate(spark, uris, write)
