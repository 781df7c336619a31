"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from txnfeatures.sources.writers import discard, scratch_uri


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write to the shared folder and read back: later steps start from files every executor can reach."""
    uri = scratch_uri(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


#: Rows of whole texts that go to a Python worker at once: some MB, where Spark's 10,000 are tens of them.
BATCH = 2048


def text_batches(spark: SparkSession, rows: int = BATCH) -> None:
    """Let the session hand rows to Python workers in batches that suit whole texts; smaller settings stay."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


@contextmanager
def wide_rows(spark: SparkSession, rows: int = 32) -> Iterator[None]:
    """For jobs on rows of some 100 KB: readers and Python workers get that many at once, not thousands."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.set(name, str(rows))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Run:
    """The tables of one run, in a folder of their own; a name may be stored again and again."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.uri, self.paths = spark, scratch_uri(spark, name), {}

    def stored(self, df: DataFrame, name: str, **facts: Column) -> DataFrame | tuple[DataFrame, dict]:
        """As :func:`stored`; with ``facts`` (aggregates of the rows) also what they came to on the write."""
        found = Observation() if facts else None
        if facts:
            df = df.observe(found, *[c.alias(k) for k, c in facts.items()])
        paths = self.paths.setdefault(name, [])
        paths.append(f"{self.uri}/{name}-{len(paths)}")
        df.write.parquet(paths[-1])
        out = self.spark.read.schema(df.schema).parquet(paths[-1])
        return (out, found.get) if facts else out

    def discard(self, *names: str) -> None:
        """Delete tables that nothing reads any more; of a name stored more than once, all."""
        for name in names:
            for path in self.paths.pop(name, []):
                discard(self.spark, path)
