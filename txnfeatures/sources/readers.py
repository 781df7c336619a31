"""Reading transactions and stored features."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnfeatures.functions.cleaning import rename_ci
from txnfeatures.schema import SourceSpec

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_csv(spark: SparkSession, uri: str, types: str | None = None, mixed_headers: bool = False) -> DataFrame:
    """CSV with a header.

    With ``types`` (a DDL list) only a header line is looked at first: listed
    columns get their types by name, in whatever order the files have them, and
    others are text.  Without, types are inferred, which reads all text once more.

    All files must have the same header: a file that differs fails the read, it
    is never taken by position.  ``mixed_headers`` takes the header line of every
    file in one job and joins files of different headers by name, one read for
    each header; a column that a file lacks is null there, an empty file is passed over.
    """
    layouts = header_census(spark, uri) if mixed_headers else []
    if layouts:
        return concat_by_name([_one_layout(spark, paths, types) for paths in layouts])
    return _one_layout(spark, uri, types)


def header_census(spark: SparkSession, uri: str) -> list[list[str]]:
    """The files under ``uri`` grouped by their header line, in order of their first file.

    A task opens one whole file and stops at its first line that is not blank, so
    the job reads the start of each file, whatever its size.  What comes to the driver are the
    paths, which a reader's own file index lists there as well.
    """
    whole = {"spark.sql.files.maxPartitionBytes": str(1 << 40), "spark.sql.files.openCostInBytes": str(1 << 40)}
    before = {name: spark.conf.get(name) for name in whole}
    for name, value in whole.items():
        spark.conf.set(name, value)
    try:
        lines = spark.read.option("recursiveFileLookup", True).text(uri).where("_metadata.file_block_start = 0").select("value", "_metadata.file_path")
        heads = lines.mapInArrow(_first_lines, "header string, path string")
        grouped = heads.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return sorted(row["paths"] for row in grouped)


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for line, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if line.strip():
                yield pa.RecordBatch.from_pydict({"header": [line], "path": [unquote(path)]})
                return


def _one_layout(spark: SparkSession, uri: str | list[str], types: str | None) -> DataFrame:
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if types is None:
        return reader.option("inferSchema", True).csv(uri)
    known = {f.name.lower(): f.dataType for f in T.StructType.fromDDL(types)}
    header = reader.csv(uri).columns
    schema = T.StructType([T.StructField(c, known.get(c.lower(), T.StringType())) for c in header])
    return reader.schema(schema).csv(uri)


def read_source(spark: SparkSession, spec: SourceSpec, mixed_headers: bool = False) -> DataFrame:
    """One dataset as its spec describes it, column names normalised.

    Plain text is split by ``spark.sql.files.maxPartitionBytes`` already, so
    ``repartition`` is for inputs that cannot be split.
    """
    df = rename_ci(read_csv(spark, spec.uri, spec.types, mixed_headers), spec.renames)
    return df.repartition(spec.repartition) if spec.repartition else df


def read_features(spark: SparkSession, uri: str, sources: list[str] | None = None) -> DataFrame:
    """Stored features.  The root is read as one table, so ``source`` is a
    column and a choice of sources prunes directories."""
    try:
        df = spark.read.parquet(uri)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise FileNotFoundError(f"no feature files under {uri}: has the feature job completed?") from e
    return df.where(F.col("source").isin(*sources)) if sources else df


def concat_by_name(frames: list[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns a frame lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
