"""A training corpus from ``documents``: quality rules, near-dedup, decontamination, mixing, sharding.

Each stage works on all rows its predecessor kept and is stored before the next
one reads it.  ``STAGES`` lists (name, function); a function takes (spark, docs,
sf_dir) and, but for the last, returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnfeatures.llm.decontaminate import drop_matches
from txnfeatures.llm.minhash import keep_one
from txnfeatures.llm.mixing import mixed
from txnfeatures.llm.repetition import keep_good
from txnfeatures.llm.shuffle import shuffle_into_shards
from txnfeatures.llm.store import stored, text_batches


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    text_batches(spark)
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest id."""
    text_batches(spark)
    return keep_one(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    text_batches(spark)
    return drop_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document is there as often as the mix takes it."""
    text_batches(spark)
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in shuffled order, in shards of equal row counts."""
    text_batches(spark)
    return shuffle_into_shards(docs, shards=8)


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Alignment, dependent rounding and seeded shuffles are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
