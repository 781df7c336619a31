"""The given tables seen as the input relations of the feature plans.

Each view has a DataFrame form and a SQL form (a list of common table
expressions) so that a query and its SQL twin start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnfeatures.schema import PCA_COLS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def financial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("amount"),
        F.col("user_id").alias("sender_account"),
        (F.col("event_type") == "error").alias("is_fraud"),
    )


def creditcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        (F.col("vec_id") * 60.0).alias("Time"),
        *[e[i].cast("double").alias(v) for i, v in enumerate(PCA_COLS)],
        (F.abs(e[28].cast("double")) * 100.0).alias("Amount"),
        F.when(F.col("label") == 0, 1).otherwise(0).alias("Class"),
    )


def card_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderdate").alias("TransactionDate"),
        F.col("o_totalprice").alias("Amount"),
        F.col("o_custkey").alias("MerchantID"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("IsFraud"),
    )


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
        F.col("l_extendedprice").alias("Amount"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_suppkey").alias("sender_account"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("IsFraud"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled score table with many ties."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        (F.floor(F.col("l_extendedprice") / 10.0) / 12000.0).alias("probability"),
        F.when(F.col("l_extendedprice") >= 60000.0, 1).otherwise(0).alias("prediction"),
    )


FINANCIAL_SQL = """financial AS (
  SELECT event_id AS row_id, ts AS "timestamp", value AS amount, user_id AS sender_account,
         event_type = 'error' AS is_fraud
  FROM events)"""

CREDITCARD_SQL = f"""creditcard AS (
  SELECT vec_id AS row_id, vec_id * 60.0::DOUBLE AS "Time",
         {", ".join(f"embedding[{i}]::DOUBLE AS V{i}" for i in range(1, 29))},
         abs(embedding[29]::DOUBLE) * 100.0::DOUBLE AS "Amount",
         CASE WHEN label = 0 THEN 1 ELSE 0 END AS "Class"
  FROM embeddings)"""

CARD_FRAUD_SQL = """card_fraud AS (
  SELECT o_orderkey AS row_id, o_orderdate AS TransactionDate, o_totalprice AS "Amount",
         o_custkey AS MerchantID, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS IsFraud
  FROM orders)"""

MIXED_SQL = """mixed AS (
  SELECT l_orderkey * 8 + l_linenumber AS row_id, l_extendedprice AS "Amount", l_shipdate AS "timestamp",
         l_suppkey AS sender_account, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS IsFraud
  FROM lineitem)"""

SCORED_SQL = """scored AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
         floor(l_extendedprice / 10.0::DOUBLE) / 12000.0::DOUBLE AS probability,
         CASE WHEN l_extendedprice >= 60000.0 THEN 1 ELSE 0 END AS prediction
  FROM lineitem)"""


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to a fixed number of places: summation order differs by engine."""
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
