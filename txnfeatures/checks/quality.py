"""Counts, checks and class balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnfeatures.checks import tables as t
from txnfeatures.checks.cleaning import UNTIDY_SQL, untidy
from txnfeatures.checks.features import ALL_SQL, datasets_sql, universal
from txnfeatures.operators import quality as Q

ORDER_COLS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def contract_check(spark, sf_dir):
    df = t.creditcard(spark, sf_dir).select(
        F.col("Time").alias("hour"), F.col("V1").alias("hour_sin"), F.col("V2").alias("pca_l2"), "V3"
    )
    return Q.contract_check(df, ["hour", "hour_sin", "pca_l2", "amount_z"])


def balanced_weights(spark, sf_dir):
    df = t.card_fraud(spark, sf_dir).withColumnRenamed("IsFraud", "label")
    return t.rounded(Q.with_balanced_weight(df).select("row_id", "label", "weight"))


def fraud_summary(spark, sf_dir):
    u = universal(spark, sf_dir).select("source", "label")
    per = Q.label_summary(u, "source")
    return t.rounded(per.unionByName(Q.label_summary(u).withColumn("source", F.lit("all"))))


QUERIES = {
    "row_count": lambda s, d: Q.row_count(t.table(s, d, "lineitem")),
    "fraud_summary": fraud_summary,
    "value_counts": lambda s, d: Q.target_counts(t.creditcard(s, d)),
    "missing_counts": lambda s, d: Q.missing_counts(untidy(s, d)),
    "contract_check": contract_check,
    "column_profile": lambda s, d: Q.column_profile(t.table(s, d, "orders"), "o_orderkey", ORDER_COLS),
    "class_counts": lambda s, d: Q.class_counts(t.card_fraud(s, d), "IsFraud", floor=1),
    "balanced_weights": balanced_weights,
}

_counts = "count(*) AS n_rows, count(*) FILTER (label = 1) AS n_fraud, round(avg(label), 6) AS fraud_rate"


def _contract_sql(name, expr, low, high):
    return f"""SELECT '{name}' AS column_name, TRUE AS present, count(*) FILTER ({expr} IS NULL) AS n_null,
      count(*) FILTER (NOT isfinite({expr})) AS n_not_finite,
      count(*) FILTER ({expr} < {low} OR {expr} > {high}) AS n_out_of_range FROM creditcard"""


ORACLES = {
    "row_count": "SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns FROM lineitem",
    "fraud_summary": f"""{ALL_SQL}, u AS ({" UNION ALL ".join(f"({p})" for p in datasets_sql().values())})
      SELECT source, {_counts} FROM u GROUP BY 1 UNION ALL SELECT 'all', {_counts} FROM u""",
    "value_counts": f"""WITH {t.CREDITCARD_SQL}
      SELECT "Class" AS target_value, count(*) AS n_rows, 'Class' AS target FROM creditcard GROUP BY 1""",
    "missing_counts": f"""WITH {UNTIDY_SQL} SELECT * FROM (
        SELECT 'text_amount' AS column_name, count(*) FILTER (text_amount IS NULL) AS n_missing FROM untidy
        UNION ALL SELECT 'odd_amount', count(*) FILTER (odd_amount IS NULL) FROM untidy
        UNION ALL SELECT 'is_fraud', count(*) FILTER (is_fraud IS NULL) FROM untidy
        UNION ALL SELECT 'label', count(*) FILTER (label IS NULL) FROM untidy) WHERE n_missing > 0""",
    "contract_check": f"""WITH {t.CREDITCARD_SQL}
      {_contract_sql("hour", '"Time"', 0, 24)} UNION ALL {_contract_sql("hour_sin", "V1", -1, 1)}
      UNION ALL {_contract_sql("pca_l2", "V2", 0, "'infinity'::DOUBLE")}
      UNION ALL SELECT 'amount_z', FALSE, NULL, NULL, NULL""",
    "column_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct,
            CAST(arg_min({c}, o_orderkey) AS VARCHAR) AS example FROM orders"""
        for c in ORDER_COLS
    ),
    "class_counts": f"""WITH {t.CARD_FRAUD_SQL}, c AS (
        SELECT count(*) FILTER (IsFraud = 1) AS p, count(*) FILTER (IsFraud = 0) AS n FROM card_fraud)
      SELECT p AS n_positive, n AS n_negative,
        CAST(greatest(1, floor(n / greatest(p, 1))) AS BIGINT) AS scale_pos_weight FROM c""",
    "balanced_weights": f"""WITH {t.CARD_FRAUD_SQL}, c AS (SELECT IsFraud AS y, count(*) AS k FROM card_fraud GROUP BY 1)
      SELECT row_id, IsFraud AS label, round((SELECT sum(k) FROM c) / ((SELECT count(*) FROM c) * k)::DOUBLE, 6) AS weight
      FROM card_fraud JOIN c ON IsFraud = y""",
}
