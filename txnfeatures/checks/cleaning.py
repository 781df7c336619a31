"""Projections, labels and repair, over rows made untidy on the way in."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnfeatures.checks import tables as t
from txnfeatures.functions import cleaning as C

# Events with text amounts some of which are no numbers, infinite or missing
# amounts, and a missing label.
UNTIDY_SQL = """untidy AS (
  SELECT event_id, ts, user_id,
    CASE event_type WHEN 'error' THEN 'x' WHEN 'view' THEN NULL ELSE CAST(value AS VARCHAR) END AS text_amount,
    CASE event_type WHEN 'error' THEN 'infinity'::DOUBLE WHEN 'view' THEN NULL ELSE value END AS odd_amount,
    CASE event_type WHEN 'error' THEN 'not a time' ELSE CAST(ts AS VARCHAR) END AS text_time,
    CASE event_type WHEN 'error' THEN TRUE WHEN 'click' THEN NULL ELSE FALSE END AS is_fraud,
    CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN NULL ELSE 0 END AS label
  FROM events)"""


def untidy(spark, sf_dir):
    kind = F.col("event_type")
    return t.table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        F.when(kind == "error", "x").when(kind != "view", F.col("value").cast("string")).alias("text_amount"),
        F.when(kind == "error", float("inf")).when(kind != "view", F.col("value")).alias("odd_amount"),
        F.when(kind == "error", "not a time").otherwise(F.col("ts").cast("string")).alias("text_time"),
        F.when(kind == "error", True).when(kind != "click", False).alias("is_fraud"),
        F.when(kind == "error", 1).when(kind != "click", 0).alias("label"),
    )


def _untidy_query(select):
    return lambda spark, sf_dir: t.rounded(select(untidy(spark, sf_dir)))


def const_features(spark, sf_dir):
    df = t.table(spark, sf_dir, "events").select("event_id")
    return C.fill_missing_groups(df, "calendar", "user", "pca", source="financial")


def align_schema(spark, sf_dir):
    df = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return C.align(df, ["o_totalprice", "absent", "o_orderkey"])


def filter_fraud(spark, sf_dir):
    df = t.card_fraud(spark, sf_dir).withColumnRenamed("IsFraud", "label")
    return C.filter_fraud(df).select("row_id", "label")


def flags(spark, sf_dir):
    from txnfeatures.functions import scalar as S

    hour = S.hour_fraction(S.epoch_seconds("ts"))
    return t.table(spark, sf_dir, "events").select(
        "event_id",
        S.high_flag("value", F.lit(100.0)).alias("is_high_amount"),
        S.night_flag(hour).alias("is_night"),
        S.weekend_flag(S.day_of_week("ts")).alias("is_weekend"),
    )


def drop_if_present(spark, sf_dir):
    df = t.table(spark, sf_dir, "events").withColumnRenamed("value", "weight")
    return C.drop_columns(df).drop("props")


QUERIES = {
    "normalize_columns": lambda s, d: C.rename_ci(
        t.financial(s, d).withColumnRenamed("amount", "AMOUNT"), {"amount": "Amount"}
    ).select("row_id", "Amount"),
    "cast_numeric": lambda s, d: C.cast_columns(
        t.table(s, d, "lineitem").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
            F.col("l_linenumber").cast("string").alias("as_double"),
            F.col("l_quantity").alias("as_int"),
        ),
        {"as_double": "double", "as_int": "int"},
    ),
    "label_bool": _untidy_query(lambda df: df.select("event_id", C.label("is_fraud", "bool").alias("label"))),
    "label_int": _untidy_query(lambda df: df.select("event_id", C.label("label", "int").alias("label"))),
    "const_features": const_features,
    "filter_fraud": filter_fraud,
    "flags": flags,
    "drop_if_present": drop_if_present,
    "align_schema": align_schema,
    "inf_to_null": _untidy_query(lambda df: C.inf_to_null(df.select("event_id", "odd_amount"))),
    "fill_missing": _untidy_query(lambda df: C.fill_missing(df.select("event_id", "label"), ["label"])),
    "coerce_numeric": _untidy_query(lambda df: df.select("event_id", C.coerce_double("text_amount").alias("amount"))),
    "coerce_datetime": _untidy_query(lambda df: df.select("event_id", C.coerce_ts("text_time").alias("parsed"))),
}

ORACLES = {
    "normalize_columns": 'SELECT event_id AS row_id, value AS "Amount" FROM events',
    "cast_numeric": """SELECT l_orderkey * 8 + l_linenumber AS row_id, CAST(l_linenumber AS DOUBLE) AS as_double,
      CAST(trunc(l_quantity) AS INTEGER) AS as_int FROM lineitem""",
    "label_bool": f"""WITH {UNTIDY_SQL} SELECT event_id,
      CAST(CASE WHEN is_fraud THEN 1 ELSE 0 END AS INTEGER) AS label FROM untidy""",
    "label_int": f"WITH {UNTIDY_SQL} SELECT event_id, CAST(label AS INTEGER) AS label FROM untidy",
    "const_features": """SELECT event_id, CAST(0 AS INTEGER) AS day_of_week, CAST(0 AS INTEGER) AS is_weekend,
      CAST(0 AS INTEGER) AS txn_month, 0.0::DOUBLE AS user_mean_amount, 0.0::DOUBLE AS user_std_amount,
      CAST(0 AS BIGINT) AS user_txn_count, 0.0::DOUBLE AS user_amount_z, 0.0::DOUBLE AS pca_l2,
      0.0::DOUBLE AS pca_max_abs, 0.0::DOUBLE AS pca_mean, 'financial' AS source FROM events""",
    "filter_fraud": f"WITH {t.CARD_FRAUD_SQL} SELECT row_id, IsFraud AS label FROM card_fraud WHERE IsFraud = 1",
    "flags": """SELECT event_id, CAST(CASE WHEN value > 100 THEN 1 ELSE 0 END AS INTEGER) AS is_high_amount,
      CAST(CASE WHEN fmod(floor(epoch(ts)) / 3600.0::DOUBLE, 24) >= 22
                  OR fmod(floor(epoch(ts)) / 3600.0::DOUBLE, 24) <= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_night,
      CAST(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend FROM events""",
    "drop_if_present": "SELECT event_id, user_id, event_type FROM events",
    "align_schema": "SELECT o_totalprice, 0.0::DOUBLE AS absent, o_orderkey FROM orders",
    "inf_to_null": f"""WITH {UNTIDY_SQL} SELECT event_id,
      round(CASE WHEN isfinite(odd_amount) THEN odd_amount END, 6) AS odd_amount FROM untidy""",
    "fill_missing": f"WITH {UNTIDY_SQL} SELECT event_id, CAST(coalesce(label, 0) AS INTEGER) AS label FROM untidy",
    "coerce_numeric": f"""WITH {UNTIDY_SQL} SELECT event_id,
      round(coalesce(TRY_CAST(text_amount AS DOUBLE), 0), 6) AS amount FROM untidy""",
    "coerce_datetime": f"WITH {UNTIDY_SQL} SELECT event_id, TRY_CAST(text_time AS TIMESTAMP) AS parsed FROM untidy",
}
