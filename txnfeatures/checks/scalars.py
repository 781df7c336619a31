"""Row-local expressions, each over every row of a given table."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnfeatures.checks import tables as t
from txnfeatures.functions import scalar as S


def _events(spark, sf_dir):
    return t.table(spark, sf_dir, "events")


def _event_expr(expr, name):
    def query(spark, sf_dir):
        return t.rounded(_events(spark, sf_dir).select("event_id", expr().alias(name)))

    return query


def _card_expr(expr, name):
    def query(spark, sf_dir):
        return t.rounded(t.creditcard(spark, sf_dir).select("row_id", expr().alias(name)))

    return query


def _seconds():
    return S.epoch_seconds("ts")


def _hour():
    return S.hour_fraction(_seconds())


def hour_cyc(spark, sf_dir):
    df = _events(spark, sf_dir).select("event_id", _hour().alias("h"))
    return t.rounded(df.select("event_id", S.hour_sin("h").alias("hour_sin"), S.hour_cos("h").alias("hour_cos")))


def parse_ts(spark, sf_dir):
    # Timestamps as text; error rows carry text that is no timestamp.
    text = F.when(F.col("event_type") == "error", "garbage").otherwise(F.col("ts").cast("string"))
    return _events(spark, sf_dir).select("event_id", S.parse_ts(text).alias("parsed"))


EPOCH = "floor(epoch(ts))"
HOUR = f"fmod({EPOCH} / 3600.0::DOUBLE, 24)"
V = [f"V{i}" for i in range(1, 29)]

QUERIES = {
    "log_amount": _event_expr(lambda: S.log_amount(F.col("value") - 50), "log_amount"),
    "zscore": _event_expr(lambda: S.zscore("value", F.lit(50.0), F.lit(25.0)), "z"),
    "high_flag": _event_expr(lambda: S.high_flag("value", F.lit(100.0)), "is_high_amount"),
    "parse_ts": parse_ts,
    "epoch_seconds": _event_expr(_seconds, "seconds"),
    "hour_fraction": _event_expr(_hour, "hour"),
    "hour_int": _event_expr(lambda: S.hour_int("ts"), "hour"),
    "hour_cyc": hour_cyc,
    "night_flag": _event_expr(lambda: S.night_flag(_hour()), "is_night"),
    "dow_spark": _event_expr(lambda: S.day_of_week("ts"), "day_of_week"),
    "dow_serving": _event_expr(lambda: S.day_of_week_serving("ts"), "day_of_week"),
    "weekend_flag": _event_expr(lambda: S.weekend_flag(S.day_of_week("ts")), "is_weekend"),
    "month": _event_expr(lambda: S.month("ts"), "txn_month"),
    "bucket_5m": _event_expr(lambda: S.time_bucket(_seconds()), "bucket_5m"),
    "pca_l2": _card_expr(lambda: S.pca_l2(V), "pca_l2"),
    "pca_max_abs": _card_expr(lambda: S.pca_max_abs(V), "pca_max_abs"),
    "pca_mean": _card_expr(lambda: S.pca_mean(V), "pca_mean"),
    # The remainder stands for the deviation of a user, with zeros among them.
    "user_amount_z": _event_expr(
        lambda: S.user_amount_z("value", F.lit(50.0), (F.col("user_id") % 3).cast("double")), "user_amount_z"
    ),
    "txn_year": _event_expr(lambda: S.txn_year(_seconds()), "txn_year"),
}


def _event_sql(expr, name):
    return f"SELECT event_id, {expr} AS {name} FROM events"


def _card_sql(expr, name):
    return f"WITH {t.CREDITCARD_SQL} SELECT row_id, round({expr}, 6) AS {name} FROM creditcard"


ORACLES = {
    "log_amount": _event_sql("round(CASE WHEN value - 50 > -1 THEN ln(1 + (value - 50)) END, 6)", "log_amount"),
    "zscore": _event_sql("round((value - 50.0::DOUBLE) / 25.0::DOUBLE, 6)", "z"),
    "high_flag": _event_sql("CAST(CASE WHEN value > 100 THEN 1 ELSE 0 END AS INTEGER)", "is_high_amount"),
    "parse_ts": _event_sql("CASE WHEN event_type = 'error' THEN NULL ELSE ts END", "parsed"),
    "epoch_seconds": _event_sql(f"CAST({EPOCH} AS BIGINT)", "seconds"),
    "hour_fraction": _event_sql(f"round({HOUR}, 6)", "hour"),
    "hour_int": _event_sql("CAST(hour(ts) AS INTEGER)", "hour"),
    "hour_cyc": f"""SELECT event_id, round(sin(2 * pi() * {HOUR} / 24), 6) AS hour_sin,
      round(cos(2 * pi() * {HOUR} / 24), 6) AS hour_cos FROM events""",
    "night_flag": _event_sql(f"CAST(CASE WHEN {HOUR} >= 22 OR {HOUR} <= 6 THEN 1 ELSE 0 END AS INTEGER)", "is_night"),
    "dow_spark": _event_sql("CAST(dayofweek(ts) + 1 AS INTEGER)", "day_of_week"),
    "dow_serving": _event_sql("CAST(isodow(ts) - 1 AS INTEGER)", "day_of_week"),
    "weekend_flag": _event_sql("CAST(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER)", "is_weekend"),
    "month": _event_sql("CAST(month(ts) AS INTEGER)", "txn_month"),
    "bucket_5m": _event_sql(f"CAST(floor({EPOCH} / 300) AS BIGINT)", "bucket_5m"),
    "pca_l2": _card_sql(f"sqrt({' + '.join(f'{c} * {c}' for c in V)})", "pca_l2"),
    "pca_max_abs": _card_sql(f"greatest({', '.join(f'abs({c})' for c in V)})", "pca_max_abs"),
    "pca_mean": _card_sql(f"({' + '.join(V)}) / 28.0::DOUBLE", "pca_mean"),
    "user_amount_z": _event_sql(
        "round((value - 50) / CASE WHEN user_id % 3 > 0 THEN user_id % 3 ELSE 1 END, 6)", "user_amount_z"
    ),
    "txn_year": _event_sql(f"CAST({EPOCH} AS DOUBLE)", "txn_year"),
}
