"""Fitted statistics, quantiles, ranks and the joins that attach them."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnfeatures.checks import tables as t
from txnfeatures.functions import scalar as S
from txnfeatures.operators import quantiles as Q
from txnfeatures.operators import ranks as R
from txnfeatures.operators import stats as A


def _quantile_row(method):
    def query(spark, sf_dir):
        df = t.table(spark, sf_dir, "lineitem")
        p95 = Q.quantile(df, "l_extendedprice", 0.95, method)
        return t.rounded(df.agg(F.count("*").alias("n_rows")).withColumn("p95", F.lit(p95)))

    return query


def _rank_error_row(method):
    """Whether the sketch's value has a rank within the promised error."""

    def query(spark, sf_dir):
        df = t.table(spark, sf_dir, "lineitem")
        p95 = Q.quantile(df, "l_extendedprice", 0.95, method)
        n, x = F.count("*"), F.col("l_extendedprice")
        slack = n / F.lit(float(Q.SKETCH_ACCURACY[method])) + 1
        close = (F.count_if(x < p95) <= n * 0.95 + slack) & (F.count_if(x <= p95) >= n * 0.95 - slack)
        return df.agg(n.alias("n_rows"), close.alias("within_rank_error"))

    return query


def amount_stats(spark, sf_dir):
    s = A.fit_amount_stats(t.financial(spark, sf_dir), "amount")
    return t.rounded(s.to_df(spark).select("mean", "std", "p95", "n"))


def user_stats_serving(spark, sf_dir):
    # Error rows have no readable amount here.
    df = t.table(spark, sf_dir, "events").withColumn("a", F.when(F.col("event_type") != "error", F.col("value")))
    return t.rounded(A.user_stats_serving(df, "user_id", "a").select("user_id", *A.USER_VALUES))


def join_user_stats(spark, sf_dir):
    # Error rows have no user here: they keep null statistics.
    user = F.when(F.col("event_type") != "error", F.col("user_id"))
    df = t.table(spark, sf_dir, "events").select("event_id", "value", user.alias("user_id"))
    return t.rounded(A.attach_user_stats(df, "user_id", "value").drop("value"))


def join_bucket_counts(spark, sf_dir):
    seconds = F.when(F.col("event_type") != "error", S.epoch_seconds("ts"))
    df = t.table(spark, sf_dir, "events").select("event_id", seconds.alias("seconds"))
    return A.attach_velocity(df, "seconds").select("event_id", "txn_count_5m")


def percent_rank(spark, sf_dir):
    df = t.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("amount"),
    )
    return t.rounded(R.with_percent_rank(df, "amount").select("row_id", "amount_pct"))


QUERIES = {
    "amount_stats": amount_stats,
    "p95_approx": _rank_error_row("approx"),
    "p95_approx_v1": _rank_error_row("gk"),
    "p95_disc": _quantile_row("disc"),
    "p95_linear": _quantile_row("linear"),
    "user_stats": lambda s, d: t.rounded(A.user_stats(t.table(s, d, "orders"), "o_custkey", "o_totalprice")),
    "user_stats_serving": user_stats_serving,
    "bucket_counts": lambda s, d: A.bucket_counts(
        t.table(s, d, "events").select(S.epoch_seconds("ts").alias("seconds")), "seconds"
    ),
    "join_user_stats": join_user_stats,
    "join_bucket_counts": join_bucket_counts,
    "percent_rank": percent_rank,
}

ORACLES = {
    "amount_stats": """SELECT round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
      round(quantile_disc(value, 0.95), 6) AS p95, count(value) AS n FROM events""",
    "p95_approx": "SELECT count(*) AS n_rows, TRUE AS within_rank_error FROM lineitem",
    "p95_approx_v1": "SELECT count(*) AS n_rows, TRUE AS within_rank_error FROM lineitem",
    "p95_disc": "SELECT count(*) AS n_rows, round(quantile_disc(l_extendedprice, 0.95), 6) AS p95 FROM lineitem",
    "p95_linear": "SELECT count(*) AS n_rows, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95 FROM lineitem",
    "user_stats": """SELECT o_custkey, round(avg(o_totalprice), 6) AS user_mean_amount,
      round(stddev_samp(o_totalprice), 6) AS user_std_amount, count(*) AS user_txn_count FROM orders GROUP BY 1""",
    "user_stats_serving": """SELECT user_id, round(avg(a), 6) AS user_mean_amount,
      round(coalesce(stddev_samp(a), 1), 6) AS user_std_amount, count(a) AS user_txn_count
      FROM (SELECT user_id, CASE WHEN event_type <> 'error' THEN value END AS a FROM events)
      WHERE user_id IS NOT NULL GROUP BY 1""",
    "bucket_counts": """SELECT CAST(floor(floor(epoch(ts)) / 300) AS BIGINT) AS bucket_5m, count(*) AS txn_count_5m
      FROM events GROUP BY 1""",
    "join_user_stats": """WITH e AS (
        SELECT event_id, value, CASE WHEN event_type <> 'error' THEN user_id END AS user_id FROM events)
      SELECT e.event_id, e.user_id, round(m, 6) AS user_mean_amount, round(s, 6) AS user_std_amount, n AS user_txn_count
      FROM e LEFT JOIN (SELECT user_id, avg(value) AS m, stddev_samp(value) AS s, count(*) AS n FROM e GROUP BY 1) u
        ON e.user_id = u.user_id""",
    "join_bucket_counts": """WITH e AS (SELECT event_id,
        CASE WHEN event_type <> 'error' THEN floor(floor(epoch(ts)) / 300) END AS b FROM events)
      SELECT event_id, n AS txn_count_5m FROM e LEFT JOIN (SELECT b, count(*) AS n FROM e GROUP BY 1) c ON e.b = c.b""",
    "percent_rank": """SELECT l_orderkey * 8 + l_linenumber AS row_id, round(percent_rank() OVER (
        ORDER BY CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END NULLS FIRST), 6) AS amount_pct
      FROM lineitem""",
}
