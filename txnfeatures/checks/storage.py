"""Sources, sinks, caps and concatenation.

What a query writes goes to a fresh path under the session's checkpoint folder.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from txnfeatures.checks import tables as t
from txnfeatures.checks.evaluation import ORACLES as EVALUATION_SQL
from txnfeatures.checks.features import datasets_sql, universal, universal_sql
from txnfeatures.operators.evaluation import evaluate
from txnfeatures.operators.sampling import cap_rows, cap_rows_by_source, cap_rows_exact, head, stratified_split
from txnfeatures.schema import FINANCIAL
from txnfeatures.sources import readers as R
from txnfeatures.sources import writers as W


def _financial_csv(spark, sf_dir, mixed=False):
    """The financial relation as a CSV file set; ``mixed``: half of the files have their columns in another order."""
    uri = W.scratch_uri(spark, "financial-csv")
    columns = ["transaction_id", "amount", "timestamp", "sender_account", "is_fraud"]
    rows = t.financial(spark, sf_dir).withColumnRenamed("row_id", "transaction_id").withColumn("timestamp", F.col("timestamp").cast("string"))
    for i, order in enumerate([columns, columns[::-1]] if mixed else [columns]):
        part = rows.where(F.col("transaction_id") % 2 == i) if mixed else rows
        part.select(*order).write.mode("append").option("header", True).csv(uri)
    return uri


def scan_csv(spark, sf_dir):
    spec = FINANCIAL.at(_financial_csv(spark, sf_dir, mixed=True))
    df = R.read_source(spark, spec, mixed_headers=True).select("transaction_id", "Amount", "timestamp", "sender_account", "is_fraud")
    return t.rounded(df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))


def scan_score_input(spark, sf_dir):
    return t.rounded(R.read_csv(spark, _financial_csv(spark, sf_dir)).select("transaction_id", "Amount"))


def repartition(spark, sf_dir):
    spec = replace(FINANCIAL, repartition=16).at(_financial_csv(spark, sf_dir))
    return t.rounded(R.read_source(spark, spec).select("transaction_id", "Amount"))


def _written_features(spark, sf_dir):
    uri = W.scratch_uri(spark, "universal-features")
    W.write_features(universal(spark, sf_dir), uri)
    return uri


def write_features(spark, sf_dir):
    df = R.read_features(spark, _written_features(spark, sf_dir))
    return df.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("label").alias("n_fraud"))


def scan_features(spark, sf_dir):
    return t.rounded(R.read_features(spark, _written_features(spark, sf_dir), ["credit_card_fraud"]))


def row_cap(spark, sf_dir):
    return cap_rows(t.table(spark, sf_dir, "orders"), 1200, "o_orderkey").select("o_orderkey", "o_custkey")


def row_cap_by_source(spark, sf_dir):
    """Cap to half of the rows: per source, whether the kept part is half of it within six deviations, and if all kept rows are its own."""
    df = t.card_fraud(spark, sf_dir).select("row_id", F.col("IsFraud").cast("string").alias("source"))
    capped = cap_rows_by_source(df, df.count() // 2, "row_id").withColumn("kept", F.lit(1))
    both = df.join(capped, ["row_id", "source"], "full")
    n, kept = F.count("*"), F.count("kept")
    return both.groupBy("source").agg(n.alias("n_rows"), (F.abs(2 * kept - n) <= 6 * F.sqrt(n)).alias("kept_half"))


def row_cap_exact(spark, sf_dir):
    """Cap to a third of the rows: rows kept of each source (customer), all of them the source's own."""
    df = t.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("source"))
    capped = cap_rows_exact(df, df.count() // 3, "o_orderkey").withColumn("kept", F.lit(1))
    both = df.join(capped, ["o_orderkey", "source"], "full")
    return both.groupBy("source").agg(F.count("*").alias("n_rows"), F.count("kept").alias("n_kept"))


def write_scores(spark, sf_dir):
    uri = W.scratch_uri(spark, "scores")
    W.write_scores(t.scored(spark, sf_dir), uri)
    return t.rounded(R.read_csv(spark, uri, "label int, probability double, prediction int"))


def write_metrics(spark, sf_dir):
    uri = W.scratch_uri(spark, "metrics")
    W.write_metrics(evaluate(t.scored(spark, sf_dir), n_features=18), uri)
    types = "roc_auc double, pr_auc double, n_test bigint, n_fraud bigint, features int"
    return spark.read.schema(types).json(uri)


def write_replicated(spark, sf_dir):
    uris = [W.scratch_uri(spark, "primary"), W.scratch_uri(spark, "secondary")]
    W.write_replicated(t.table(spark, sf_dir, "orders"), uris)
    out = None
    for name, uri in zip(("primary", "secondary"), uris):
        copy = spark.read.parquet(uri).agg(
            F.lit(name).alias("copy"), F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("sum_key")
        )
        out = copy if out is None else out.unionByName(copy)
    return out


def replica_check(spark, sf_dir):
    """A copy in another order is the same; a copy with one value changed, or with one row twice in place of another, is not."""
    orders = t.table(spark, sf_dir, "orders")
    least, most = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    copies = {
        "primary": orders,
        "reordered": orders.repartition(5, "o_custkey"),
        "changed": orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") == least, -1.0).otherwise(F.col("o_totalprice"))),
        "repeated": orders.where(F.col("o_orderkey") != most).unionByName(orders.where(F.col("o_orderkey") == least)),
    }
    uris = {W.scratch_uri(spark, name): name for name in copies}
    for uri, name in uris.items():
        copies[name].write.parquet(uri)
    name_of = F.create_map(*[F.lit(x) for pair in uris.items() for x in pair])
    return W.check_replicas(spark, list(uris), orders.schema).select(name_of[F.col("uri")].alias("copy"), F.col("rows").alias("n_rows"), "same")


def concat_by_name(spark, sf_dir):
    events = t.table(spark, sf_dir, "events").select("event_id", "value")
    orders = t.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), "o_orderstatus")
    return t.rounded(R.concat_by_name([events, orders]))


def head_rows(spark, sf_dir):
    return t.rounded(head(t.financial(spark, sf_dir), 10, "row_id", ["row_id", "amount", "is_fraud"]))


def split(spark, sf_dir):
    """Rows of each class, on each side."""
    df = t.card_fraud(spark, sf_dir).select("row_id", F.col("IsFraud").alias("label"))
    out = stratified_split(df, "row_id")
    sides = out.groupBy("label").agg(
        F.count_if(F.col("is_test") == 1).alias("n_test"), F.count_if(F.col("is_test") == 0).alias("n_train"), F.countDistinct("row_id").alias("n_rows")
    )
    return sides


QUERIES = {
    "scan_csv": scan_csv,
    "repartition": repartition,
    "write_features": write_features,
    "scan_features": scan_features,
    "row_cap": row_cap,
    "row_cap_by_source": row_cap_by_source,
    "row_cap_exact": row_cap_exact,
    "scan_score_input": scan_score_input,
    "write_scores": write_scores,
    "write_metrics": write_metrics,
    "write_replicated": write_replicated,
    "replica_check": replica_check,
    "concat_by_name": concat_by_name,
    "head": head_rows,
    "stratified_split": split,
}


ORACLES = {
    "scan_csv": """SELECT CAST(event_id AS VARCHAR) AS transaction_id, value AS "Amount", ts AS "timestamp",
      CAST(user_id AS VARCHAR) AS sender_account, event_type = 'error' AS is_fraud FROM events""",
    "repartition": 'SELECT CAST(event_id AS VARCHAR) AS transaction_id, value AS "Amount" FROM events',
    "write_features": f"""WITH u AS ({universal_sql()})
      SELECT source, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_fraud FROM u GROUP BY 1""",
    "scan_features": f"WITH {t.CARD_FRAUD_SQL} {datasets_sql()['card_fraud']}",
    "row_cap": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 1200",
    "row_cap_by_source": f"""WITH {t.CARD_FRAUD_SQL}
      SELECT CAST(IsFraud AS VARCHAR) AS source, count(*) AS n_rows, TRUE AS kept_half FROM card_fraud GROUP BY 1""",
    "row_cap_exact": """WITH c AS (SELECT o_custkey AS source, count(*) AS n_rows FROM orders GROUP BY 1),
      s AS (SELECT *, CAST(sum(n_rows) OVER () AS BIGINT) AS total, total // 3 AS n FROM c),
      f AS (SELECT *, n_rows * n // total AS whole, n_rows * n % total AS rest FROM s)
      SELECT source, n_rows, whole + CAST(row_number() OVER (ORDER BY rest DESC, source) <=
        n - CAST(sum(whole) OVER () AS BIGINT) AS BIGINT) AS n_kept FROM f""",
    "scan_score_input": 'SELECT CAST(event_id AS INTEGER) AS transaction_id, value AS "Amount" FROM events',
    "write_scores": f"WITH {t.SCORED_SQL} SELECT label, round(probability, 6) AS probability, prediction FROM scored",
    "write_metrics": EVALUATION_SQL["evaluation_metrics"],
    "write_replicated": """SELECT 'primary' AS copy, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS sum_key FROM orders
      UNION ALL SELECT 'secondary', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders""",
    "replica_check": """SELECT 'primary' AS copy, count(*) AS n_rows, TRUE AS same FROM orders
      UNION ALL SELECT 'reordered', count(*), TRUE FROM orders
      UNION ALL SELECT 'changed', count(*), FALSE FROM orders
      UNION ALL SELECT 'repeated', count(*), FALSE FROM orders""",
    "concat_by_name": """SELECT event_id, value, NULL::VARCHAR AS o_orderstatus FROM events
      UNION ALL SELECT o_orderkey, NULL, o_orderstatus FROM orders""",
    "head": """SELECT event_id AS row_id, value AS amount, event_type = 'error' AS is_fraud
      FROM events ORDER BY event_id LIMIT 10""",
    "stratified_split": f"""WITH {t.CARD_FRAUD_SQL}, c AS (SELECT IsFraud AS label, count(*) AS n_rows FROM card_fraud GROUP BY 1)
      SELECT label, CAST(round_even(0.2 * n_rows, 0) AS BIGINT) AS n_test,
        CAST(n_rows - round_even(0.2 * n_rows, 0) AS BIGINT) AS n_train, n_rows FROM c""",
}
