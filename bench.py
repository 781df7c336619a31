"""Timings of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from txnfeatures.checks import tables as t
from txnfeatures.checks.features import universal
from txnfeatures.checks.learning import mixed_features, score_mixed, small_model, smote_classes, stored_features
from txnfeatures.functions import scalar as S
from txnfeatures.operators import evaluation as E
from txnfeatures.operators import stats as A
from txnfeatures.operators.ranks import with_percent_rank
from txnfeatures.plans import features as P
from txnfeatures.plans.training import train_universal
from txnfeatures.settings import RECOMMENDED
from txnfeatures.sources.readers import read_csv
from txnfeatures.sources.writers import scratch_uri

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    builder = SparkSession.builder
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = (
        builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def headline(spark):
    events = t.table(spark, SF_DIR, "events")
    seconds = events.select(S.epoch_seconds("ts").alias("seconds"))
    price = t.table(spark, SF_DIR, "lineitem").select("l_orderkey", "l_extendedprice")
    return {
        "universal_features": lambda: sink(universal(spark, SF_DIR)),
        "features_financial": lambda: sink(P.features_financial(t.financial(spark, SF_DIR))),
        "amount_stats": lambda: A.fit_amount_stats(price, "l_extendedprice"),
        "amount_stats_approx": lambda: A.fit_amount_stats(price, "l_extendedprice", method="approx"),
        "user_stats": lambda: sink(A.user_stats(t.table(spark, SF_DIR, "orders"), "o_custkey", "o_totalprice")),
        "bucket_counts": lambda: sink(A.bucket_counts(seconds, "seconds")),
        "percent_rank": lambda: sink(with_percent_rank(price, "l_extendedprice")),
        "roc_auc": lambda: E.roc_auc(t.scored(spark, SF_DIR)).collect(),
        "classification_report": lambda: E.classification_report(t.scored(spark, SF_DIR)).collect(),
        "serving_features": lambda: sink(mixed_features(spark, SF_DIR)),
        "score_source": lambda: sink(score_mixed(spark, SF_DIR, small_model(spark, SF_DIR))),
        "csv_write_read": lambda: csv_round_trip(spark),
        "write_features": lambda: stored_features(spark, SF_DIR),
        "smote": lambda: smote_classes(spark, SF_DIR).collect(),
        "train_30_trees": lambda: train_universal(stored_features(spark, SF_DIR), maxIter=30),
    }


#: Timed once: a fit takes minutes at the trainer's full settings, of which this is a tenth.
ONCE = {"train_30_trees"}


def csv_round_trip(spark):
    uri = scratch_uri(spark, "bench-csv")
    t.financial(spark, SF_DIR).write.option("header", True).csv(uri)
    sink(read_csv(spark, uri, "row_id bigint, amount double, sender_account string, is_fraud boolean"))


def main() -> None:
    spark = session()
    small_model(spark, SF_DIR)
    times = {}
    for name, run in headline(spark).items():
        if name not in ONCE:
            run()
        took = []
        for _ in range(1 if name in ONCE else RUNS):
            start = time.perf_counter()
            run()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took), 3)
    rows = sum(t.table(spark, SF_DIR, n).count() for n in ("events", "embeddings", "orders"))
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "universal_features_rows_per_sec": round(rows / times["universal_features"]),
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
