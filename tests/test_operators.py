"""Operators against brute force, with the large-data paths forced on."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from txnfeatures.checks import tables as t
from txnfeatures.checks.learning import small_model
from txnfeatures.operators import encoding as N
from txnfeatures.operators import evaluation as E
from txnfeatures.operators import learning as L
from txnfeatures.operators import neighbours as NB
from txnfeatures.operators import quantiles as Q
from txnfeatures.operators import ranks as R
from txnfeatures.operators import sampling as SP
from txnfeatures.operators import stats as A
from txnfeatures.operators.joins import attach_by_key
from txnfeatures.operators.smote import smote
from txnfeatures.plans import features as P
from txnfeatures.plans.frozen import freeze_stats
from txnfeatures.plans.scoring import score_all_sources, score_source
from txnfeatures.plans.serving import extract_features_serving
from txnfeatures.schema import CARD_FRAUD, FEATURE_COLS
from txnfeatures.sources import readers as RD
from txnfeatures.sources import writers as W
from txnfeatures.streaming.velocity import stream_velocity


def values(spark, numbers):
    return spark.createDataFrame([(None if x is None else float(x),) for x in numbers], "x double").repartition(4)


RNG = np.random.default_rng(7)
SHAPES = {
    "spread": list(RNG.lognormal(3, 2, 5000)),
    "third_is_one_value": list(np.where(np.arange(5000) % 3 == 0, 9.5, RNG.normal(10, 1, 5000))),
    "few_values": list(RNG.integers(0, 4, 5000)),
    "constant": [2.5] * 3000,
    "nulls": [None] * 2000 + list(RNG.normal(size=2500)),
    "heavy_at_the_cut": [1.0] * 4749 + [2.0] * 3 + list(3 + RNG.random(248)),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_quantiles_by_narrowing(spark, shape):
    df = values(spark, SHAPES[shape]).cache()
    present = np.sort([x for x in SHAPES[shape] if x is not None])
    for q in (0.0, 0.5, 0.95):
        disc = present[max(int(np.ceil(round(q * len(present), 9))), 1) - 1]
        assert Q.exact_quantiles(df, {"x": q}, "disc", small=20)["x"] == disc
        got = Q.exact_quantiles(df, {"x": q}, "linear", small=20)["x"]
        assert got == pytest.approx(np.quantile(present, q), rel=1e-12)
    df.unpersist()


def test_narrowing_filters_the_scan(spark, tmp_path):
    uri = str(tmp_path / "x")
    values(spark, SHAPES["spread"]).write.parquet(uri)
    rows = Q._rows_inside(spark.read.parquet(uri), [("x", 1.0, 5.0)])
    assert "GreaterThan(x,1.0), LessThan(x,5.0)" in rows._jdf.queryExecution().executedPlan().toString()


def test_quantile_of_nothing(spark):
    assert Q.quantile(values(spark, [None, None]), "x", 0.5) is None


def test_several_columns_at_once(spark):
    df = values(spark, SHAPES["spread"]).withColumn("y", -F.col("x"))
    got = Q.exact_quantiles(df, {"x": 0.95, "y": 0.05}, small=50)
    assert got["y"] == pytest.approx(-np.sort(SHAPES["spread"])[len(SHAPES["spread"]) - 250], rel=1e-12)


@pytest.mark.parametrize("rows_per_range", [100, 900, 10_000])
@pytest.mark.parametrize("shape", ["spread", "third_is_one_value", "few_values", "nulls"])
def test_percent_rank_by_ranges(spark, shape, rows_per_range):
    df = values(spark, SHAPES[shape]).withColumn("id", F.monotonically_increasing_id()).cache()
    want = df.withColumn("want", F.percent_rank().over(Window.orderBy(F.asc_nulls_first("x"))))
    got = R.with_percent_rank(df, "x", "got", rows_per_range)
    both = want.join(got.select("id", "got"), "id")
    assert both.where(F.abs(F.col("want") - F.col("got")) > 1e-12).count() == 0
    assert both.count() == df.count()
    df.unpersist()


def test_running_totals_by_ranges(spark):
    df = values(spark, SHAPES["third_is_one_value"])
    out, totals = R.running_totals(df, "x", {"n": F.count("*")}, rows_per_range=300)
    rows = sorted(tuple(r) for r in out.collect())
    below = 0
    for _, n, before in rows:
        assert before == below
        below += n
    assert below == totals["n"] == 5000


@pytest.mark.parametrize("broadcast, local_map", [("-1", "0"), ("-1", "1g"), ("10m", "0")])
def test_attach_keeps_rows_of_hot_and_null_keys(spark, conf, broadcast, local_map):
    conf("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", local_map)
    conf("spark.sql.autoBroadcastJoinThreshold", broadcast)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", broadcast)
    # A third of the rows has one user, a third none, the rest are rare users.
    df = spark.range(9000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).cast("bigint").alias("u"),
        (F.col("id") % 7).cast("double").alias("a"),
    )
    got = A.attach_user_stats(df, "u", "a")
    want = df.join(A.user_stats(df.where("u IS NOT NULL"), "u", "a"), "u", "left").select(*got.columns)
    rounded = [F.round(c, 9).alias(c) if ty == "double" else F.col(c) for c, ty in got.dtypes]
    assert got.count() == 9000
    assert got.select(rounded).exceptAll(want.select(rounded)).count() == 0


def test_attach_broadcasts_hot_keys_only(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    stats = spark.range(5000).select(F.col("id").alias("k"), F.when(F.col("id") < 2, 10_000).otherwise(1).alias("n"))
    out = attach_by_key(spark.range(10).withColumnRenamed("id", "k"), stats, "k", "n", ["n"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 1 and plan.count("BroadcastHashJoin") >= 1
    assert sorted(tuple(r) for r in out.collect())[:3] == [(0, 10_000), (1, 10_000), (2, 1)]


def test_attach_is_split_by_adaptive_execution(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2.0")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10k")
    # One key outside the hot list of a frozen table holds most rows.
    facts = spark.range(60_000).select(F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id")).alias("k"), F.rand(1).alias("a"))
    facts.repartition(8).write.parquet(str(tmp_path / "facts"))
    stats = spark.range(60_000).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    out = attach_by_key(spark.read.parquet(str(tmp_path / "facts")), stats, "k", "n", ["n"])
    assert len(out.collect()) == 60_000
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_velocity_counts_each_bucket_once(spark, sf_dir):
    df = P.add_time_features_datetime(t.financial(spark, sf_dir), "timestamp")
    per_row = P.add_velocity_features(df, "ts").agg(F.sum(1 / F.col("txn_count_5m"))).first()[0]
    assert per_row == pytest.approx(A.bucket_counts(df, "ts").count())


def test_feature_properties(spark, sf_dir):
    df = P.features_financial(t.financial(spark, sf_dir))
    row = df.agg(
        F.avg("amount_z").alias("mean"),
        F.stddev("amount_z").alias("std"),
        F.avg("is_high_amount").alias("high"),
        F.max(F.abs(F.col("hour_sin") ** 2 + F.col("hour_cos") ** 2 - 1)).alias("circle"),
    ).first()
    assert row["mean"] == pytest.approx(0, abs=1e-9) and row["std"] == pytest.approx(1)
    assert row["high"] <= 0.05 and row["circle"] < 1e-12
    card = P.features_creditcard(t.creditcard(spark, sf_dir))
    assert card.where("pca_max_abs > pca_l2 + 1e-12").count() == 0


def test_frozen_statistics_equal_own_ones(spark, sf_dir, tmp_path):
    df = t.card_fraud(spark, sf_dir)
    frozen = freeze_stats(df, CARD_FRAUD, str(tmp_path / "stats"))
    again = P.features_card_fraud(df, **frozen.for_training())
    assert t.rounded(again).exceptAll(t.rounded(P.features_card_fraud(df))).count() == 0


def test_scoring_with_frozen_statistics(spark, sf_dir, tmp_path):
    df = t.card_fraud(spark, sf_dir)
    frozen = freeze_stats(df, CARD_FRAUD, str(tmp_path / "stats"))
    trained = {r["row_id"]: r["z"] for r in A.attach_user_stats(df, "MerchantID").select("row_id", F.col("user_mean_amount").alias("z")).collect()}
    # Few rows scored alone still see the users as training did.
    few = df.where("row_id < 20")
    scored = extract_features_serving(few, "Amount", "TransactionDate", user="MerchantID", keep_raw=True, **frozen.for_scoring())
    for r in scored.collect():
        assert r["user_mean_amount"] == pytest.approx(trained[r["_raw"]["row_id"]])


def test_scan_reads_needed_columns_only(spark, sf_dir):
    plan = P.features_financial(t.financial(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "Python" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_auc_agrees_with_the_library(spark, sf_dir):
    df = t.scored(spark, sf_dir)
    library = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0).evaluate(
        df.withColumn("label", F.col("label").cast("double"))
    )
    assert E.roc_auc(df).first()[0] == pytest.approx(library, abs=1e-9)
    assert E.roc_auc(df, rows_per_range=500).first()[0] == pytest.approx(library, abs=1e-9)


def test_cap_is_exact_for_large_keys(spark):
    df = spark.range(1000).select((F.col("id") + F.lit(2**61)).alias("k"))
    capped = SP.cap_rows(df, 333, "k")
    assert capped.agg(F.count("*"), F.max("k")).first()[:] == (333, 2**61 + 332)
    assert SP.cap_rows(df, 5000, "k").count() == 1000
    assert SP.cap_rows(df, 0, "k").count() == 0


def test_split_shares(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 50 == 0).cast("int").alias("label"))
    rough = {r[0]: r[1] for r in SP.stratified_split(df, "id", exact=False).groupBy("label").agg(F.avg("is_test")).collect()}
    assert all(abs(s - 0.2) < 0.08 for s in rough.values())
    exact = {r[0]: r[1] for r in SP.stratified_split(df, "id").groupBy("label").agg(F.sum("is_test")).collect()}
    assert exact == {0: 3920, 1: 80}


def test_source_cap_keeps_shares(spark):
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"))
    n = {r[0]: r[1] for r in SP.cap_rows_by_source(df, 6000, "id").groupBy("source").count().collect()}
    assert abs(n["a"] - 2000) < 200 and abs(n["b"] - 4000) < 300


def largest_remainder(counts, n):
    total = sum(counts.values())
    take = {s: c * n // total for s, c in counts.items()}
    left = n - sum(take.values())
    for s in sorted(counts, key=lambda s: (-(counts[s] * n % total), (s is not None, s)))[:left]:
        take[s] += 1
    return take


@pytest.mark.parametrize("small", [100_000, 40])
def test_exact_cap_by_source(spark, small):
    """Many sources, one with half of the rows, one null; clashing and extra column names travel."""
    source = F.when(F.col("id") % 2 == 0, -1).when(F.col("id") % 61 != 0, F.col("id") % 1009)
    df = spark.range(20_000).select("id", source.cast("int").alias("source"), F.col("id").alias("_row"), F.col("id").alias("h"), F.lit(1).alias("_s"))
    counts = {r[0]: r[1] for r in df.groupBy("source").count().collect()}
    for n in (1, 777, 7001):
        out = SP.cap_rows_exact(df, n, "id", small=small)
        assert out.columns == df.columns
        rows = out.collect()
        assert len({r["id"] for r in rows}) == len(rows) == n and all(r["id"] == r["_row"] == r["h"] for r in rows)
        kept = {s: 0 for s in counts}
        for r in rows:
            kept[r["source"]] += 1
        assert kept == largest_remainder(counts, n)
    again = SP.cap_rows_exact(df.repartition(3), 7001, "id", small=40)
    assert {r["id"] for r in again.collect()} == {r["id"] for r in rows}


def test_exact_cap_edges(spark):
    df = spark.range(10).select("id", F.lit("a").alias("source"))
    assert SP.cap_rows_exact(df, 0, "id").count() == 0
    assert SP.cap_rows_exact(df, 99, "id").count() == 10
    assert SP.cap_rows_exact(df.limit(0), 5, "id").count() == 0


def test_exact_cap_jobs_do_not_grow_with_sources(spark):
    def jobs(sources):
        tag = f"cap-{sources}"
        spark.sparkContext.setJobGroup(tag, tag)
        try:
            df = spark.range(30_000).select("id", (F.col("id") % sources).alias("source"))
            assert SP.cap_rows_exact(df, 10_000, "id").count() == 10_000
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    few, many = jobs(3), jobs(10_000)
    assert many <= few + 4


def test_encoding_refuses_many_levels(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="more than 10 levels"):
        N.one_hot_drop_first(df, ["c"], max_levels=10)


def test_preprocess_stage(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (float("inf"), 5.0), (3.0, 5.0)], "a double, b double")
    rows = N.fit_preprocess(df, ["a", "b"]).transform(df).collect()
    scale = np.std([1, 2, 2, 3])
    assert [r["a_scaled"] for r in rows] == pytest.approx([1 / scale, 2 / scale, 2 / scale, 3 / scale])
    assert [r["b_scaled"] for r in rows] == [5.0] * 4


@pytest.mark.parametrize("pivots, block", [(None, 64), (1, 100), (40, 16)])
def test_neighbours_are_exact(spark, monkeypatch, pivots, block):
    monkeypatch.setattr(NB, "BLOCK", block)
    cluster = RNG.normal(size=(120, 3)) * 0.01 + 5
    x = np.unique(np.round(np.vstack([RNG.normal(size=(250, 3)), cluster, [[90, 90, 90]]]), 6), axis=0)
    df = spark.createDataFrame([(i, 1, [float(v) for v in p]) for i, p in enumerate(x)], NB.POINT)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    want = np.sort(d, axis=1)[:, :5]
    got = {r["pid"]: [n["d"] for n in r["near"]] for r in NB.nearest_neighbours(df, 5, pivots).collect()}
    assert len(got) == len(x)
    for i in range(len(x)):
        assert got[i] == pytest.approx(want[i], abs=1e-9)


def test_smote_lies_between_neighbours(spark):
    rare = RNG.normal(size=(30, 2))
    rows = [(i, 1, float(a), float(b)) for i, (a, b) in enumerate(rare)]
    # A third of the minority are copies of one row.
    rows += [(100 + i, 1, 7.0, 7.0) for i in range(15)]
    rows += [(1000 + i, 0, float(a), float(b)) for i, (a, b) in enumerate(RNG.normal(size=(200, 2)))]
    df = spark.createDataFrame(rows, "id bigint, label int, a double, b double")
    out = smote(df, ["a", "b"], "id")
    counts = {(r["label"], r["synthetic"]): r["count"] for r in out.groupBy("label", "synthetic").count().collect()}
    assert counts == {(0, False): 200, (1, False): 45, (1, True): 155}
    x = np.vstack([rare, np.full((15, 2), 7.0)])
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :5]
    for r in out.where("synthetic").collect():
        p = np.array([r["a"], r["b"]])
        ok = False
        for i in range(len(x)):
            for j in near[i]:
                u = x[j] - x[i]
                length = (u**2).sum()
                s = ((p - x[i]) @ u / length) if length else 0.0
                ok = ok or (-1e-9 <= s <= 1 + 1e-9 and np.abs(x[i] + s * u - p).max() < 1e-9)
        assert ok, p


@pytest.mark.parametrize("method, least", [("exact", 1.0), ("graph", 0.9)])
def test_smote_lies_between_true_neighbours_in_many_dimensions(spark, method, least):
    rng = np.random.default_rng(3)
    n, names = 3000, [f"f{i}" for i in range(18)]
    x = rng.normal(size=(n, 18)) * np.linspace(0.2, 2, 18)
    few = [(i, 1, *map(float, v)) for i, v in enumerate(x)]
    many = [(n + i, 0, *([0.0] * 18)) for i in range(2 * n)]
    df = spark.createDataFrame(few + many, ["id", "label", *names])
    out = smote(df, names, "id", method=method, trace=True).where("synthetic").select("_from", "_to").collect()
    at = {tuple(v): i for i, v in enumerate(x.tolist())}
    d = ((x[:, None, :] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    true = np.argsort(d, axis=1)[:, :5]
    assert len(out) == n
    assert np.mean([at[tuple(r["_to"])] in true[at[tuple(r["_from"])]] for r in out]) >= least


def test_graph_neighbours_of_a_hundred_thousand_points(spark):
    n, rng = 100_000, np.random.default_rng(5)
    x = rng.normal(size=(n, 18)) * np.linspace(0.2, 2, 18)
    table = pa.table({"pid": np.arange(n), "copies": np.ones(n, dtype=np.int64), "x": list(x)})
    shares = []
    found = NB.graph_neighbours(spark.createDataFrame(table).repartition(16), 5, report=shares)
    got = {r["pid"]: [a["near"] for a in r["near"]] for r in found.where("pid % 50 = 0").collect()}
    hits = 0
    for i in range(0, n, 50):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        hits += len(set(np.argpartition(d, 5)[:5].tolist()) & set(got[i]))
    assert len(got) == n // 50 and hits / (5 * len(got)) >= 0.9
    assert shares[-1] < NB.SETTLED


def test_graph_neighbours_of_few_points(spark):
    rows = [(i, 1, [float(i), 0.0]) for i in range(4)]
    got = {r["pid"]: [(a["near"], a["d"]) for a in r["near"]] for r in NB.graph_neighbours(spark.createDataFrame(rows, NB.POINT), 5).collect()}
    assert got[0] == [(1, 1.0), (2, 2.0), (3, 3.0)] and got[1] == [(0, 1.0), (2, 1.0), (3, 2.0)] and len(got) == 4
    assert NB.graph_neighbours(spark.createDataFrame(rows[:1], NB.POINT), 5).count() == 0


def test_smote_leaves_hopeless_input_alone(spark):
    df = spark.createDataFrame([(i, int(i < 4), float(i)) for i in range(20)], "id bigint, label int, a double")
    assert smote(df, ["a"], "id").count() == 20
    gap = df.withColumn("a", F.when(F.col("id") != 2, F.col("a")))
    with pytest.warns(UserWarning, match="missing values"):
        assert smote(gap, ["a"], "id", k=2).where("synthetic").count() == 0
    # A gap among the many is no obstacle.
    other = df.withColumn("a", F.when(F.col("id") != 7, F.col("a")))
    assert smote(other, ["a"], "id", k=2).where("synthetic").count() == 12


def test_tree_neighbours_in_many_dimensions(spark):
    x = RNG.normal(size=(3000, 18)) * np.linspace(3, 0.2, 18)
    df = spark.createDataFrame([(i, 1, [float(v) for v in p]) for i, p in enumerate(x)], NB.POINT).repartition(4)
    got = {r["pid"]: [n["near"] for n in r["near"]] for r in NB.tree_neighbours(df, 5, trees=6, leaf=300).collect()}
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1)[:, :5]
    assert len(got) == len(x) and all(len(n) == 5 for n in got.values())
    recall = np.mean([len(set(got[i]) & set(want[i])) / 5 for i in range(len(x))])
    assert recall > 0.4
    sizes = NB._leaves(df, 0, 1, 10, 7).groupBy("leaf").count().collect()
    # Candidates of a point are bounded by its leaves, not by the number of points.
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 400


def test_reading_nothing_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no feature files"):
        RD.read_features(spark, str(tmp_path / "none"))


def test_write_reports_counts_and_prunes(spark, sf_dir, tmp_path):
    df = P.union_sources(
        [P.features_financial(t.financial(spark, sf_dir)), P.features_card_fraud(t.card_fraud(spark, sf_dir))]
    )
    uri = str(tmp_path / "features")
    seen = W.write_features(df, uri)
    assert seen["rows"] == 2500 and seen["fraud"] == df.where("label = 1").count()
    one = RD.read_features(spark, uri, ["financial"])
    assert one.count() == 1000
    assert "PartitionFilters: [isnotnull(source" in one._jdf.queryExecution().executedPlan().toString()
    even = str(tmp_path / "even")
    assert W.write_features(df, even, rebalance=True)["rows"] == 2500
    assert len(list((tmp_path / "even" / "source=financial").glob("*.parquet"))) == 1
    W.write_features(df.where("source = 'financial'").limit(10), uri, dynamic=True)
    assert RD.read_features(spark, uri).count() == 1510


def test_replica_failure_is_reported(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    status = W.write_replicated(spark.range(5).toDF("x"), [str(tmp_path / "a"), str(tmp_path / "file" / "b")]).collect()
    assert [(r["rows"], r["ok"]) for r in status] == [(5, True), (None, False)]
    assert "Exception" in status[1]["error"]
    with pytest.raises(Exception, match="save"):
        W.write_replicated(spark.range(5).toDF("x"), [str(tmp_path / "file" / "b"), str(tmp_path / "c")])


def test_replicas_are_compared_by_content(spark, tmp_path):
    rows = [(1, "a", None, {"x": 1, "y": 2}), (1, "a", None, {"x": 1, "y": 2}), (2, None, "a", {}), (3, "c", "d", None)]
    df = spark.createDataFrame(rows, "k int, s string, t string, m map<string,int>")
    other = {
        "first": df,
        "reordered": df.orderBy(F.desc("k")).select("m", "t", "s", "k"),
        "one value": df.withColumn("s", F.when(F.col("k") == 3, "C").otherwise(F.col("s"))),
        "null moved": spark.createDataFrame([*rows[:2], (2, "a", None, {}), rows[3]], df.schema),
        "pair swapped": spark.createDataFrame([rows[2], rows[2], rows[2], rows[3]], df.schema),
        "pair gone": spark.createDataFrame(rows[2:], df.schema),
    }
    uris = [str(tmp_path / name) for name in other]
    for uri, copy in zip(uris, other.values()):
        copy.write.parquet(uri)
    found = W.check_replicas(spark, [*uris, str(tmp_path / "missing")], df.schema).collect()
    assert [r["same"] for r in found] == [True, True, False, False, False, False, None]
    assert found[5]["rows"] == 2 and found[6]["error"]
    empty = [str(tmp_path / "e1"), str(tmp_path / "e2")]
    status = W.write_replicated(df.limit(0), empty)
    assert [(r["rows"], r["ok"]) for r in status.collect()] == [(0, True)] * 2
    assert [r["same"] for r in W.check_replicas(spark, empty, df.schema).collect()] == [True, True]


def test_replica_of_a_changed_primary_is_not_ok(spark, tmp_path, monkeypatch):
    """Rows that the primary gives back otherwise than they were written."""
    df = spark.range(20).select(F.rand().alias("x"))
    uris = [str(tmp_path / "a"), str(tmp_path / "b")]

    def one_after_the_other(spark, uris, write):
        write(uris[0])
        spark.range(20).select(F.lit(0.5).alias("x")).write.mode("overwrite").parquet(uris[0])
        with pytest.raises(ValueError, match="not the rows written"):
            write(uris[1])

    monkeypatch.setattr(W, "replicate", one_after_the_other)
    W.write_replicated(df, uris)


def test_header_census(spark, tmp_path):
    for i in range(40):
        layout = [("amount,user", f"{i}.5,s{i}"), ("user,amount,extra", f"s{i},{i}.5,z")][i % 2]
        (tmp_path / f"part {i}.csv").write_text("\n".join(layout) + "\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank first.csv").write_text("\namount,user\n99.5,s99\n")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "x.csv").write_text("amount,user\n7.25,deep\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    census = RD.header_census(spark, str(tmp_path))
    assert sorted(len(paths) for paths in census) == [20, 22]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    both = RD.read_csv(spark, str(tmp_path), "amount double", mixed_headers=True)
    assert {r["user"]: r["amount"] for r in both.collect()} == {f"s{i}": i + 0.5 for i in [*range(40), 99]} | {"deep": 7.25}
    assert both.where("extra = 'z'").count() == 20


def test_csv_is_read_by_column_name(spark, tmp_path):
    (tmp_path / "in.csv").write_text("Class,Amount,Extra\n1,2.5,z\n0,3,y\n")
    df = RD.read_csv(spark, str(tmp_path / "in.csv"), "Amount double, Class int")
    assert dict(df.dtypes) == {"Class": "int", "Amount": "double", "Extra": "string"}
    assert [tuple(r) for r in df.collect()] == [(1, 2.5, "z"), (0, 3.0, "y")]


def test_model_names_and_threshold(spark, sf_dir):
    model = small_model(spark, sf_dir)
    assert L.feature_names(model) == FEATURE_COLS
    scored = score_source(model, t.mixed(spark, sf_dir), "Amount", "timestamp", user="sender_account", threshold=0.0)
    assert scored.where("fraud_predicted = 0").count() == 0
    assert scored.columns[:-2] == t.mixed(spark, sf_dir).columns


def test_model_goes_to_every_store(spark, sf_dir, tmp_path):
    (tmp_path / "file").write_text("in the way")
    uris = [str(tmp_path / "a"), str(tmp_path / "file" / "b")]
    status = L.save_model_replicated(small_model(spark, sf_dir), uris).collect()
    assert [r["ok"] for r in status] == [True, False]
    assert L.n_trees(L.load_model(uris[0])) == L.n_trees(small_model(spark, sf_dir))


def test_scores_go_to_one_directory_each(spark, sf_dir, tmp_path):
    frames = {"creditcard": t.creditcard(spark, sf_dir), "mixed_1M": t.mixed(spark, sf_dir)}
    result = score_all_sources(small_model(spark, sf_dir), frames, uri=str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["creditcard_predictions", "mixed_1M_predictions"]
    assert result.report.count() == 5


def test_late_rows_are_dropped_from_the_stream(spark, tmp_path):
    def add(name, stamps):
        spark.createDataFrame([(s,) for s in stamps], "s string").selectExpr("CAST(s AS timestamp_ntz) AS ts").coalesce(1).write.mode(
            "append"
        ).parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema("ts timestamp_ntz").parquet(str(tmp_path / "in"))
        q = (
            stream_velocity(stream, "ts")
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "progress"))
            .trigger(availableNow=True)
            .start(str(tmp_path / "out"))
        )
        q.awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    add("a", ["2024-01-01 00:00:01", "2024-01-01 00:04:59", "2024-01-01 00:05:00", "2024-01-01 01:00:00"])
    first = 1704067200 // 300
    assert run() == [(first, 2), (first + 1, 1)]
    # Older than the watermark by now: neither counted nor emitted again.
    add("b", ["2024-01-01 00:00:30", "2024-01-01 02:00:00"])
    assert run() == [(first, 2), (first + 1, 1), (first + 12, 1)]


def test_csv_files_of_different_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("amount,sender_account\n1.5,s1\n")
    (tmp_path / "b.csv").write_text("sender_account,amount\ns2,7.0\n")
    types = "amount double, sender_account string"
    both = RD.read_csv(spark, str(tmp_path), types, mixed_headers=True)
    assert sorted((r["amount"], r["sender_account"]) for r in both.collect()) == [(1.5, "s1"), (7.0, "s2")]
    with pytest.raises(Exception, match="CSV header"):
        RD.read_csv(spark, str(tmp_path), types).collect()


def test_impute_and_scale_over_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,), (float("inf"),)], "x double")
    assert sorted(r[0] for r in N.impute_median(df, ["x"]).collect()) == [1.0, 2.0, 2.0, 2.0, 3.0]
    assert N.fit_scales(df, ["x"]) == {"x": 1.0}
    assert [r[0] for r in N.impute_median(df, ["x"], {"x": 9.0}).where("x = 9").collect()] == [9.0] * 3


def test_split_gives_every_row_a_side(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, 1).when(F.col("id") > 5, 2).alias("label"))
    out = SP.stratified_split(df, "id")
    assert out.groupBy("is_test").count().orderBy("is_test").collect() == [(0, 800), (1, 200)]


def test_split_does_not_follow_the_key(spark):
    out = SP.stratified_split(spark.range(5000).withColumn("label", F.col("id") % 2), "id").where("is_test = 1")
    steps = {b - a for a, b in zip(*(lambda k: (k, k[1:]))(sorted(r["id"] for r in out.collect())))}
    assert len(steps) > 10


def test_ranges_without_limit(spark, monkeypatch):
    monkeypatch.setattr(R, "FEWEST", 2)
    monkeypatch.setattr(R, "MOST", 3)
    df = spark.range(3000).select((F.col("id") * F.col("id") % 997).cast("double").alias("x"))
    df = df.union(spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double"))
    got = R.with_percent_rank(df, "x", "got", rows_per_range=50)
    want = df.select("x", F.percent_rank().over(Window.orderBy(F.asc_nulls_first("x"))).alias("want"))
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r[0], round(r[1], 9)) for r in got.collect()), key=key).__repr__() == sorted(((r[0], round(r[1], 9)) for r in want.collect()), key=key).__repr__()


def test_percentile_takes_few_jobs(spark):
    df = spark.range(400_000).select((F.col("id") * 7919 % 400_009).cast("double").alias("x"))
    spark.sparkContext.setJobGroup("percentile", "percentile")
    Q.exact_quantiles(df, {"x": 0.95})
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("percentile")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Four passes: count, sketch (merged in two levels), counts of the probes, last step; each takes two or three jobs.
    assert 0 < len([j for j in jobs if j]) <= 10


def test_training_job_stores_model_and_metrics(spark, sf_dir, tmp_path):
    from txnfeatures.checks.learning import stored_features
    from txnfeatures.plans.training import train_universal

    (tmp_path / "file").write_text("in the way")
    uris = [str(tmp_path / "a"), str(tmp_path / "file" / "b")]
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    features, before = stored_features(spark, sf_dir), set(os.listdir(folder))
    trained = train_universal(features, uris=uris, maxIter=2, maxDepth=2)
    assert {x.split("-")[0] for x in set(os.listdir(folder)) - before} & {"test", "split", "ready"} == {"test"}
    assert [(r["ok"], r["error"] is None) for r in trained.stores.collect()] == [(True, True), (False, False)]
    assert trained.n_test == trained.test.count() == trained.metrics.first()["n_test"]
    again = L.predict(L.load_model(f"{uris[0]}/model"), trained.test, probability="again", prediction="again_class")
    assert again.where("again <> fraud_probability").count() == 0


def test_level_ranks_have_no_limit(spark):
    rows = [("a",)] * 5 + [("b",)] * 3 + [("c",)] * 3 + [(None,)] + [(f"z{i:05d}",) for i in range(3000)]
    out, names = N.index_levels(spark.createDataFrame(rows, "`x y` string"), ["x y"])
    found = sorted(r[names[0]] for r in out.collect())
    assert names == ["x y_level"] and out.columns == names
    assert found == [0.0] + [1.0] * 5 + [2.0] * 3 + [3.0] * 3 + [float(i) for i in range(4, 3004)]


def test_model_runs_once_when_scores_are_written(spark, sf_dir, tmp_path):
    from txnfeatures.plans.scoring import score_and_summarise

    df = t.mixed(spark, sf_dir)
    out = score_and_summarise(small_model(spark, sf_dir), df, "Amount", "timestamp", user="sender_account", uri=str(tmp_path / "s"))
    plan = out.scores._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "csv" in plan.lower()
    assert out.summary["n_rows"] == df.count() == out.scores.count()
    assert out.summary["n_predicted"] == out.scores.where("fraud_predicted = 1").count()


def test_salts_spread_a_user_the_table_does_not_know_as_hot(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    # User 1 holds most rows here and a thousandth of a thousandth of the table's.
    df = spark.range(4000).select("id", F.when(F.col("id") % 10 < 8, 1).when(F.col("id") % 10 == 8, F.col("id")).alias("u"))
    stats = spark.range(4000).select(F.col("id").alias("u"), F.lit(1).alias("n"), (F.col("id") * 2).alias("v"))
    out = attach_by_key(df, stats, "u", "n", ["v"], salts=8)
    rows = out.withColumn("p", F.spark_partition_id()).collect()
    assert len(rows) == 4000 and all(r["v"] == (None if r["u"] is None else 2 * r["u"]) for r in rows)
    assert len({r["p"] for r in rows if r["u"] == 1}) >= 4


def _by_distance(x, k):
    d = np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    return np.argsort(d, axis=1, kind="stable")[:, :k], np.sort(d, axis=1)[:, :k]


def test_graph_neighbours_are_complete_where_few_cells_are_in_reach(spark):
    # Two wide columns, narrow ones, a constant one, many nearly equal rows: lists need no refining.
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(size=(900, 2)) * [4e4, 2e4], rng.normal(size=(900, 3)), np.zeros(900)])
    x = np.vstack([x, x[:80] + rng.normal(size=(80, 6)) * 1e-9])
    df = spark.createDataFrame([(i, 1 + i % 3, [float(v) for v in p]) for i, p in enumerate(x)], NB.POINT).repartition(5)
    ids, ds = _by_distance(x, 5)
    for vectors in (True, False):
        shares = []
        got = {r["pid"]: r["near"] for r in NB.graph_neighbours(df, 5, cell=64, visits=40, report=shares, vectors=vectors).collect()}
        assert shares == [0.0] and len(got) == len(x)
        for i, near in got.items():
            assert [a["near"] for a in near] == ids[i].tolist()
            assert [a["d"] for a in near] == pytest.approx(ds[i], rel=1e-9)
            assert [a["near_copies"] for a in near] == [1 + j % 3 for j in ids[i]]
            assert not vectors or [a["near_x"] for a in near] == x[ids[i]].tolist()


def test_graph_neighbours_with_some_lists_open(spark):
    # Few rows in many columns beside many in two: only the former reach too many cells.
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(size=(2000, 10)) * ([50] * 2 + [1e-6] * 8), rng.normal(size=(300, 10)) * 40])
    df = spark.createDataFrame([(i, 1, [float(v) for v in p]) for i, p in enumerate(x)], NB.POINT).repartition(5)
    ids, _ = _by_distance(x, 5)
    shares = []
    got = {r["pid"]: [a["near"] for a in r["near"]] for r in NB.graph_neighbours(df, 5, cell=64, report=shares).collect()}
    assert len(got) == len(x) and shares[0] > 0
    assert np.mean([len(set(got[i]) & set(ids[i])) / 5 for i in range(2000)]) >= 0.95
    assert np.mean([len(set(got[i]) & set(ids[i])) / 5 for i in range(2000, 2300)]) >= 0.9


def test_graph_neighbours_beside_infinite_rows(spark):
    x = [[float(i), 0.0] for i in range(40)] + [[float("inf"), 1.0], [float("-inf"), 1.0]]
    df = spark.createDataFrame([(i, 1, p) for i, p in enumerate(x)], NB.POINT)
    got = {r["pid"]: [a["near"] for a in r["near"]] for r in NB.graph_neighbours(df, 2, cell=16).collect()}
    assert sorted(got) == list(range(40)) and got[0] == [1, 2] and got[20] == [19, 21]


@pytest.mark.parametrize("bounded", [True, False])
def test_compared_with_all(spark, monkeypatch, bounded):
    monkeypatch.setattr(NB, "BLOCK", 50)
    monkeypatch.setattr(NB, "ALL_BLOCK", 90)
    rng = np.random.default_rng(10)
    # Equal distances are told apart by id.
    x = np.vstack([rng.integers(0, 4, size=(150, 3)) * 1.0, rng.normal(size=(150, 3)) + 1e5])
    df = spark.createDataFrame([(i, 1, [float(v) for v in p]) for i, p in enumerate(x)], NB.POINT)
    ids, ds = _by_distance(x, 4)
    asked = df.where("pid % 2 = 0").select("pid", "x")
    reach = spark.createDataFrame([(i, float(d[-1]) if bounded else float("inf")) for i, d in enumerate(ds)], "pid bigint, reach double")
    got = {}
    for r in NB.compared_with_all(asked.join(reach, "pid"), df, 4).orderBy("pid", "d", "near").collect():
        got.setdefault(r["pid"], []).append(r["near"])
    assert got == {i: ids[i].tolist() for i in range(0, 300, 2)}


def test_smote_sends_ids_and_not_vectors_of_neighbours(spark):
    # Rows travel a bounded number of times; five neighbours' vectors of 40 columns a row would be 1,600 bytes a time.
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.normal(size=(4000, 2)) * 1e4, rng.normal(size=(4000, 38))])
    df = spark.createDataFrame([(i, int(i < 1500), [float(v) for v in p]) for i, p in enumerate(x)], "id bigint, label int, x array<double>")
    out = smote(df, "x", "id", trace=True).where("synthetic")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array<array<double>>" not in plan and "near_x" not in plan
    rows = out.collect()
    ids, _ = _by_distance(x[:1500], 5)
    at = {tuple(v): i for i, v in enumerate(x[:1500].tolist())}
    assert len(rows) == 1000
    assert all(at[tuple(r["_to"])] in ids[at[tuple(r["_from"])]] for r in rows)
    for r in rows:
        a, b, p = (np.array(r[c]) for c in ("_from", "_to", "x"))
        assert abs(np.linalg.norm(p - a) + np.linalg.norm(b - p) - np.linalg.norm(b - a)) < 1e-6


@pytest.mark.parametrize("key", ["id % 7", "if(id % 3 = 0, null, id)"])
def test_smote_balances_where_keys_repeat_or_are_missing(spark, key):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(210, 2))
    df = spark.createDataFrame([(i, int(i < 70), float(a), float(b)) for i, (a, b) in enumerate(x)], "id bigint, label int, a double, b double")
    out = smote(df.withColumn("id", F.expr(key)), ["a", "b"], "id", k=3, trace=True).where("synthetic").collect()
    ids, _ = _by_distance(x[:70], 3)
    at = {tuple(v): i for i, v in enumerate(x[:70].tolist())}
    assert len(out) == 70
    assert all(at[tuple(r["_to"])] in ids[at[tuple(r["_from"])]] for r in out)
