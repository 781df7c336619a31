"""Boosting over stored margins, sparse indicators, numbers along an order."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txnfeatures.operators import boosting as B
from txnfeatures.operators import encoding as N
from txnfeatures.operators import evaluation as E
from txnfeatures.operators.numbering import numbered
from txnfeatures.operators.smote import smote

RNG = np.random.default_rng(12)


@pytest.fixture(scope="module")
def rows(spark):
    x = RNG.normal(size=(1500, 5))
    y = (x[:, 0] + 0.5 * x[:, 1] + RNG.normal(size=1500) > 0.8).astype(int)
    data = [(*map(float, v), int(k), i % 4 == 0) for i, (v, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double, label int, held boolean")
    return VectorAssembler(inputCols=list("abcde"), outputCol="x").transform(df)


def test_growth_stops_after_the_patience(rows):
    found = B.boost(rows, "x", validation="held", rounds=60, depth=3, rate=0.3, patience=5, chunk=4)
    assert found.rounds - found.best_round == 5 and found.rounds % 4 or found.rounds == 60
    assert len(found.areas) == len(found.trees) == len(found.columns) == found.rounds
    assert found.areas[found.best_round - 1] == max(found.areas) and found.model.getNumTrees == found.best_round
    for rounds in (1, found.best_round, found.rounds):
        margin = F.round(2 * vector_to_array("rawPrediction")[1], B.DIGITS).alias("probability")
        scored = found.prefix(rounds).transform(rows.where("held")).select("label", margin)
        assert E.average_precision(scored).first()[0] == pytest.approx(found.areas[rounds - 1], abs=1e-12)
    assert E.roc_auc(found.model.transform(rows.where("held")).select("label", vector_to_array("probability")[1].alias("probability"))).first()[0] > 0.8


def test_each_tree_keeps_to_its_columns_and_chunks_change_nothing(rows):
    one, other = (B.boost(rows, "x", rounds=6, depth=3, column_share=0.4, chunk=c) for c in (6, 2))
    assert [len(c) for c in one.columns] == [2] * 6 and len({tuple(c) for c in one.columns}) > 1
    for tree, drawn in zip(one.trees, one.columns):
        assert set(tree.featureImportances.indices.tolist()) <= set(drawn)
    assert one.columns == other.columns and one.best_round == 6 and not one.areas
    a, b = ([r[0] for r in m.model.transform(rows).orderBy("a").select(vector_to_array("probability")[1]).collect()] for m in (one, other))
    assert a == pytest.approx(b, abs=1e-9)


def test_boosting_names_what_is_missing(rows):
    with pytest.raises(ValueError, match="no held-out row is positive"):
        B.boost(rows.where("NOT held OR label = 0"), "x", validation="held", rounds=2)
    with pytest.raises(ValueError, match="no row to fit"):
        B.boost(rows.where("held"), "x", validation="held", rounds=2)


@pytest.mark.parametrize("ranges", [2, 64])
def test_staged_area_equals_the_plain_one(spark, ranges):
    scores = np.round(RNG.normal(size=(400, 3)), 1)  # with ties
    y = RNG.integers(0, 2, 400)
    df = spark.createDataFrame([([float(v) for v in s], int(k)) for s, k in zip(scores, y)], "s array<double>, label int")
    found = B.staged_average_precision(df, "s", "label", ranges)
    for i in range(3):
        plain = df.select("label", F.col("s")[i].alias("probability"))
        assert found[i] == pytest.approx(E.average_precision(plain).first()[0], abs=1e-12)
    assert B.staged_average_precision(df.where("label = 0"), "s", "label") == [None] * 3


def test_numbers_run_without_gaps(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), F.lit(1).alias("number_"))
    got = {r["v"]: r["number"] for r in numbered(df.repartition(7), ["v"]).collect()}
    assert got == {i: i for i in range(5000)}
    assert numbered(df.limit(0), ["v"]).count() == 0


def test_sparse_indicators_equal_the_dense_form(spark):
    data = [(i, [None, "b", "a", "c c"][i % 4], "x" if i % 3 else "y", "only") for i in range(40)] + [(99, None, None, None)]
    df = spark.createDataFrame(data, "id bigint, `t 1` string, u string, one string")
    dense = N.one_hot_drop_first(df, ["t 1", "u", "one"])
    want = {r["id"]: [float(v) for v in r[1:]] for r in dense.collect()}
    rows, levels = N.sparse_indicators(df, ["t 1", "u", "one"], "v")
    assert rows.columns == ["id", "v"]
    assert {r["id"]: r["v"].toArray().tolist() for r in rows.collect()} == want
    places = {(r["column"], r["level"]): r["place"] for r in levels.collect()}
    assert places == {("t 1", "a"): None, ("t 1", "b"): 0, ("t 1", "c c"): 1, ("u", "x"): None, ("u", "y"): 2, ("one", "only"): None}
    empty, _ = N.sparse_indicators(df.limit(0), ["t 1"])
    assert empty.count() == 0


def test_sparse_indicators_of_a_million_levels(spark):
    n = 1_000_000
    # A third of the rows have one level.
    df = spark.range(n).select("id", F.lpad(F.col("id").cast("string"), 7, "0").alias("level"))
    df = df.unionByName(spark.range(n // 2).select((F.col("id") + n).alias("id"), F.lit("0000005").alias("level")))
    rows, _ = N.sparse_indicators(df, ["level"])
    vector = F.unwrap_udt("indicators")
    place = F.element_at(vector["indices"], 1)
    want = F.when(F.col("id") < n, F.col("id") - 1).otherwise(4)
    facts = rows.agg(
        F.count("*"), F.min(vector["size"]), F.max(vector["size"]), F.count_if(F.size(vector["indices"]) == 0),
        F.count_if((F.col("id") > 0) & (place == want)),
    ).first()
    assert tuple(facts) == (n + n // 2, n - 1, n - 1, 1, n + n // 2 - 1)


def test_smote_of_an_array_column(spark):
    x = RNG.normal(size=(60, 3))
    df = spark.createDataFrame([(i, int(i < 20), [float(v) for v in p]) for i, p in enumerate(x)], "id bigint, label int, x array<double>")
    wide = df.select("id", "label", *[F.col("x")[i].alias(f"f{i}") for i in range(3)])
    names = ["f0", "f1", "f2"]
    a = sorted(tuple(r["x"]) for r in smote(df, "x", "id").where("synthetic").collect())
    b = sorted(tuple(r[n] for n in names) for r in smote(wide, names, "id").where("synthetic").collect())
    assert len(a) == 20 and a == b
