"""Trees grown level by level over bins: what they cost, where columns are cut, and that both forms of a tree agree."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from txnfeatures.operators import boosting as B

RNG = np.random.default_rng(5)


def _rows(spark, n=600):
    x = RNG.normal(size=(n, 3))
    data = [(*map(float, v), int(v[0] + v[1] > 0.5), i % 5 == 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "a double, b double, c double, label int, held boolean")
    return VectorAssembler(inputCols=list("abc"), outputCol="x").transform(df)


def test_a_tree_costs_a_job_for_each_level(spark):
    context = spark.sparkContext
    df = _rows(spark)
    context.setJobGroup("boost", "boost")
    B.boost(df, "x", rounds=8, depth=3, chunk=4)
    context.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(context.statusTracker().getJobIdsForGroup("boost"))
    assert jobs <= 8 * 3 + 20


def test_few_values_are_cut_between_and_frequent_ones_have_their_bin(spark):
    n = 4000
    x = np.zeros((n, 4))
    x[:, 0] = RNG.normal(size=n)
    x[7, 1] = 1.0  # one row in thousands
    x[:, 2] = np.where(np.arange(n) % 10, 5.0, RNG.normal(size=n))  # nine in ten are 5
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["row", "x"])
    cuts = B.column_cuts(df, "x", "row", n)
    assert 20 < len(cuts[0]) < B.BINS + 1 and (np.diff(cuts[0]) > 0).all()
    assert cuts[1].tolist() == [0.5] and not len(cuts[3])
    bins = np.searchsorted(cuts[2], x[:, 2])
    assert set(bins[x[:, 2] == 5.0]) & set(bins[x[:, 2] < 4.9]) == set()


def test_both_forms_of_a_tree_agree_on_dense_and_sparse_rows(spark):
    x = np.round(RNG.normal(size=(500, 4)), 1) * (RNG.random((500, 4)) < 0.5)
    vector = lambda i, v: Vectors.sparse(4, {j: float(t) for j, t in enumerate(v) if t}) if i % 2 else Vectors.dense(v)
    df = spark.createDataFrame([(vector(i, v), int(v[0] > v[1]), float(i % 3 + 1)) for i, v in enumerate(x)], ["x", "label", "w"])
    found = B.boost(df, "x", weight="w", rounds=1, depth=4, row_share=1.0, column_share=1.0)
    tree = found.trees[0]
    got = tree.setPredictionCol("step").transform(df).select("label", "w", "step", vector_to_array("x").alias("v")).collect()
    # A leaf holds the weighted mean of the first Newton steps (2 or -2) of its rows.
    leaves = {}
    for r in got:
        leaves.setdefault(r["step"], []).append((r["w"], 4.0 * (r["label"] - 0.5)))
    for value, members in leaves.items():
        assert abs(value - sum(w * s for w, s in members) / sum(w for w, _ in members)) < 1e-9
    assert tree.depth <= 4 and tree.numNodes >= 2 * len(leaves) - 1
    # The first cut is the best of all: no other cut of any column takes more variance away.
    y, w = np.array([4.0 * (r["label"] - 0.5) for r in got]), np.array([r["w"] for r in got])
    v = np.array([r["v"] for r in got])
    cuts = B.column_cuts(df.withColumn("row", F.monotonically_increasing_id()), "x", "row", 500)
    score = lambda m: (w[m] * y[m]).sum() ** 2 / w[m].sum() + (w[~m] * y[~m]).sum() ** 2 / w[~m].sum()
    best = max(score(v[:, c] <= t) for c in range(4) for t in cuts[c])
    root = tree._java_obj.rootNode()
    split = root.split()
    assert abs(score(v[:, split.featureIndex()] <= split.threshold()) - best) < 1e-6


def test_rows_that_miss_something_are_refused(spark):
    df = _rows(spark, 60)
    with pytest.raises(ValueError, match="1 rows to fit without"):
        B.boost(df.withColumn("label", F.when(F.col("a") < df.agg(F.max("a")).first()[0], F.col("label"))), "x", rounds=1)
    with pytest.raises(Exception, match="missing or infinite"):
        gaps = spark.createDataFrame([(Vectors.dense([float("nan"), 1.0]), 1), (Vectors.dense([0.0, 1.0]), 0)], ["x", "label"])
        B.boost(gaps, "x", rounds=1)


def _splits(tree):
    return tree.column.tolist(), tree.cut.tolist(), tree.left.tolist()


def _packed(spark, n=3000):
    """Blocks of made rows, in four partitions, and the bins of their columns."""
    rng, sizes = np.random.default_rng(8), [B.BINS, 2, 5, B.BINS, 3]
    blocks = []
    for _ in range(4):
        bins = np.stack([rng.integers(0, k, n) for k in sizes]).astype(np.uint8)
        y = (bins[0] + 5 * bins[1] * bins[2] + rng.normal(0, 9, n) > 22).astype(float)
        draw, weight = rng.integers(0, 1 << 32, n, dtype=np.uint32), rng.integers(0, 3, n).astype(float)
        blocks.append((False, n, *(c.tobytes() for c in (bins, y, weight, draw, np.zeros(n)))))
    return spark.sparkContext.parallelize(blocks, 4), sizes


@pytest.mark.parametrize("limit", [1 << 14, 1 << 17])
def test_trees_are_the_same_wherever_sums_meet(spark, monkeypatch, limit):
    """Every node in reducers, or the smaller of two in reducers and the rest of their parent; by default the latter in the driver."""
    blocks, sizes = _packed(spark)
    drawn = [0, 1, 2, 3]
    usual = B.grow_tree(blocks, [], drawn, sizes, 5, 0.1, 0.8, 3)
    usual = [usual, B.grow_tree(blocks, [usual], drawn, sizes, 5, 0.1, 0.8, 4)]
    monkeypatch.setattr(B, "MEET", limit)
    other = B.grow_tree(blocks, [], drawn, sizes, 5, 0.1, 0.8, 3)
    other = [other, B.grow_tree(blocks, [other], drawn, sizes, 5, 0.1, 0.8, 4)]
    for a, b in zip(usual, other):
        assert _splits(a) == _splits(b) and len(a.left) > 15
        assert np.allclose(a.stats, b.stats, rtol=1e-9, atol=1e-9)


def test_a_level_is_one_stage(spark):
    context = spark.sparkContext
    blocks, sizes = _packed(spark)
    context.setJobGroup("level", "level")
    tree = B.grow_tree(blocks, [], [0, 1, 2, 3, 4], sizes, 4, 0.1, 0.8, 3)
    context.setLocalProperty("spark.jobGroup.id", None)
    jobs = [context.statusTracker().getJobInfo(j) for j in context.statusTracker().getJobIdsForGroup("level")]
    assert tree.depth == 4 and [len(j.stageIds) for j in jobs] == [1] * 4


def test_rows_end_where_comparisons_lead(spark):
    blocks, sizes = _packed(spark, 500)
    tree = B.grow_tree(blocks, [], [0, 1, 2, 3, 4], sizes, 6, 0.1, 1.0, 3)
    bins = np.random.default_rng(1).integers(0, 2 * B.BINS, (5, 700)).astype(np.uint8)
    want = []
    for row in bins.T:
        at = 0
        while tree.left[at] != at:
            at = tree.left[at] + int(row[tree.column[at]] > tree.cut[at])
        want.append(at)
    assert tree.nodes(bins).tolist() == want


def test_areas_of_blocks_of_uneven_size(spark):
    def area(y, score):
        hits = [(y[score >= s].sum(), (score >= s).sum(), y[score == s].sum()) for s in np.unique(score)]
        return sum(own * pos / n for pos, n, own in hits) / y.sum()

    rng = np.random.default_rng(3)
    blocks = [(rng.integers(0, 2, n).astype(float), np.round(rng.normal(size=(n, 2)), 2)) for n in (1, 700, 40, 2500)]
    y, scores = (np.concatenate(part) for part in zip(*blocks))
    rdd = spark.sparkContext.parallelize(blocks, 3)
    for ranges in (None, 5, 300):
        assert B._areas(rdd, ranges) == pytest.approx([area(y, s) for s in scores.T], abs=1e-12)


def test_sparse_and_dense_rows_unfold_alike(spark):
    x = np.round(RNG.normal(size=(50, 4)), 1) * (RNG.random((50, 4)) < 0.5)
    vector = lambda i, v: Vectors.sparse(4, {j: float(t) for j, t in enumerate(v) if t}) if i % 3 else Vectors.dense(v)
    df = spark.createDataFrame([(i, vector(i, v)) for i, v in enumerate(x)], ["i", "x"]).coalesce(1).select(*B._plain("x"))

    def told(batches):
        for batch in batches:
            for _, some in B._dense(batch, 4):
                yield pa.RecordBatch.from_arrays([pa.array(some.tolist(), pa.list_(pa.float64()))], names=["v"])

    assert [r["v"] for r in df.mapInArrow(told, "v array<double>").collect()] == x.tolist()
