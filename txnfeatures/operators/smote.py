"""Synthetic minority rows between neighbouring minority rows."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnfeatures.operators.neighbours import graph_neighbours, nearest_neighbours, tree_neighbours
from txnfeatures.operators.sampling import key_cut
from txnfeatures.sources.writers import scratch_uri


def _unit(*parts):
    """A number in [0, 1) fixed by its inputs."""
    return F.pmod(F.xxhash64(*parts), F.lit(2**52)) / F.lit(float(2**52))


def smote(
    df: DataFrame,
    features: list[str] | str,
    key: str,
    label: str = "label",
    k: int = 5,
    seed: int = 42,
    pivots: int | None = None,
    method: str = "graph",
    trace: bool = False,
) -> DataFrame:
    """Add minority rows until both classes have the same number.

    Each new row lies at a random point between a minority row and one of its
    ``k`` nearest minority neighbours, exact copies counting as neighbours at
    distance zero.  Every minority row is drawn equally often, give or take one.
    ``key`` is a unique whole number.  ``features`` names number columns, or one
    column with all of them as an array.  Returns the features, the label and
    ``synthetic``.  The input comes back unchanged, with a warning that says why,
    where the classes cannot be balanced: ``k`` minority rows or fewer, or
    missing values among them.

    ``method="graph"`` refines a neighbour graph: work grows with the rows, and
    nearly all neighbours are found at any number of features a table like this
    has.  ``"exact"`` finds all and compares nearly all pairs of minority rows
    at many features.  ``"trees"`` only looks into leaves of random-projection trees: it misses neighbours, and more of them
    the more rows there are.  ``trace`` adds ``_from`` and ``_to``, the rows a new one lies between.
    """
    if isinstance(features, str):
        vector = F.col(features).cast("array<double>")
        missing = F.exists(vector, lambda v: v.isNull() | F.isnan(v))
        given = [vector.alias(features)]
    else:
        vector = F.array(*[F.col(c).cast("double") for c in features])
        missing = F.expr(" OR ".join(f"`{c}` IS NULL OR isnan(CAST(`{c}` AS DOUBLE))" for c in features))
        given = [F.col(c).cast("double").alias(c) for c in features]
    original = df.select(*given, label, F.lit(False).alias("synthetic"))
    if trace:
        original = original.withColumns({c: F.lit(None).cast("array<double>") for c in ("_from", "_to")})
    head = df.agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
        F.count_if(missing & (F.col(label) == 1)).alias("bad1"),
        F.count_if(missing & (F.col(label) == 0)).alias("bad0"),
    ).first()
    minority, few, many = (1, head["pos"], head["neg"]) if head["pos"] <= head["neg"] else (0, head["neg"], head["pos"])
    if few == many:
        return original
    if few <= k or head[f"bad{minority}"]:
        reason = f"{few} rows" if few <= k else f"{head[f'bad{minority}']} rows with missing values"
        warnings.warn(f"no synthetic rows: class {minority} has {reason}", stacklevel=2)
        return original

    # Draws per row: the same for all, one more for the first few keys.
    wanted = many - few
    each, extra = divmod(wanted, few)
    rows = df.where(F.col(label) == minority).select(F.col(key).cast("bigint").alias("id"), vector.alias("x"))
    last = key_cut(rows, extra, "id") if extra else None
    draws = F.lit(each) if last is None else F.lit(each) + (F.col("id") <= F.lit(last)).cast("int")
    # Copies are one point from here on, however many there are.  Stored,
    # because they are read again after the search.
    spark = df.sparkSession
    uri = scratch_uri(spark, "minority-points")
    point = rows.groupBy("x").agg(F.min("id").alias("pid"), F.count("*").alias("copies"), F.sum(draws).alias("draws"))
    point.write.parquet(uri)
    points = spark.read.parquet(uri)
    if not points.groupBy("pid").count().where("count > 1 OR pid IS NULL").isEmpty():
        # Keys that repeat or are missing do not tell points apart: numbers do, stored to stay the same.
        uri = scratch_uri(spark, "minority-points")
        points.withColumn("pid", F.monotonically_increasing_id()).write.parquet(uri)
        points = spark.read.parquet(uri)

    if method == "graph":
        found = graph_neighbours(points, k, seed=seed, vectors=False)
    elif method == "exact":
        found = nearest_neighbours(points, k, pivots)
    elif method == "trees":
        found = tree_neighbours(points, k, seed=seed)
    else:
        raise ValueError(f"method must be 'graph', 'exact' or 'trees', not {method!r}")
    # Up to k neighbours by id: own copies first, then the others as often as they occur.
    others = F.flatten(F.transform("near", lambda t: F.array_repeat(t["near"], F.least(t["near_copies"], F.lit(k)).cast("int"))))
    own = F.array_repeat(F.col("pid"), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    near = (
        points.where("draws > 0")
        .join(found, "pid", "left")
        .select("pid", "x", "draws", F.slice(F.concat(own, F.coalesce(others, F.array().cast("array<bigint>"))), 1, k).alias("options"))
    )
    return original.unionByName(_synthesise(points, near, features, label, minority, seed, trace))


def _synthesise(points, near, features, label, minority, seed, trace):
    """New rows per point: draws of all its copies are numbered through."""
    drawn = (
        near.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("draws") - 1) / 4096))))
        .withColumn("from", F.col("part") * 4096)
        .withColumn("to", F.least(F.col("draws"), F.col("from") + 4096) - 1)
        .repartition("pid", "part")
        .withColumn("j", F.explode(F.sequence("from", "to")))
    )
    pick = F.floor(_unit(F.col("pid"), F.col("j"), F.lit(seed)) * F.size("options")).cast("int")
    gap = _unit(F.col("pid"), F.col("j"), F.lit(seed + 1))
    drawn = drawn.select("pid", "x", F.col("options")[pick].alias("end"), gap.alias("gap"))
    # The other end's vector follows its id; a copy of the point has the point's own.
    ends = points.select(F.col("pid").alias("end"), F.col("x").alias("other"))
    new = drawn.where("end <> pid").join(ends, "end").select("x", "other", "gap")
    new = new.unionByName(drawn.where("end = pid").select("x", F.col("x").alias("other"), "gap"))
    if isinstance(features, str):
        between = [F.zip_with("x", "other", lambda a, b: a + F.col("gap") * (b - a)).alias(features)]
    else:
        between = [(F.col("x")[i] + F.col("gap") * (F.col("other")[i] - F.col("x")[i])).alias(c) for i, c in enumerate(features)]
    return new.select(
        *between,
        F.lit(minority).alias(label),
        F.lit(True).alias("synthetic"),
        *([F.col("x").alias("_from"), F.col("other").alias("_to")] if trace else []),
    )
