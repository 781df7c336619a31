"""Running totals and ranks over a whole dataset without a one-task sort."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnfeatures.operators.joins import attach_by_key
from txnfeatures.operators.quantiles import _present, select_ranks, sketch_quantiles

ROWS_PER_RANGE = 1_000_000
# Ranges cut at sketched quantiles; each is cut further into even steps of the
# key where rows ask for more, so their number has no limit.
FEWEST, MOST = 16, 4096


def _with_range(df: DataFrame, source: DataFrame, key: str, ranges: int, steps: int, numbers: int) -> DataFrame:
    """Tag rows with an ordered pair (``_range``, ``_step``) of ``key``; ``numbers``: present values that are no NaN."""
    share = [i / ranges for i in range(0, ranges + 1)]
    cuts = sketch_quantiles(source, {key: (_present(key), share)})[key] if numbers else []
    cuts = sorted({c for c in cuts if abs(c) != float("inf")}) or [0.0]
    bounds = [float("-inf"), *cuts, float("inf")]
    tag = Bucketizer(splits=bounds, inputCol="_as_double", outputCol="_range", handleInvalid="keep")
    out = tag.transform(df.withColumn("_as_double", F.col(key).cast("double")))
    if steps == 1:
        return out.withColumn("_step", F.lit(0).cast("bigint")).drop("_as_double")
    # Below the first and above the last cut the width is that of all cuts together.
    span = cuts[-1] - cuts[0] or 1.0
    low = F.array(*[F.lit(x) for x in [cuts[0] - span, *cuts]])
    high = F.array(*[F.lit(x) for x in [*cuts, cuts[-1] + span]])
    at = F.least(F.col("_range").cast("int"), F.lit(len(cuts)))
    share_of = (F.col("_as_double") - F.get(low, at)) / (F.get(high, at) - F.get(low, at))
    step = F.greatest(F.lit(0), F.least(F.lit(steps - 1), F.floor(share_of * steps)))
    return out.withColumn("_step", F.when(F.isnan("_as_double"), 0).otherwise(step).cast("bigint")).drop("_as_double")


def running_totals(
    df: DataFrame, key: str, measures: dict[str, Column], rows_per_range: int | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Per distinct non-null ``key``: each measure and, as ``<measure>_before``,
    its total over all smaller keys; plus the overall totals.

    Rows are pre-aggregated per key, so a value that a third of the rows share
    is one row from there on.  Ranges of keys are sorted independently; the
    totals of what comes before a range are summed in two levels, so the one
    window over everything has at most ``MOST`` rows.  Runs two jobs at once
    (totals, cuts).
    """
    rows_per_range = rows_per_range or ROWS_PER_RANGE
    present = df.where(F.col(key).isNotNull())
    head = present.agg(F.count("*").alias("_n"), F.count(_present(key)).alias("_numbers"), *[m.alias(k) for k, m in measures.items()]).first()
    totals = {k: head[k] or 0 for k in measures}
    wanted = -(-head["_n"] // rows_per_range)
    ranges = min(max(wanted, FEWEST), MOST)

    grouped = present.groupBy(key).agg(*[m.alias(k) for k, m in measures.items()])
    ranged = _with_range(grouped, present, key, ranges, max(1, -(-wanted // ranges)), head["_numbers"])
    place = ["_range", "_step"]
    before = Window.partitionBy(*place).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.withColumns({f"{k}_before": F.coalesce(F.sum(k).over(before), F.lit(0)) for k in measures})
    sums = ranged.groupBy(*place).agg(*[F.sum(k).alias(k) for k in measures])
    inside = Window.partitionBy("_range").orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    wide = sums.groupBy("_range").agg(*[F.sum(k).alias(k) for k in measures])
    wide = wide.select("_range", *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"_wide_{k}") for k in measures])
    offsets = sums.select(*place, *[F.coalesce(F.sum(k).over(inside), F.lit(0)).alias(f"_narrow_{k}") for k in measures])
    # Small next to the keys; the planner broadcasts it where its measured size allows.
    out = out.join(offsets.join(wide, "_range"), place)
    out = out.withColumns(
        {f"{k}_before": F.col(f"{k}_before") + F.col(f"_narrow_{k}") + F.col(f"_wide_{k}") for k in measures}
    )
    return out.select(key, *measures, *[f"{k}_before" for k in measures]), totals


def with_percent_rank(df: DataFrame, column: str, name: str = "amount_pct", rows_per_range: int | None = None) -> DataFrame:
    """``percent_rank() over (order by column)`` with nulls first.

    Each distinct value is ranked once and its rank joined back.  Runs three
    jobs at once (row count, totals, cuts).
    """
    head = df.agg(F.count("*").alias("rows"), F.count_if(F.col(column).isNull()).alias("nulls")).first()
    rows, nulls = head["rows"], head["nulls"]
    ranks, _ = running_totals(df, column, {"_n": F.count("*")}, rows_per_range)
    ranks = ranks.withColumn("_pct", (F.col("_n_before") + F.lit(nulls)) / F.lit(float(max(rows - 1, 1))))
    out = attach_by_key(df, ranks, column, "_n", ["_pct"], rows)
    return out.select(*df.columns, F.coalesce("_pct", F.lit(0.0)).alias(name))


def value_at_rank(df: DataFrame, column: str, rank: int) -> float | None:
    """The ``rank``-th smallest present value (1-based), or None beyond the end."""
    n = df.agg(F.count(_present(column))).first()[0]
    return select_ranks(df, [(column, rank)], [n])[0] if 1 <= rank <= n else None
