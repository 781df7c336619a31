"""Exact order statistics without sorting or collecting the data.

``select_ranks`` narrows an open interval around each wanted rank.  A round is
two aggregate jobs over the pruned columns: a sketch proposes probe values
around the rank, then exact counts below the probes decide between which two of
them it lies.  A round leaves less than a thousandth of the rows, so three jobs
serve 10**8 rows and five 10**11.
The sketch only steers; the counts decide, so a bad sketch costs a round and
never a wrong answer.  Ties cannot stall it: a probe that carries the wanted
rank is itself the answer, and otherwise leaves the interval with all its
copies.  What comes to the driver per round is one row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnfeatures.functions.scalar import as_double

# Rows one task may hold in an exact percentile aggregate.
SMALL_GROUP = 100_000
# Sketch size, and how far from the wanted share the probes lie: about the
# sketch's error, well beyond it, and closer in case it is better than that.
SKETCH_K = 4096
OFFSETS = [0.001, 0.005, 0.0003, 0.0001, 0.00003, 0.00001, 0.000003]
# Probes of one counting job, over all columns.
PROBES = 64
# First-level groups of the sketch tree.
SKETCH_FANIN = 256


def _present(c) -> Column:
    x = as_double(c)
    return F.when(~F.isnan(x), x)


@dataclass
class _Target:
    """One wanted rank and the open interval its value is known to lie in."""

    name: str
    rank: int
    inside: int
    below: int = 0
    lo: float | None = None
    hi: float | None = None
    found: float | None = None

    @property
    def interval(self) -> tuple[str, float | None, float | None]:
        return self.name, self.lo, self.hi


def _inside(interval) -> Column:
    name, lo, hi = interval
    x = _present(name)
    keep = x.isNotNull()
    if lo is not None:
        keep = keep & (F.col(name) > lo)
    if hi is not None:
        keep = keep & (F.col(name) < hi)
    return keep


def _narrowed(interval) -> Column:
    return F.when(_inside(interval), _present(interval[0]))


def _rows_inside(df: DataFrame, intervals) -> DataFrame:
    """Only rows some interval can use; plain comparisons, so that a scan can
    skip on them."""
    tests = []
    for name, lo, hi in intervals:
        bounds = ([F.col(name) > lo] if lo is not None else []) + ([F.col(name) < hi] if hi is not None else [])
        if not bounds:
            return df
        tests.append(reduce(and_, bounds))
    return df.where(reduce(or_, tests))


def sketch_quantiles(df: DataFrame, wanted: dict[str, tuple[Column, list[float]]]) -> dict[str, list[float]]:
    """Approximate quantiles of several columns in one job.

    Every task makes one sketch per column; the sketches are merged in two
    levels so that no single task receives one from every input split.
    """
    names = list(wanted)
    leaves = df.select(
        (F.spark_partition_id() % SKETCH_FANIN).alias("leaf"),
        *[wanted[n][0].alias(f"v{i}") for i, n in enumerate(names)],
    )
    merged = leaves.groupBy("leaf").agg(
        *[F.kll_sketch_agg_double(f"v{i}", SKETCH_K).alias(f"s{i}") for i in range(len(names))]
    ).agg(*[F.kll_merge_agg_double(f"s{i}", SKETCH_K).alias(f"s{i}") for i in range(len(names))])
    row = merged.select(
        *[
            F.kll_sketch_get_quantile_double(f"s{i}", F.array(*[F.lit(float(q)) for q in wanted[n][1]])).alias(f"q{i}")
            for i, n in enumerate(names)
        ]
    ).first()
    return {n: list(row[i]) for i, n in enumerate(names)}


def _narrow(df: DataFrame, targets: list[_Target]) -> None:
    at: dict[tuple, list[float]] = {}
    for t in targets:
        at.setdefault(t.interval, []).append((t.rank - t.below) / t.inside)
    offsets = OFFSETS[: max(2, PROBES // (2 * len(at)))]
    shares = {
        iv: {max(min(a) - o, 0.0) for o in offsets} | {min(max(a) + o, 1.0) for o in offsets} for iv, a in at.items()
    }
    intervals = list(shares)
    rows = _rows_inside(df, intervals)

    asks = {str(i): (_narrowed(iv), sorted(shares[iv])) for i, iv in enumerate(intervals)}
    probes = {iv: sorted(set(q)) for iv, q in zip(intervals, sketch_quantiles(rows, asks).values())}
    counts = []
    for i, iv in enumerate(intervals):
        for j, p in enumerate(probes[iv]):
            counts.append(F.count_if(_inside(iv) & (F.col(iv[0]) < p)).alias(f"lt{i}_{j}"))
            counts.append(F.count_if(_inside(iv) & (F.col(iv[0]) <= p)).alias(f"le{i}_{j}"))
    seen = rows.agg(*counts).first()

    for t in targets:
        i, base, top = intervals.index(t.interval), t.below, t.below + t.inside
        for j, p in enumerate(probes[intervals[i]]):
            lt, le = base + seen[f"lt{i}_{j}"], base + seen[f"le{i}_{j}"]
            if lt < t.rank <= le:
                t.found = p
                break
            if t.rank <= lt:
                t.hi, top = p, lt
                break
            t.lo, t.below = p, le
        t.inside = top - t.below


def select_ranks(df: DataFrame, wanted: list[tuple[str, int]], counts: list[int], small: int | None = None) -> list[float]:
    """The values at 1-based ``(column, rank)`` pairs; ``counts`` are the
    numbers of present values of those columns."""
    small = SMALL_GROUP if small is None else small
    columns = list(dict.fromkeys(c for c, _ in wanted))
    values = df.select(*[as_double(c).alias(c) for c in columns])
    targets = [_Target(c, r, n) for (c, r), n in zip(wanted, counts)]
    # One round at any size, more while a task would get too many rows.
    _narrow(values, targets)
    while wide := [t for t in targets if t.found is None and t.inside > small]:
        _narrow(values, wide)

    rest = [t for t in targets if t.found is None]
    if rest:
        intervals = list(dict.fromkeys(t.interval for t in rest))
        # Half a step inside the wanted rank, so rounding cannot move the pick.
        picks = [(intervals.index(t.interval), (t.rank - t.below - 0.5) / t.inside) for t in rest]
        row = (
            _rows_inside(values, intervals)
            .select(*[_narrowed(iv).alias(f"x{i}") for i, iv in enumerate(intervals)])
            .agg(*[F.expr(f"percentile_disc({p!r}D) WITHIN GROUP (ORDER BY x{i})") for i, p in picks])
            .first()
        )
        for i, t in enumerate(rest):
            t.found = row[i]
    return [t.found for t in targets]


def _ranks_for(q: float, n: int, method: str) -> tuple[list[int], float]:
    """1-based ranks to fetch and the weight of the second one."""
    if method == "disc":
        return [max(1, math.ceil(Decimal(str(q)) * n))], 0.0
    at = Decimal(str(q)) * (n - 1)
    low = math.floor(at)
    return [low + 1, min(low + 2, n)], float(at - low)


def exact_quantiles(
    df: DataFrame, wanted: dict[str, float], method: str = "disc", small: int | None = None
) -> dict[str, float | None]:
    """Exact quantile per column, missing values left out.

    ``disc`` is the smallest value with at least a share ``q`` of rows at or
    below it; ``linear`` interpolates between the two nearest ranks.
    """
    names = list(wanted)
    row = df.agg(*[F.count(_present(c)).alias(f"n{i}") for i, c in enumerate(names)]).first()
    return quantiles_with_counts(df, wanted, {c: row[i] for i, c in enumerate(names)}, method, small)


def quantiles_with_counts(
    df: DataFrame, wanted: dict[str, float], counts: dict[str, int], method: str, small: int | None = None
) -> dict[str, float | None]:
    """``exact_quantiles`` for callers that already know the present counts."""
    if method not in ("disc", "linear"):
        raise ValueError(f"method must be 'disc' or 'linear', not {method!r}")
    asks, ns, plan = [], [], {}
    for c, q in wanted.items():
        if counts[c]:
            ranks, weight = _ranks_for(q, counts[c], method)
            plan[c] = (range(len(asks), len(asks) + len(ranks)), weight)
            asks += [(c, r) for r in ranks]
            ns += [counts[c]] * len(ranks)
    values = select_ranks(df, asks, ns, small) if asks else []
    out: dict[str, float | None] = dict.fromkeys(wanted)
    for c, (at, weight) in plan.items():
        low, high = values[at[0]], values[at[-1]]
        out[c] = low + (high - low) * weight if weight else low
    return out


def quantile(df: DataFrame, column: str, q: float, method: str = "disc") -> float | None:
    """One quantile: ``disc`` and ``linear`` are exact; ``approx`` (rank error
    1/10000 of the rows) and ``gk`` (1/100) are single-pass sketches."""
    if method in SKETCH_ACCURACY:
        return df.agg(F.percentile_approx(_present(column), q, SKETCH_ACCURACY[method])).first()[0]
    return exact_quantiles(df, {column: q}, method)[column]


# Accuracy of the approximate quantile in the two contract versions.
SKETCH_ACCURACY = {"approx": 10_000, "gk": 100}
