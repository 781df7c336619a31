"""Gradient boosting as a loop over stored margins.

Each round fits one regression tree to the Newton steps of the log loss, on a
sample of the rows and of the columns.  Columns are cut into bins once for all
rounds, and rows lie in blocks with a byte per bin.  A round keeps the bins and steps of the rows drawn for it; a level of a tree is one
job over them: tasks add up the steps by node, column and bin, and the best cut of each node
is found where the sums meet.  Margins are kept beside the rows and
stored every few rounds: a lost executor costs at most the rounds since then,
and no task holds more trees than that.  With the margins of those rounds the
average precision on held-out rows is computed for all of them in one pass, and
growth stops when it has not improved for a number of rounds.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnfeatures.operators.sampling import HASH_RANGE, row_hash
from txnfeatures.sources.writers import discard, scratch_uri

# The helpers below travel with the tasks: workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The trainer's settings.
ROUNDS, DEPTH, RATE, ROW_SHARE, COLUMN_SHARE, PATIENCE, SEED = 300, 6, 0.05, 0.8, 0.8, 30, 42
#: Rounds between two stores of the margins.
CHUNK = 10
#: Rows whose scores are sorted together, per round, about.
MOST = 1 << 16
#: Decimals of margins that are watched: scores that differ by rounding errors are ties.
DIGITS = 9
#: Curvature below which a row counts as settled.
LEAST_CURVATURE = 1e-6
#: Bins of a column; a column of no more values has a bin for each.
BINS = 32
#: Rows of a block, cells of one at most, columns whose sums travel together, bytes of sums that a task holds and that one adds up.
BLOCK, CELLS, PIECE, HELD, MEET = 1 << 15, 1 << 22, 2048, 1 << 28, 1 << 23
#: Combined bins of columns that are counted together.
JOINT = (BINS + 1) ** 2
BLOCKS = "held_out boolean, n int, bins binary, y binary, weight binary, draw binary, margin binary"
#: Rows from which quantiles of columns of many values are taken, about.
SAMPLE = 1 << 16


@dataclass
class Boosted:
    """The trees up to the best round, and what each round came to.

    ``areas``: average precision on the held-out rows after each round grown
    (empty without held-out rows); ``columns``: the columns each tree could use.
    """

    model: GBTClassificationModel
    best_round: int
    rounds: int
    areas: list[float] = field(default_factory=list)
    columns: list[list[int]] = field(default_factory=list)
    trees: list[DecisionTreeRegressionModel] = field(default_factory=list)
    rate: float = RATE

    def prefix(self, rounds: int) -> GBTClassificationModel:
        """The model after that many rounds."""
        return as_classifier(self.trees[:rounds], self.rate, self.model.getFeaturesCol())


def as_classifier(trees: list[DecisionTreeRegressionModel], rate: float, features: str) -> GBTClassificationModel:
    """Trees of log-odds steps as the library's own classifier, which counts in half log-odds."""
    jvm_trees = [t._java_obj for t in trees]
    context = _context()
    gateway, ml = context._gateway, context._jvm.org.apache.spark.ml
    many = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for i, tree in enumerate(jvm_trees):
        many[i], weights[i] = tree, rate / 2
    uid = ml.classification.GBTClassifier().uid()
    model = ml.classification.GBTClassificationModel(uid, many, weights, trees[0].numFeatures, 2)
    return GBTClassificationModel(model).setFeaturesCol(features)


def _context():
    from pyspark.sql import SparkSession

    return SparkSession.active().sparkContext


def _parted(rows):
    """Labels and scores (row by position) of rows of (scores, label), a block at once."""
    rows = iter(rows)
    while some := list(islice(rows, BLOCK)):
        yield np.array([r[1] for r in some], dtype=float), np.array([r[0] for r in some], dtype=float)


def staged_average_precision(df: DataFrame, scores: str, label: str, ranges: int | None = None) -> list[float | None]:
    """Average precision of every position of the array column ``scores``, in one pass over the rows.

    ``ranges``: into how many the scores of a position are cut; as many as the rows are worth if not given.
    Without a positive row the area is None.
    """
    return _areas(df.select(scores, label).rdd.mapPartitions(_parted), ranges)


def _spread(x: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` rows of an array with sorted columns, evenly spread."""
    return x if len(x) <= n else x[np.linspace(0, len(x) - 1, n).astype(int)]


def _told(score: np.ndarray, pos: np.ndarray, neg: np.ndarray):
    """Distinct scores, descending, with the positive and negative rows of each."""
    score, place = np.unique(-score, return_inverse=True)
    return -score, np.bincount(place, pos, len(score)), np.bincount(place, neg, len(score))


def _areas(rows: RDD, ranges: int | None = None) -> list[float | None]:
    """Average precision of every position of labels and scores (row by position).

    Rows are counted per (position, score) in every block.  Scores are cut into
    ranges at quantiles of their own position and meet by range; the totals of
    the ranges ahead are added, so no task holds all scores of a position.
    """
    share = max(8, SAMPLE // rows.getNumPartitions())

    def sampled(blocks):
        kept, n = [], 0
        for y, scores in blocks:
            kept, n = [_spread(np.sort(np.concatenate([*kept, _spread(np.sort(scores, axis=0), share)]), axis=0), 2 * share)], n + len(y)
        yield from ((_spread(x, share), n) for x in kept)

    found = rows.mapPartitions(sampled).collect()
    if not found:
        return []
    sample = np.sort(np.concatenate([x for x, _ in found]), axis=0)
    ranges = ranges or 1 + sum(n for _, n in found) // MOST
    # Ranges are numbered from the highest scores.
    at = [len(sample) * i // ranges for i in range(1, ranges)]
    cuts = [np.unique(-column[at]) for column in sample.T]

    def ranged(blocks):
        for y, scores in blocks:
            for position, mine in enumerate(cuts):
                score, pos, neg = _told(scores[:, position], y, 1 - y)
                place = np.searchsorted(mine, -score, "right")
                for one in np.unique(place):
                    inside = slice(*np.searchsorted(place, [one, one + 1]))
                    yield (position, int(one)), (score[inside], pos[inside], neg[inside])

    def met(item):
        return item[0], _told(*(np.concatenate(part) for part in zip(*item[1])))

    tasks = min(ranges * len(cuts), 2 * rows.context.defaultParallelism)
    ready = rows.mapPartitions(ranged).groupByKey(max(tasks, ranges * len(cuts) // 16)).map(met).persist(StorageLevel.MEMORY_AND_DISK)
    totals = dict(ready.mapValues(lambda told: (told[1].sum(), told[2].sum())).collect())
    ahead, every = {}, [0.0] * len(cuts)
    for (position, one), (pos, neg) in sorted(totals.items()):
        ahead[position, one] = tuple(np.add(ahead.get(position, (0.0, 0.0)), 0.0))
        ahead[position] = tuple(np.add(ahead[position, one], (pos, neg)))
        every[position] += pos

    def part(item):
        key, (_, pos, neg) = item
        hits, misses = np.cumsum(pos) + ahead[key][0], np.cumsum(neg) + ahead[key][1]
        return key, float((pos * hits / (hits + misses)).sum())

    areas = [0.0] * len(cuts)
    for (position, _), value in sorted(ready.map(part).collect()):
        areas[position] += value
    ready.unpersist()
    return [float(area / pos) if pos else None for area, pos in zip(areas, every)]


def _drawn_columns(n: int, share: float, rng: np.random.Generator) -> list[int]:
    return sorted(rng.choice(n, max(1, int(share * n)), replace=False).tolist())


def _plain(vector: str) -> list[Column]:
    """Kind, indices and values of a vector column: nulls inside of structs and lists are slow to hand to Python."""
    x = F.unwrap_udt(vector)
    return [x["type"].alias("kind"), F.coalesce(x["indices"], F.array().cast("array<int>")).alias("indices"), x["values"].alias("values")]


def _dense(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row and values of slices of a vector column (as ``_plain``), at most ``CELLS`` values at once (one row at least)."""
    kinds, indices, values = (batch.column(i) for i in range(3))
    kinds = kinds.to_numpy(zero_copy_only=False)
    flat, ends = values.values.to_numpy(zero_copy_only=False), values.offsets.to_numpy()
    step = max(1, CELLS // width)
    for first in range(0, len(kinds), step):
        last = min(len(kinds), first + step)
        if (kinds[first:last] == 1).all():
            yield first, flat[ends[first] : ends[last]].reshape(-1, width)
            continue
        out = np.zeros((last - first, width))
        at, places = indices.offsets.to_numpy(), indices.values.to_numpy(zero_copy_only=False)
        full = np.flatnonzero(kinds[first:last] == 1)
        if len(full):
            out[full] = flat[(ends[first + full, None] + np.arange(width)).ravel()].reshape(-1, width)
        some = np.flatnonzero(kinds[first:last] != 1)
        many = at[first + some + 1] - at[first + some]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        out[np.repeat(some, many), places[np.repeat(at[first + some], many) + within]] = flat[np.repeat(ends[first + some], many) + within]
        yield first, out


def _few_values(width: int):
    """Per task and column, its values as long as they are no more than ``BINS``."""

    def few(batches):
        known: list[np.ndarray | None] = [np.empty(0)] * width
        for batch in batches:
            for _, x in _dense(batch, width):
                if not np.isfinite(x).all():
                    raise ValueError("features to fit must not be missing or infinite")
                for at in range(width):
                    if known[at] is not None:
                        found = np.union1d(known[at], x[:, at])
                        known[at] = found if len(found) <= BINS + 1 else None
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(known, pa.list_(pa.float64()))],
            names=["at", "values"],
        )

    return few


def _quantiles(group: pd.DataFrame) -> pd.DataFrame:
    """Cuts of one column of many values; a value that holds several quantiles has a bin of its own."""
    values = np.sort(group["value"].to_numpy())
    q = values[[len(values) * i // BINS for i in range(1, BINS)]]
    q = np.union1d(q, np.nextafter(q[1:][q[1:] == q[:-1]], -np.inf))
    return pd.DataFrame({"at": group["at"].iloc[:1], "cuts": [q[(q >= values[0]) & (q < values[-1])]]})


def column_cuts(df: DataFrame, features: str, row: str, n_rows: int) -> list[np.ndarray]:
    """Ascending cuts of every column of a vector column; a value lies in the bin numbered by the cuts below it.

    Columns of at most ``BINS`` values are cut between them, the others at
    quantiles of about ``SAMPLE`` rows, chosen by a hash of the row's number
    (the library's own trees take 10,000 rows for that).
    """
    width = df.select(features).first()[0].size
    few = df.select(*_plain(features)).mapInArrow(_few_values(width), "at int, values array<double>")
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_list("values")))).alias("values")
    merged = few.groupBy("at").agg(F.bool_or(F.col("values").isNull()).alias("many"), every)
    cuts: list[np.ndarray] = [np.empty(0)] * width
    many = []
    for r in merged.select("at", F.when(~F.col("many") & (F.size("values") <= BINS), F.col("values")).alias("values")).toLocalIterator():
        if r["values"] is None:
            many.append(r["at"])
            continue
        low, high = np.array(r["values"][:-1]), np.array(r["values"][1:])
        with np.errstate(invalid="ignore"):
            middle = low + (high - low) / 2
        cuts[r["at"]] = np.where((low <= middle) & (middle < high), middle, low)
    if many:
        chosen = df.where(row_hash(row) < F.lit(min(HASH_RANGE, HASH_RANGE * SAMPLE // n_rows)))
        values = chosen.select(F.posexplode(vector_to_array(features)).alias("at", "value"))
        for r in values.where(F.col("at").isin(many)).groupBy("at").applyInPandas(_quantiles, "at int, cuts array<double>").toLocalIterator():
            cuts[r["at"]] = np.array(r["cuts"])
    return cuts


def _blocks(cuts: list[np.ndarray]):
    """Rows of (vector, label, weight, draw, held out) as blocks of bins, held-out rows apart."""
    width = len(cuts)
    most = max(1, min(BLOCK, CELLS // width))

    def pack(batches):
        open_rows: dict[bool, list] = {False: [], True: []}

        def close(held: bool, whole: bool):
            columns = [np.concatenate(part) for part in zip(*open_rows[held])]
            open_rows[held] = []
            for first in range(0, len(columns[0]), most):
                some = [c[first : first + most] for c in columns]
                n = len(some[0])
                if n < most and not whole:
                    open_rows[held] = [tuple(some)]
                    return
                cells = (some[0].T.tobytes(), *(c.tobytes() for c in some[1:]), np.zeros(n).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([held]), pa.array([n], pa.int32()), *(pa.array([c], pa.binary()) for c in cells)],
                    names=["held_out", "n", "bins", "y", "weight", "draw", "margin"],
                )

        for batch in batches:
            y, weight, draw, held = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5, 6))
            draw = draw.astype(np.uint32)
            for first, x in _dense(batch, width):
                bins = np.empty(x.shape, np.uint8)
                for at, edges in enumerate(cuts):
                    bins[:, at] = np.searchsorted(edges, x[:, at])
                for side in (False, True):
                    mine = np.flatnonzero(held[first : first + len(x)].astype(bool) == side)
                    if len(mine):
                        open_rows[side].append((bins[mine], *(c[first + mine] for c in (y, weight, draw))))
                        if sum(len(part[1]) for part in open_rows[side]) >= most:
                            yield from close(side, False)
        for side in (False, True):
            if open_rows[side]:
                yield from close(side, True)

    return pack


class Tree:
    """A tree over bins.  Children of a node are neighbours; a leaf leads to itself.

    ``stats``: rows, weight, weighted sum and sum of squares of the steps at each node.
    """

    def __init__(self, stats):
        self.column, self.cut, self.left = np.zeros(1, np.int64), np.full(1, 255, np.uint8), np.zeros(1, np.int64)
        self.gain, self.stats, self.depth = np.zeros(1), np.array([stats], dtype=float), 0

    def split(self, node: int, gain: float, column: int, cut: int, left: np.ndarray, right: np.ndarray) -> list[int]:
        at = len(self.left)
        self.column[node], self.cut[node], self.left[node], self.gain[node] = column, cut, at, gain
        self.column, self.gain = np.append(self.column, [0, 0]), np.append(self.gain, [0.0, 0.0])
        self.cut, self.left = np.append(self.cut, np.full(2, 255, np.uint8)), np.append(self.left, [at, at + 1])
        self.stats = np.vstack([self.stats, left, right])
        return [at, at + 1]

    @property
    def values(self) -> np.ndarray:
        return np.divide(self.stats[:, 2], self.stats[:, 1], out=np.zeros(len(self.stats)), where=self.stats[:, 1] > 0)

    @property
    def impurities(self) -> np.ndarray:
        square = np.divide(self.stats[:, 3], self.stats[:, 1], out=np.zeros(len(self.stats)), where=self.stats[:, 1] > 0)
        return np.maximum(square - self.values**2, 0.0)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """Where each row of a block (column by row) ends: every node's rows are a mask, split by one comparison of its column."""
        kind = np.min_scalar_type(len(self.left))
        node = np.zeros(bins.shape[1], kind)
        open_masks = [(0, np.ones(bins.shape[1], bool))]
        while open_masks:
            at, mine = open_masks.pop()
            left = int(self.left[at])
            if left == at:
                node |= mine.view(np.uint8) * kind.type(at)
                continue
            right = bins[self.column[at]] > self.cut[at]
            right &= mine
            mine ^= right
            open_masks += [(left + 1, right), (left, mine)]
        return node


def _advance(margin: np.ndarray, trees: list[Tree], rate: float, bins: np.ndarray) -> Iterator[np.ndarray]:
    for tree in trees:
        margin = margin + rate * tree.values.take(tree.nodes(bins))
        yield margin


def _block(row):
    return (*row[:2], *map(bytes, row[2:]))


def _unpacked(block):
    """Bins (column by row), labels, weights, draws and margins of a block (a row of ``BLOCKS``)."""
    _, n, bins, y, weight, draw, margin = block
    return np.frombuffer(bins, np.uint8).reshape(-1, n), np.frombuffer(y), np.frombuffer(weight), np.frombuffer(draw, np.uint32), np.frombuffer(margin)


def _is_drawn(draw: np.ndarray, share: float, seed: int) -> np.ndarray:
    """Whether each row takes part in a round, by its 32 random bits mixed with those of the round."""
    with np.errstate(over="ignore"):
        x = draw ^ np.random.default_rng(seed).integers(1 << 32, dtype=np.uint32)
        for factor, shift in ((0x9E3779B1, 15), (0x85EBCA77, 13), (0xC2B2AE3D, 16)):
            x = x * np.uint32(factor)
            x ^= x >> np.uint32(shift)
    return x < share * 2.0**32


def _grouped(drawn: list[int], sizes: list[int], nodes: int) -> list[list[int]]:
    """Columns whose bins are counted together: one count by all their bins gives the counts of each."""
    groups, product = [], JOINT + 1
    for c in sorted(drawn, key=lambda c: sizes[c]):
        if product * sizes[c] > JOINT:
            groups.append([])
            product = 1
        groups[-1].append(c)
        product *= sizes[c]
    bins = sum(int(np.prod([sizes[c] for c in group])) for group in groups)
    return groups if 32 * bins * nodes <= HELD // 8 else [[c] for c in drawn]


def _drawn_rows(fresh: list[Tree], rate: float, share: float, seed: int):
    """The rows of a block that take part in a round: their bins, and the weights and steps that their margins leave."""

    def drawn_rows(block):
        bins, y, weight, draw, margin = _unpacked(block)
        for margin in _advance(margin, fresh, rate, bins):
            pass
        rows = np.flatnonzero(_is_drawn(draw, share, seed))
        y, weight, margin = y.take(rows), weight.take(rows), margin.take(rows)
        with np.errstate(over="ignore"):
            p = 1 / (1 + np.exp(-margin))
        curve = np.maximum(p * (1 - p), LEAST_CURVATURE)
        return len(rows), bins.take(rows, axis=1).tobytes(), (weight * curve).tobytes(), (weight * (y - p)).tobytes()

    return drawn_rows


def _sums(tree: Tree | None, slots: dict[int, int], drawn: list[int], groups: list[list[int]], sizes: list[int]):
    """Sums of a task's drawn rows by (open node, piece of columns): rows, weight, steps and their squares by bin."""

    def sums(blocks):
        shapes = [[sizes[c] for c in group] for group in groups]
        counts = [int(np.prod(shape)) for shape in shapes]
        ends = np.concatenate(([0], np.cumsum(counts)))
        joint = np.zeros((len(slots), 4, ends[-1]))
        if tree is not None:
            places = np.full(len(tree.left), -1, np.int64)
            places[list(slots)] = list(slots.values())
        for n, bins, weight, step in blocks:
            bins, weight, step, base = np.frombuffer(bins, np.uint8).reshape(-1, n), np.frombuffer(weight), np.frombuffer(step), np.zeros(n, np.int64)
            rows = None
            if tree is not None:
                base = places.take(tree.nodes(bins))
                rows = np.flatnonzero(base >= 0)
                base, weight, step = base.take(rows), weight.take(rows), step.take(rows)
            parts = (None, weight, step, np.divide(step * step, weight, out=np.zeros(len(step)), where=weight > 0))
            for group, shape, count, end in zip(groups, shapes, counts, ends):
                place = base
                for c, size in zip(group, shape):
                    place = place * size
                    place += bins[c] if rows is None else bins[c].take(rows)
                for i, part in enumerate(parts):
                    joint[:, i, end : end + count] += np.bincount(place, part, len(slots) * count).reshape(len(slots), count)
        alone = {}
        for group, shape, count, end in zip(groups, shapes, counts, ends):
            whole = joint[:, :, end : end + count].reshape(len(slots), 4, *shape)
            for i, c in enumerate(group):
                alone[c] = whole.sum(axis=tuple(2 + j for j in range(len(group)) if j != i))
        for first in range(0, len(drawn), PIECE):
            some = np.concatenate([alone[c] for c in drawn[first : first + PIECE]], axis=2)
            for slot in range(len(slots)):
                yield (slot, first), some[slot]

    return sums


def _best(drawn: list[int], sizes: list[int]):
    """The cut of a node that takes most variance away, among a piece of the columns: (node's sums, gain, column, cut, sums left of it)."""

    def best(item):
        (slot, first), sums = item
        columns = drawn[first : first + PIECE]
        count = np.array([sizes[c] for c in columns])
        ends = np.cumsum(count)
        run = np.cumsum(sums, axis=1)
        edge = np.concatenate((np.zeros((4, 1)), run[:, ends - 1]), axis=1)
        left = run - np.repeat(edge[:, :-1], count, axis=1)
        whole = np.repeat(np.diff(edge, axis=1), count, axis=1)
        right = whole - left
        total = sums[:, : ends[0]].sum(axis=1)
        fits = (left[0] > 0.5) & (right[0] > 0.5) & (left[1] > 0) & (right[1] > 0)
        gain = np.full(run.shape[1], -np.inf)
        (_, lw, ls, _), (_, rw, rs, _), (_, w, s, _) = left[:, fits], right[:, fits], whole[:, fits]
        gain[fits] = (ls * ls / lw + rs * rs / rw - s * s / w) / w
        at = int(np.argmax(gain))
        column = int(np.searchsorted(ends, at, "right"))
        return slot, (total, float(gain[at]), columns[column], int(at - ends[column] + count[column]), left[:, at])

    return best


def _smaller(tree: Tree | None, open_nodes: list[int]) -> dict[int, int | None]:
    """Of each pair of children the one of fewer rows, and the other where it is open: what it holds is the rest of the parent's."""
    if tree is None:
        return {0: None}
    asked = {}
    for left in dict.fromkeys(n - 1 + n % 2 for n in open_nodes):  # children are numbered (1, 2), (3, 4), ...
        few = left + int(tree.stats[left + 1, 0] < tree.stats[left, 0])
        asked[few] = 2 * left + 1 - few
    return asked


def grow_tree(blocks: RDD, fresh: list[Tree], drawn: list[int], sizes: list[int], depth: int, rate: float, share: float, seed: int) -> Tree:
    """A tree for the steps that the rows' margins and the ``fresh`` trees leave: one job a level, of bounded size.

    Where the sums of a level are a few MB, those of all nodes are kept for the
    next level: only the smaller child of each pair is summed up there, the
    other one is what is left of their parent.
    """
    ready = blocks.map(_drawn_rows(fresh, rate, share, seed)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _grown(ready, drawn, sizes, depth)
    finally:
        ready.unpersist()


def _grown(ready: RDD, drawn: list[int], sizes: list[int], depth: int) -> Tree:
    bins, tasks = sum(sizes[c] for c in drawn), ready.getNumPartitions()
    narrow = 32 * bins << depth <= MEET
    groups = _grouped(drawn, sizes, 1 << depth) if narrow else [[c] for c in drawn]
    at_once = 1 << depth if narrow else max(1, HELD // (32 * bins))
    best = _best(drawn, sizes)
    tree, open_nodes, parents = None, [0], {}
    for level in range(depth):
        found, kept = {}, {}
        pairs = _smaller(tree, open_nodes) if narrow else dict.fromkeys(open_nodes)
        asked = list(pairs)
        for first in range(0, len(asked), at_once):
            some = asked[first : first + at_once]
            sums = ready.mapPartitions(_sums(tree, {node: i for i, node in enumerate(some)}, drawn, groups, sizes))
            # Sums of a few MB meet in the driver, larger ones in as many tasks as they are worth.
            reducers = 32 * bins * len(some) * tasks // MEET
            if not narrow:
                for slot, cut in sums.reduceByKey(np.add, 1 + reducers).map(best).collect():
                    node = some[slot]
                    if node not in found or (cut[1], -cut[2]) > (found[node][1], -found[node][2]):
                        found[node] = cut
                continue
            if reducers:
                sums = sums.reduceByKey(np.add, 1 + reducers)
            for (slot, piece), part in sums.collect():
                key = some[slot], piece
                kept[key] = kept[key] + part if key in kept else part
        if narrow:
            for (node, piece), part in list(kept.items()):
                other = pairs[node]
                if other is not None:
                    rest = parents[(min(node, other), piece)] - part
                    rest[:, rest[0] < 0.5] = 0.0
                    kept[other, piece] = rest
            for (node, piece), part in kept.items():
                cut = best(((node, piece), part))[1]
                if node not in found or (cut[1], -cut[2]) > (found[node][1], -found[node][2]):
                    found[node] = cut
        tree = tree or Tree(found[0][0])
        following, parents, square = [], {}, np.divide(tree.stats[:, 3], tree.stats[:, 1], out=np.zeros(len(tree.stats)), where=tree.stats[:, 1] > 0)
        for node in open_nodes:
            total, gain, column, cut, left = found[node]
            # Less than rounding errors come to is no gain.
            if gain > 1e-12 * square[node]:
                children = tree.split(node, gain, column, cut, left, total - left)
                following += children
                parents.update({(children[0], piece): part for (at, piece), part in kept.items() if at == node})
        if not following:
            break
        tree.depth = level + 1
        varied = tree.impurities > 1e-15
        open_nodes = [n for n in following if tree.stats[n, 0] > 1.5 and varied[n]]
        if not open_nodes:
            break
    return tree


def as_regressor(tree: Tree, cuts: list[np.ndarray]) -> DecisionTreeRegressionModel:
    """A tree over bins as the library's own, over values."""
    context = _context()
    jvm, ml = context._jvm, context._jvm.org.apache.spark.ml
    leaf, internal, split, held = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    part = jvm.java.util.Arrays.copyOfRange
    # All sums at once, then a call for each node.
    sums = context._gateway.new_array(context._gateway.jvm.double, 3 * len(tree.left))
    jvm.java.nio.ByteBuffer.wrap(tree.stats[:, 1:].astype(">f8").tobytes()).asDoubleBuffer().get(sums)
    values, impurities, gains, rows = tree.values.tolist(), tree.impurities.tolist(), tree.gain.tolist(), np.round(tree.stats[:, 0]).astype(int).tolist()
    nodes = [None] * len(values)
    # Children come after their parents.
    for at in reversed(range(len(values))):
        stats = held(part(sums, 3 * at, 3 * at + 3), rows[at])
        left, column = int(tree.left[at]), int(tree.column[at])
        if left == at:
            nodes[at] = leaf(values[at], impurities[at], stats)
        else:
            cut = split(column, float(cuts[column][tree.cut[at]]))
            nodes[at] = internal(values[at], impurities[at], gains[at], nodes[left], nodes[left + 1], cut, stats)
    uid = ml.regression.DecisionTreeRegressor().uid()
    return DecisionTreeRegressionModel(ml.regression.DecisionTreeRegressionModel(uid, nodes[0], len(cuts)))


def _stepping(trees: list[Tree], rate: float):
    """Labels and margins after each of the trees, of every row of a block."""

    def stepping(block):
        bins, y, _, _, margin = _unpacked(block)
        return y, np.round(np.stack(list(_advance(margin, trees, rate, bins)), axis=1), DIGITS)

    return stepping


def _moved(trees: list[Tree], rate: float):
    """A block with its margins after the trees."""

    def moved(block):
        bins, _, _, _, margin = _unpacked(block)
        for margin in _advance(margin, trees, rate, bins):
            pass
        return (*block[:-1], margin.tobytes())

    return moved


def boost(
    df: DataFrame,
    features: str,
    label: str = "label",
    weight: str | None = None,
    validation: str | None = None,
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    rate: float = RATE,
    row_share: float = ROW_SHARE,
    column_share: float = COLUMN_SHARE,
    patience: int = PATIENCE,
    chunk: int = CHUNK,
    seed: int = SEED,
) -> Boosted:
    """Trees on the vector column ``features`` for a 0/1 label.

    ``validation`` names a boolean column.  Its true rows are not fitted; growth
    stops once their average precision has not risen for ``patience`` rounds, or
    after ``rounds``, and the trees up to the best round are kept.  Rounds are
    grown ``chunk`` at a time and cut back to ``patience`` beyond the best one.
    Raises where no row is left to fit, one of them misses something, or no held-out row is positive.
    """
    spark = df.sparkSession
    held_out = F.col(validation) if validation else F.lit(False)
    rows = df.select(
        F.col(features).alias("x"),
        F.col(label).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.monotonically_increasing_id().alias("row"),
    )
    uri, given = scratch_uri(spark, "margins"), scratch_uri(spark, "to-boost")
    rows.write.parquet(given)
    rows = spark.read.parquet(given)
    unknown = F.col("y").isNull() | F.isnan("y") | F.col("weight").isNull() | F.isnan("weight") | (F.col("weight") < 0)
    head = rows.agg(
        F.count_if(~F.col("held_out")).alias("fit"),
        F.count_if(F.col("held_out") & (F.col("y") == 1)).alias("hits"),
        F.count_if(F.col("x").isNull() | (~F.col("held_out") & unknown)).alias("unknown"),
    ).first()
    if not head["fit"]:
        raise ValueError("no row to fit")
    if head["unknown"]:
        raise ValueError(f"{head['unknown']} rows to fit without features, label or weight")
    if validation and not head["hits"]:
        raise ValueError("no held-out row is positive: nothing to watch")
    cuts = column_cuts(rows.where(~F.col("held_out")), "x", "row", head["fit"])
    width, sizes = len(cuts), [len(c) + 1 for c in cuts]
    # Blocks are dealt evenly: a level takes as long as its longest task.
    context = spark.sparkContext
    packed = rows.select(*_plain("x"), "y", "weight", F.xxhash64("row").bitwiseAND(F.lit(0xFFFFFFFF)).alias("draw"), "held_out").mapInArrow(_blocks(cuts), BLOCKS)
    packed.repartition(context.defaultParallelism).rdd.map(_block).saveAsPickleFile(uri, batchSize=1)
    discard(spark, given)
    rng = np.random.default_rng(seed)
    grown, areas, columns, best = [], [], [], 0
    while len(grown) < rounds:
        fresh = []
        state = context.pickleFile(uri)
        # Read once for the rounds of the chunk; what is lost is read again.
        blocks = state.filter(lambda block: not block[0]).persist(StorageLevel.MEMORY_AND_DISK)
        for _ in range(min(chunk, rounds - len(grown))):
            t = len(grown) + len(fresh)
            columns.append(_drawn_columns(width, column_share, rng))
            fresh.append(grow_tree(blocks, fresh, columns[-1], sizes, depth, rate, row_share, seed + t))
        blocks.unpersist()
        grown += fresh
        if validation:
            areas += _areas(state.filter(lambda block: block[0]).map(_stepping(fresh, rate)))
            best = 1 + int(np.argmax(areas))
            # Rounds count one by one, whatever the chunk: the first best with no better one within the patience ends it.
            high, at = -1.0, 0
            for i, area in enumerate(areas, 1):
                if area > high:
                    high, at = area, i
                elif i - at >= patience:
                    break
            if i - at >= patience:
                best, grown, areas, columns = at, grown[:i], areas[:i], columns[:i]
                break
        else:
            best = len(grown)
        if len(grown) < rounds:
            following = scratch_uri(spark, "margins")
            state.map(_moved(fresh, rate)).saveAsPickleFile(following, batchSize=1)
            discard(spark, uri)
            uri = following
    discard(spark, uri)
    trees = [as_regressor(tree, cuts).setFeaturesCol(features) for tree in grown]
    return Boosted(as_classifier(trees[:best], rate, features), best, len(trees), areas, columns, trees, rate)
