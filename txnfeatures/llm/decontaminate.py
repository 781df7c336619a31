"""Benchmark decontamination: rare word pairs as seeds, joined with the texts, then local alignment.

An alignment that keeps ``least_percent`` of the full score loses no more than
the rest of it, and each pair of neighbouring words of the item that it does not keep costs at
least one point.  So of any ``loss + m`` pairs of an item it keeps ``m``: the
rarest so many, by the texts that hold them, are the item's seeds, and a text
that holds fewer than ``m`` of them holds no copy.  Seeds and the word pairs of texts meet in one
join on the pair's hash, however many items there are; a bitmap of fixed size
spares the shuffle pairs that no item has.  Texts with enough seeds of an item
meet the item's words, each distinct text once.  There all pairs of the item show where as many lie
together as an alignment keeps, and Smith-Waterman alignment of the words scores
these windows.  No alignment above the threshold is lost on the way.  Items so
short that no pair need be kept go by single words.  Copies with words changed,
left out or put in still align.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txnfeatures.llm.bitmap import is_present, place, presence
from txnfeatures.llm.store import Run, stored
from txnfeatures.llm.words import Words, run_hashes, text_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Scores of equal words, of different words, of a word more or less.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Least share, in per cent, of the score of an exact copy of the whole item.
LEAST_PERCENT = 60
#: Seeds that a text must hold, where an alignment keeps as many.
SEEDS = 3
#: About as many items meet a text in one row; a text with more is repeated.
PACK = 1024
#: Windows aligned at once, and cells of theirs (a wider window goes by itself).
AT_ONCE, CELLS = 2048, 1 << 20
#: Seed hits looked at together; the hits of one text are never split.
HITS = 1 << 21


class Items:
    """Test items as word hashes, and the word pairs (or words) to look for."""

    def __init__(self, texts: list[str], least_percent: int):
        words, grams = [], {1: [], 2: []}
        for _, rows, data, offsets in text_chunks(pa.array(texts, pa.large_string())):
            w = Words(data, offsets)
            h = w.hashes()
            words += [h[w.first[i] : w.first[i + 1]] for i in range(rows)]
            for size in grams:
                g, at = run_hashes(h, w.first, size)
                grams[size] += [g[at[i] : at[i + 1]] for i in range(rows)]
        self.words = words
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        #: Most points an alignment may lose; each lost pair costs at least one.
        self.loss = (100 - least_percent) * MATCH * self.lengths // 100
        pairs = self.lengths - 1 - self.loss
        size = np.where(pairs > 0, 2, 1)
        #: Seeds that an alignment keeps at least.
        self.need = np.where(pairs > 0, pairs, np.maximum(-(-least_percent * self.lengths // 100), 1))
        self.seeds = {n: self._sorted([g if size[i] == n else g[:0] for i, g in enumerate(found)]) for n, found in grams.items()}

    def wanted(self, size: int, item: np.ndarray) -> np.ndarray:
        """Rarest pairs (words) of each item of which :data:`SEEDS`, or as many as are kept, are in any copy."""
        return self.lengths[item] - (size - 1) - self.need[item] + np.minimum(SEEDS, self.need[item])

    @staticmethod
    def _sorted(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, item, place in the item), sorted by hash."""
        gram = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams]).astype(np.int64)
        at = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(gram, kind="stable")
        return gram[order], item[order], at[order]


def align(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of ``item`` with each row of ``windows`` (0 pads), and the column where it ends.

    One row of the matrix at a time; a run of gaps along the row is a running
    maximum once the price of each step is added back.
    """
    n, width = windows.shape
    steps = np.arange(1, width + 1) * -GAP
    score = np.zeros((n, width + 1), dtype=np.int32)
    best, end = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int64)
    for word in item:
        step = np.where(windows == word, MATCH, MISMATCH)
        row = np.maximum(score[:, :-1] + step, score[:, 1:] + GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum(row, np.maximum.accumulate(row + steps, axis=1) - steps)
        score[:, 1:] = row
        top = row.argmax(1)
        value = row[np.arange(n), top]
        end = np.where(value > best, top, end)
        best = np.maximum(best, value)
    return best, end


def spans(text: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Merge overlapping windows (all in one text and item); inputs sorted by (text, item, low)."""
    top = np.maximum.accumulate(high + (np.cumsum(np.concatenate(([0], (np.diff(text) != 0) | (np.diff(item) != 0)))) << 40))
    group = np.concatenate(([0], np.cumsum((np.diff(text) != 0) | (np.diff(item) != 0))))
    opens = np.concatenate(([True], (low[1:] + (group[1:] << 40)) > top[:-1]))
    at = np.flatnonzero(opens)
    return text[at], item[at], low[at], np.maximum.reduceat(high, at)


def _dense(items: Items, text: np.ndarray, item: np.ndarray, place: np.ndarray, at: np.ndarray):
    """The hits that lie among as many of their item, on a stretch as short, as an alignment above the threshold has."""
    order = np.lexsort((place, item, text))
    text, item, place, at = text[order], item[order], place[order], at[order]
    group = np.concatenate(([0], np.cumsum((np.diff(text) != 0) | (np.diff(item) != 0))))
    # An alignment keeps each seed at a place of its own.
    opens = np.concatenate(([True], (np.diff(group) != 0) | (np.diff(place) != 0)))
    spot = np.cumsum(opens) - 1
    first = np.flatnonzero(opens)
    here, where, kind = group[first], place[first], item[first]
    last = np.arange(len(first)) + items.need[kind] - 1
    inside = np.flatnonzero(last < len(first))
    to = last[inside]
    near = (here[to] == here[inside]) & (where[to] - where[inside] <= (items.lengths + items.loss)[kind[inside]])
    marks = np.zeros(len(first) + 1, dtype=np.int64)
    np.add.at(marks, inside[near], 1)
    np.add.at(marks, to[near] + 1, -1)
    live = (np.cumsum(marks) > 0)[spot]
    return text[live], item[live], place[live], at[live]


def _windows(items: Items, size: int, hashes: np.ndarray, firsts: np.ndarray, pairs: np.ndarray):
    """(text, item, low, high) of the words to align, for some texts at a time; ``pairs``: sorted text * items + item."""
    gram, of_item, at_item = items.seeds[size]
    if not len(gram):
        return
    grams, at = run_hashes(hashes, firsts, size)
    left = np.searchsorted(gram, grams, side="left")
    many = np.searchsorted(gram, grams, side="right") - left
    before = np.concatenate(([0], np.cumsum(many)))[at]
    start, rows = 0, len(at) - 1
    while start < rows:
        stop = max(int(np.searchsorted(before, before[start] + HITS, side="right")) - 1, start + 1)
        some, start_at, start = many[at[start] : at[stop]], at[start], stop
        hit = np.repeat(np.arange(len(some)), some)
        if not len(hit):
            continue
        seed = np.arange(len(hit)) - np.repeat(np.cumsum(some) - some, some) + left[start_at + hit]
        text = np.searchsorted(at, start_at + hit, side="right") - 1
        code = text * len(items.words) + of_item[seed]
        asked = pairs[np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)] == code
        hit, seed, text = hit[asked], seed[asked], text[asked]
        if not len(hit):
            continue
        text, item, place, begin = _dense(items, text, of_item[seed], start_at + hit - at[text], at_item[seed])
        if not len(text):
            continue
        # Where the item would begin, and half its length to either side for words put in or left out.
        begin = place - begin
        length = items.lengths[item]
        slack = length // 2 + 1
        n = np.diff(firsts)[text]
        low, high = np.maximum(begin - slack, 0), np.minimum(begin + length + slack, n)
        order = np.lexsort((low, item, text))
        text, item, low, high = spans(text[order], item[order], low[order], high[order])
        # All words put in may lie on one side.
        more = np.maximum(items.loss[item] - items.lengths[item] // 2 - 1, 0)
        yield text, item, np.maximum(low - more, 0), np.minimum(high + more, np.diff(firsts)[text])


def _item_grams(least_percent: int):
    """Of texts of items (key, text): key, size and hash of each seed, its place, how many an item needs, how many a text must hold."""

    def grams(batches):
        for batch in batches:
            items = Items(batch.column(1).to_pylist(), least_percent)
            for size, (gram, item, at) in items.seeds.items():
                if len(gram):
                    least = np.minimum(SEEDS, items.need[item])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(item)), pa.array(np.full(len(gram), size, np.int32)), pa.array(gram.view(np.int64)),
                         pa.array(at), pa.array(items.wanted(size, item)), pa.array(least)],
                        names=["u", "size", "gram", "at", "wanted", "least"],
                    )

    return grams


def _text_grams(shared):
    """Of texts (seen, check, text): each distinct pair (or word) of a text that some item may have."""

    def grams(batches):
        bitmaps = shared.value
        for batch in batches:
            keys = batch.column(0), batch.column(1)
            for first, _, data, offsets in text_chunks(batch.column(2)):
                words = Words(data, offsets)
                hashes = words.hashes()
                for size, packed in bitmaps.items():
                    found, at = run_hashes(hashes, words.first, size)
                    hit = np.flatnonzero(is_present(packed, place(found)))
                    if not len(hit):
                        continue
                    text, found = np.searchsorted(at, hit, side="right") - 1, found[hit]
                    order = np.lexsort((found, text))
                    text, found = text[order], found[order]
                    new = np.concatenate(([True], (np.diff(text) != 0) | (found[1:] != found[:-1])))
                    row = pa.array(text[new] + first)
                    yield pa.RecordBatch.from_arrays(
                        [*(k.take(row) for k in keys), pa.array(np.full(len(row), size, np.int32)), pa.array(found[new].view(np.int64))],
                        names=["seen", "check", "size", "gram"],
                    )

    return grams


def _matching(least_percent: int):
    """Alignments of texts (seen, check, text, items) with the items (key, text) named beside each."""

    def matching(batches):
        for batch in batches:
            keys, lists = (batch.column(0), batch.column(1)), batch.column(3)
            flat = lists.flatten()
            us, texts = flat.field(0).to_numpy(), flat.field(1)
            codes, at, of_code = np.unique(us, return_index=True, return_inverse=True)
            items = Items(texts.take(pa.array(at)).to_pylist(), least_percent)
            row_of = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            for first, rows, data, offsets in text_chunks(batch.column(2)):
                words = Words(data, offsets)
                hashes = words.hashes()
                mine = (row_of >= first) & (row_of < first + rows)
                pairs = np.unique((row_of[mine] - first) * len(codes) + of_code[mine])
                for size in items.seeds:
                    for found in _windows(items, size, hashes, words.first, pairs):
                        yield from _aligned(keys, codes, first, words, hashes, items, *found, least_percent)

    return matching


def _aligned(keys, codes, first, words, hashes, items, text, item, low, high, least_percent):
    out = []
    for one in np.unique(item):
        mine = np.flatnonzero(item == one)
        own, full = items.words[one], MATCH * len(items.words[one])
        # Windows of like width together; a merged window may be long, and is then aligned with fewer others.
        mine = mine[np.argsort((high - low)[mine], kind="stable")]
        start, seen = 0, set()
        while start < len(mine):
            stop = min(start + AT_ONCE, len(mine))
            while stop > start + 1 and (
                (high - low)[mine[stop - 1]] > 2 * (high - low)[mine[start]] or (stop - start) * (high - low)[mine[stop - 1]] > CELLS
            ):
                stop = start + max(1, (stop - start) // 2)
            part, start = mine[start:stop], stop
            width = int((high - low)[part].max())
            columns = low[part, None] + np.arange(width)
            inside = columns < high[part, None]
            grid = np.where(inside, hashes[np.minimum(words.first[text[part], None] + columns, len(hashes) - 1)], np.uint64(0))
            best, end = align(own, grid)
            good = np.flatnonzero(100 * best.astype(np.int64) >= least_percent * full)
            for g in good:
                at = int(text[part[g]]), int(low[part[g]] + end[g] + 1)
                if at not in seen:  # windows beside each other may reach the same alignment
                    seen.add(at)
                    out.append((first + at[0], codes[one], int(best[g]), full, at[1]))
    if out:
        row, one, best, full, end = zip(*out)
        yield pa.RecordBatch.from_arrays(
            [*(k.take(pa.array(row)) for k in keys), *(pa.array(c, pa.int64()) for c in (one, best, full, end))],
            names=["seen", "check", "u", "score", "full_score", "end_word"],
        )


def candidates(texts: DataFrame, units: DataFrame, run: Run, least_percent: int, pack: int) -> DataFrame:
    """Texts (seen, check) and items (u) of whose rarest pairs the text holds as many as a copy does; ``pack`` numbers a text's portions of items."""
    spark = texts.sparkSession
    grams = run.stored(units.mapInArrow(_item_grams(least_percent), "u bigint, size int, gram bigint, at bigint, wanted bigint, least bigint"), "item-grams")
    sizes = sorted(r[0] for r in grams.select("size").distinct().collect())
    bitmaps = spark.sparkContext.broadcast({n: presence(grams.where(F.col("size") == n), "gram") for n in sizes})
    hits = run.stored(texts.mapInArrow(_text_grams(bitmaps), "seen bigint, check bigint, size int, gram bigint"), "text-grams")
    often = hits.groupBy("size", "gram").agg(F.count("*").alias("texts"))
    rarest = W.partitionBy("u").orderBy(F.coalesce("texts", F.lit(0)), "gram", "at")
    seeds = grams.join(often, ["size", "gram"], "left").withColumn("turn", F.row_number().over(rarest)).where("turn <= wanted")
    seeds = run.stored(seeds.select("u", "size", "gram", "least"), "seeds")
    found = hits.join(seeds, ["size", "gram"]).groupBy("seen", "check", "u").agg(F.count("*").alias("n"), F.first("least").alias("least"))
    many = F.count("*").over(W.partitionBy("seen", "check"))
    found = found.where("n >= least").withColumn("pack", F.pmod(F.xxhash64("u"), F.ceil(many / pack)))
    return run.stored(found.select("seen", "check", "u", "pack"), "candidates")


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least_percent: int = LEAST_PERCENT,
    pack: int = PACK,
) -> DataFrame:
    """Places where a text of ``docs`` holds a test item: id, ``item_id``, ``score``, ``full_score``, ``end_word``, ``text_hash``.

    A row for each (row of ``docs``, item, place) whose alignment score is at
    least ``least_percent`` of that of an exact copy of the item; ``end_word``
    counts the text's words up to the end of the alignment.  Clean documents
    have no row.  Null and word-less texts and items match nothing, items with a
    null id match as ``item_id`` null, ids may repeat.  Other columns are ignored.
    Equal texts are aligned once.  What is broadcast are two bitmaps of fixed size.
    """
    run = Run(docs.sparkSession, "decontaminate")
    text = F.col(text_col)
    # Two hashes: 64 bits alone meet by chance among some 10**9 texts.
    source = docs.select(F.col(id_col).alias("doc"), text.alias("text"), F.xxhash64(text).alias("seen"), F.xxhash64(F.lit(1), text).alias("check"))
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item"), F.xxhash64(item_text_col).alias("u"), F.col(item_text_col).alias("text"))
    items = items.where("text IS NOT NULL")
    units = run.stored(items.select("u", "text").dropDuplicates(["u"]), "items")
    texts = source.select("seen", "check", "text")
    found = candidates(texts, units, run, least_percent, pack)
    # Only texts that hold seeds are shuffled, but for a few that the bitmap cannot tell from them.
    packed = docs.sparkSession.sparkContext.broadcast(presence(found, "seen"))
    texts = texts.mapInArrow(_marked(packed), texts.schema).groupBy("seen", "check").agg(F.any_value("text").alias("text"))
    asked = found.join(units, "u").groupBy("seen", "check", "pack").agg(F.collect_list(F.struct("u", "text")).alias("items"))
    rows = texts.join(asked, ["seen", "check"]).select("seen", "check", "text", "items")
    out = rows.mapInArrow(_matching(least_percent), "seen bigint, check bigint, u bigint, score bigint, full_score bigint, end_word bigint")
    out = stored(out, "alignments")
    run.discard("items", "item-grams", "text-grams", "seeds", "candidates")
    out = out.join(items.select("u", "item"), "u").join(source.select("doc", "seen", "check"), ["seen", "check"])
    return out.select(F.col("doc").alias(id_col), F.col("item").alias("item_id"), "score", "full_score", "end_word", F.col("seen").alias("text_hash"))


def _marked(shared):
    def marked(batches):
        for batch in batches:
            yield batch.filter(pa.array(is_present(shared.value, place(batch.column(0).to_numpy().view(np.uint64)))))

    return marked


def drop_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs``, with all their columns, that hold no passage of ``benchmark``.

    A row goes if its id and text were found, ids missing or shared or not.
    Columns may have any names.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = matches(docs, benchmark, **options).select(F.col(id_col).alias("id"), F.col("text_hash").alias("text")).distinct()
    rows = docs.select(row.alias("row"))
    same = F.col("row").getField(id_col).eqNullSafe(F.col("id")) & F.xxhash64(F.col("row").getField(text_col)).eqNullSafe(F.col("text"))
    return rows.join(stored(found, "leaks"), same, "left_anti").select("row.*")
