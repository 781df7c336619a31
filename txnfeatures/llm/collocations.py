"""Collocations: frequent phrases that score far above what their parts make likely.

Phrases are counted level by level (Apriori).  Texts become one array of word
ids, 0 for words that are not frequent and for the ends of pieces, and one array
of states: the frequent phrase of the last level that starts at each position.
For the next level

1. *Candidates.*  A longer phrase can only be frequent where a frequent phrase
   starts at its first and at its second word.  Tasks hand on such pairs of
   states, each once in about ``AT_ONCE``, and Spark deals them to about one
   bucket for every ``LOAD`` positions, where equal pairs become one row; a pair
   is a candidate only if its bucket reaches the floor (a bucket's count is
   never below that of a member).
2. *Counting.*  A double-array trie of the candidates is broadcast: from the
   state of a position, by the digits of the word that follows, to the
   candidate.  Tasks advance all positions at once, count accepting states with
   ``bincount``, and Spark sums the counts of all shards.
3. *States.*  The states of frequent candidates are written as the next level.

Candidates go by blocks of at most ``BLOCK``, one trie each, run over all
positions, so what is broadcast has a fixed bound at any size of the corpus; the
words of the first level go by blocks of the same size.
"""

from __future__ import annotations

import sys
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txnfeatures.llm.doublearray import advance, digits_of, step_trie
from txnfeatures.llm.first import first_rows
from txnfeatures.llm.store import Run, stored, text_batches, wide_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words or candidates in one broadcast.
BLOCK = 1 << 19
#: Positions for each bucket of pairs.
LOAD = 1
#: Candidates whose counts travel in one row; parts in which the shards' rows are added before they meet.
WIDTH, PARTS = 4096, 256
#: Distinct words that a task counts before it hands its counts on; pairs that it counts at once; positions in one stored row, about.
HELD, AT_ONCE, ROW = 1 << 18, 1 << 18, 1 << 16
UNNAMED = "und"

#: Ends of pieces become a byte that UTF-8 never has; A-Z are lower-cased, tabs are spaces.
EDGE = 0xFF
FOLD = bytes(
    EDGE if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def tokens(text: bytes) -> list[bytes]:
    """Words of a text in order, and ``b"\\xff"`` at the ends of pieces."""
    return [w for w in text.translate(FOLD).replace(b"\xff", b" \xff ").split(b" ") if w]


def _texts(batch: pa.RecordBatch):
    langs = batch.column(batch.schema.names.index("lang")).to_pylist()
    for lang, text in zip(langs, batch.column(batch.schema.names.index("text")).cast(pa.large_binary())):
        if text.is_valid:
            yield lang, text.as_py()


def _counted(batches):
    """(lang, word, n): counts of each task's words, handed on when there are many."""
    counts: dict[str, Counter] = {}

    def sent():
        for lang, own in counts.items():
            own.pop(b"\xff", None)
            words = pa.array(list(own.keys()), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), words, pa.array(list(own.values()), pa.int64())], names=["lang", "word", "n"])
        counts.clear()

    for batch in batches:
        for lang, text in _texts(batch):
            own = counts.setdefault(lang, Counter())
            own.update(tokens(text))
            if len(own) >= HELD:
                yield from sent()
        if sum(map(len, counts.values())) >= HELD:
            yield from sent()
    yield from sent()


class Ids(dict):
    def __missing__(self, word):
        return 0


def _packed(names: list[str], *arrays: np.ndarray) -> pa.RecordBatch:
    """One row of whole arrays."""
    return pa.RecordBatch.from_arrays([pa.array([x.astype(np.int32).tobytes()], pa.large_binary()) for x in arrays], names=names)


def _numbered(block, first: bool, last: bool):
    """Word ids of the texts, for the words of a block; ids of earlier blocks stay.

    The last block packs texts together, a 0 after each; before, rows stay (lang, text, words).
    """

    def numbered(batches):
        ids: dict[str, Ids] = {}
        for lang, word, number in zip(*block.value):
            ids.setdefault(lang, Ids())[word] = number
        held, n = [], 0
        for batch in batches:
            before = None if first else batch.column(batch.schema.names.index("words"))
            langs, texts, kept = [], [], []
            for i, (lang, text) in enumerate(_texts(batch)):
                found = tokens(text)
                own = np.zeros(len(found) + 1, dtype=np.int32)
                if lang in ids:
                    own[:-1] = np.fromiter(map(ids[lang].__getitem__, found), np.int32, len(found))
                if not first:
                    own = np.maximum(own, np.frombuffer(before[i].as_py(), np.int32))
                if not last:
                    langs.append(lang), texts.append(text), kept.append(own.tobytes())
                    continue
                held.append(own)
                n += len(own)
                if n >= ROW:
                    yield _packed(["words"], np.concatenate(held))
                    held, n = [], 0
            if not last:
                columns = [pa.array(langs, pa.string()), pa.array(texts, pa.large_binary()).cast(pa.large_string()), pa.array(kept, pa.large_binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "text", "words"])
        if held:
            yield _packed(["words"], np.concatenate(held))

    return numbered


def _rows(batches):
    for batch in batches:
        columns = [batch.column(batch.schema.names.index(c)) for c in ("words", "states")]
        for words, states in zip(*columns):
            yield np.frombuffer(words.as_py(), np.int32), np.frombuffer(states.as_py(), np.int32)


def _pairs(states: np.ndarray) -> np.ndarray:
    """(state, next state) as one number wherever both are frequent phrases."""
    both = np.flatnonzero((states[:-1] > 0) & (states[1:] > 0))
    return (states[both].astype(np.uint64) << np.uint64(32)) | states[both + 1].astype(np.uint64)


def _pair_sets(batches):
    """Pairs of frequent phrases, about ``AT_ONCE`` at a time: sorted, each once, and how often."""
    held, n = [], 0
    for batch in batches:
        for states in batch.column(batch.schema.names.index("states")):
            held.append(_pairs(np.frombuffer(states.as_py(), np.int32)))
            n += len(held[-1])
            if n >= AT_ONCE:
                yield np.unique(np.concatenate(held), return_counts=True)
                held, n = [], 0
    if held:
        yield np.unique(np.concatenate(held), return_counts=True)


def _pair_counts(batches):
    for pairs, n in _pair_sets(batches):
        yield pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(n, pa.int64())], names=["pair", "n"])


def _arrived(words: np.ndarray, states: np.ndarray, length: int, trie) -> np.ndarray:
    """The trie's state of each position after the word that follows its phrase of ``length`` words; 0 for none."""
    base, check, lefts, digits = trie
    out = np.zeros(len(states), dtype=np.int64)
    at = np.flatnonzero(states[: max(0, len(states) - length)] > 0)
    at = at[words[at + length] > 0]
    mine = np.minimum(np.searchsorted(lefts, states[at]), len(lefts) - 1)
    here = lefts[mine] == states[at]
    at, now = at[here], mine[here] + 1
    for symbol in digits_of(words[at + length], digits).T:
        now = advance(base, check, now, symbol)
    out[at] = now
    return out


def _trie_counts(trie, last, length: int):
    """(block, counts): this shard's counts of ``WIDTH`` candidates a row."""

    def counted(batches):
        total = np.zeros(len(trie.value[0]), dtype=np.int64)
        for words, states in _rows(batches):
            total += np.bincount(_arrived(words, states, length, trie.value), minlength=len(total))
        counts = total[last.value]
        for block in range(-(-len(counts) // WIDTH)):
            some = counts[block * WIDTH : (block + 1) * WIDTH]
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([some.tobytes()], pa.binary())], names=["block", "counts"])

    return counted


def _added(group: pd.DataFrame) -> pd.DataFrame:
    counts = np.sum([np.frombuffer(c, np.int64) for c in group["counts"]], axis=0)
    return pd.DataFrame({"block": group["block"].iloc[:1], "counts": [counts.tobytes()]})


def _shards_sum(shards: DataFrame, n: int) -> np.ndarray:
    """Counts of ``n`` candidates over all shards: rows are added in parts, then the parts."""
    schema = "block int, counts binary"
    parts = shards.withColumn("part", F.spark_partition_id() % PARTS).groupBy("block", "part").applyInPandas(_added, schema)
    found = parts.groupBy("block").applyInPandas(_added, schema).toArrow()
    out = np.zeros(n, dtype=np.int64)
    for block, counts in zip(*(column.to_pylist() for column in found.columns)):
        out[block * WIDTH : (block + 1) * WIDTH] = np.frombuffer(counts, np.int64)
    return out


def _moved(trie, length: int, numbers, first: bool, last: bool):
    """``next``: the number of the frequent phrase of one more word that starts at each position."""

    def moved(batches):
        for batch in batches:
            for i, (words, states) in enumerate(_rows([batch])):
                after = numbers.value[_arrived(words, states, length, trie.value)]
                if not first:
                    after = np.maximum(after, np.frombuffer(batch.column(batch.schema.names.index("next"))[i].as_py(), np.int32))
                yield _packed(["words", "next"], words, after) if last else _packed(["words", "states", "next"], words, states, after)

    return moved


def _with_numbers(table: DataFrame, order: list[str], name: str) -> DataFrame:
    """Stored, with ``id``: 1, 2, ... along ``order``, without a sort of all rows in one task."""
    placed = stored(table.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    parts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    ahead = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row for each task that wrote
    parts = parts.select("_part", (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    out = placed.withColumn("_part", part).join(parts, "_part")
    return stored(out.withColumn("id", (F.col("_at") + F.col("_shift")).cast("int")).drop("_part", "_at", "_shift"), name)


def _positions(rows: DataFrame, words: DataFrame, run: Run) -> DataFrame:
    """(words, states): the texts as ids of frequent words, one block of words after the other."""
    blocks = max(1, -(-words.count() // BLOCK))
    for block in range(blocks):
        low, last = block * BLOCK, block == blocks - 1
        some = words.where(F.col("id").between(low + 1, low + BLOCK)).select("lang", F.col("phrase").cast("binary"), "id").toArrow()
        names = rows.sparkSession.sparkContext.broadcast(tuple(column.to_pylist() for column in some.columns))
        schema = "words binary" if last else "lang string, text string, words binary"
        rows = run.stored(rows.mapInArrow(_numbered(names, block == 0, last), schema), "positions-1")
    return rows.withColumn("states", F.col("words"))


def _candidates(positions: DataFrame, known: DataFrame, n: int, floor: int) -> DataFrame:
    """(left, right, tail, id): pairs of frequent phrases one word apart whose bucket reaches the floor.

    ``tail`` is the id of the last word.
    """
    buckets = 1 << max(10, (n // LOAD).bit_length())
    # One exchange: pairs go to their bucket, equal ones are added up there, and the bucket's sum stands beside each.
    counts = positions.select("states").mapInArrow(_pair_counts, "pair bigint, n bigint")
    # The bucket follows from the pair: it is not written beside it.
    bucket = F.xxhash64("pair").bitwiseAND(buckets - 1)
    dealt = counts.repartition(bucket).withColumn("bucket", bucket)
    pairs = dealt.groupBy("bucket", "pair").agg(F.sum("n").alias("n"))
    reached = pairs.withColumn("n", F.sum("n").over(W.partitionBy("bucket"))).where(F.col("n") >= floor)
    pairs = reached.select(F.shiftright("pair", 32).alias("left"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("right"))
    # Stored, as numbering them samples its input first: the buckets are not gone through twice.
    pairs = stored(pairs, "pairs")
    found = pairs.join(known.select(F.col("id").alias("right"), "tail"), "right").select("left", "right", "tail")
    return _with_numbers(found, ["left", "right"], "candidates")


def _longer(positions: DataFrame, known: DataFrame, length: int, n: int, n_words: int, floor: int, go_on: bool, run: Run):
    """(positions, phrases) one word longer than ``known``, whose phrases have ``length`` words."""
    spark = positions.sparkSession
    candidates = _candidates(positions, known, n, floor)
    digits, frequent, total = max(1, -(-n_words.bit_length() // 8)), [], 0
    source = positions.select("words", "states")
    blocks = -(-candidates.count() // BLOCK)
    for block in range(blocks):
        some = candidates.where(F.col("id").between(block * BLOCK + 1, (block + 1) * BLOCK)).orderBy("id").toArrow()
        left, right, tail = (some.column(c).to_numpy() for c in ("left", "right", "tail"))
        lefts, state = np.unique(left, return_inverse=True)
        base, check, last = step_trie(state + 1, tail, len(lefts), digits)
        trie = spark.sparkContext.broadcast((base, check, lefts, digits))
        ends = spark.sparkContext.broadcast(last)
        shards = source.select("words", "states").mapInArrow(_trie_counts(trie, ends, length), "block int, counts binary")
        a = _shards_sum(shards, len(last))
        good = np.flatnonzero(a >= floor)
        ids = total + 1 + np.arange(len(good))
        total += len(good)
        rows = {"left": left[good], "right": right[good], "a": a[good], "id": ids.astype(np.int32)}
        if len(good):
            frequent.append(stored(spark.createDataFrame(pa.table(rows)), "frequent"))
        if go_on:
            numbers = np.zeros(len(base), dtype=np.int32)
            numbers[last[good]] = ids
            final = block == blocks - 1
            schema = "words binary, next binary" if final else "words binary, states binary, next binary"
            move = _moved(trie, length, spark.sparkContext.broadcast(numbers), block == 0, final)
            source = run.stored(source.mapInArrow(move, schema), f"positions-{length + 1}")
    run.discard(f"positions-{length}")
    if not frequent:
        return None, None
    found = frequent[0]
    for more in frequent[1:]:
        found = found.union(more)
    left = known.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("start"))
    right = known.select(F.col("id").alias("right"), "tail", F.element_at(F.split("phrase", " "), -1).alias("end"))
    found = found.join(left, "left").join(right, "right")
    phrases = stored(found.select("lang", F.concat_ws(" ", "start", "end").alias("phrase"), "a", "id", "tail"), f"frequent-{length + 1}")
    return (source.select("words", F.col("next").alias("states")) if go_on else None), phrases


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5, floor: int = 100):
    """((lang, n) of all words, (lang, phrase, a, length) of all phrases of 1 to ``longest`` words with a >= ``floor``)."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNNAMED)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = rows.mapInArrow(_counted, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "words")
    totals = stored(counts.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    words = counts.where(F.col("n") >= floor).select("lang", F.col("word").alias("phrase"), F.col("n").alias("a"))
    known = _with_numbers(words, ["lang", "phrase"], "frequent-1").withColumn("tail", F.col("id"))
    n, n_words = totals.agg(F.sum("n")).first()[0] or 0, known.count()
    run = Run(docs.sparkSession, "collocations")
    positions = _positions(rows, known, run)
    found = known.select("lang", "phrase", "a", F.lit(1).alias("length"))
    for length in range(1, longest):
        if not n_words:
            break
        with wide_rows(docs.sparkSession):
            positions, known = _longer(positions, known, length, n, n_words, floor, length + 1 < longest, run)
        if known is None:
            break
        found = found.union(known.select("lang", "phrase", "a", F.lit(length + 1).alias("length")))
    return totals, found


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5, floor: int = 100, most: int = 2000
) -> DataFrame:
    """The ``most`` best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a``, ``l``, ``r`` count the phrase and its two parts at its worst cut,
    ``n`` all words; score = floor(1000 * a * n / (l * r)).  Phrases that always
    occur inside one longer frequent phrase are left out.  Ties go by ``a``, then
    by the phrase.

    A null language is ``und``; null and empty texts have no words; repeated
    rows count again; other columns of ``docs`` are ignored; an empty table, or
    one without frequent phrases, gives an empty result.
    """
    totals, found = frequent_phrases(docs, text_col, lang_col, longest, floor)
    phrases = found.where("length > 1")
    split = F.split("phrase", " ")
    part = lambda first, n: F.array_join(F.slice(split, first, n), " ")
    inner = F.explode(F.array(part(F.lit(1), F.col("length") - 1), part(F.lit(2), F.col("length") - 1)))
    inside = phrases.where("length > 2").select("lang", inner.alias("phrase"), F.col("a").alias("in_longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("in_longer").alias("in_longer"))
    free = phrases.join(inside, ["lang", "phrase"], "left").where("in_longer IS NULL OR in_longer < a").drop("in_longer")
    cuts = free.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("length") - 1))).select(
        "lang", "phrase", "a", "cut",
        part(F.lit(1), F.col("cut")).alias("start"), part(F.col("cut") + 1, F.col("length") - F.col("cut")).alias("rest"),
    )
    counts = lambda name, out: found.select("lang", F.col("phrase").alias(name), F.col("a").alias(out))
    cuts = cuts.join(counts("start", "l"), ["lang", "start"]).join(counts("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    wide = lambda c: f"CAST({c} AS DECIMAL(18, 0))"
    score = F.expr(f"(1000BD * ({wide('a')} * {wide('n')})) DIV ({wide('l')} * {wide('r')})")
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
    out = worst.select("lang", "phrase", "a", "worst.l", "worst.r", "n", "worst.score")
    ranked = first_rows(out, "lang", [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()], most)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
