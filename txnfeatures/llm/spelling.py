"""Spelling variants of words, found over a reduced alphabet.

Every letter is hashed to one of ``SYMBOLS`` symbols.  Two words that differ by
one inserted, deleted or replaced letter have reduced words that are equal or
differ by one such edit too, so the full one-edit neighbourhood of each reduced
word, over so small an alphabet, meets the reduced vocabulary in a join.  Words
of reduced words that meet are compared letter by letter.

A reduced word travels as a 64-bit hash that an edit changes in one step (a sum
of symbols times powers), so neighbourhoods are made of whole arrays; two
reduced words with one hash would only add a comparison.  Only the half of each
neighbourhood with larger hashes is kept, as the other word makes the rest, and
of it only what a bitmap of the vocabulary's hashes (2 MB) does not rule out.

Many words may share a reduced word.  One edit leaves the first or the last half
of the shorter word as it is, so words meet on the reduced word and such a half:
groups of any size are joined without comparing all their pairs.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnfeatures.llm import bitmap
from txnfeatures.llm.store import stored
from txnfeatures.llm.words import BASE, INVERSE, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = 8
#: Distinct words that a task counts before it hands its counts on, hashes that it makes at once.
HELD, AT_ONCE = 1 << 19, 1 << 21
#: One run in ``TYPO`` loses a letter (a fixed value of the definition, as the two limits below).
TYPO, MIN_LETTERS, MIN_COUNT = 97, 5, 3
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _counted(min_letters: int, typo: int):
    run = re.compile(f"[a-zÀ-ÿ]{{{min_letters},}}")

    def sent(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    def counted(batches):
        counts: Counter = Counter()
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text")).cast(pa.large_binary())
            for doc, text in zip(batch.column(batch.schema.names.index("doc")).to_pylist(), texts):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, times in Counter(run.findall(text.as_py().translate(LOWER).decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if typo and h % typo == 0:
                        cut = h % len(word)
                        word = word[:cut] + word[cut + 1 :]
                        if len(word) < min_letters:
                            continue
                    counts[word] += times
                if len(counts) >= HELD:
                    yield sent(counts)
                    counts.clear()
        yield sent(counts)

    return counted


def symbols(words: list[str]) -> np.ndarray:
    """(words, letters): 1 to ``SYMBOLS`` for each letter of words of one length."""
    letters = np.array(words).view(np.uint32).reshape(len(words), -1)
    with np.errstate(over="ignore"):
        return (mix(letters.astype(np.uint64) * np.uint64(BASE)) % np.uint64(SYMBOLS)) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _sealed(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + np.uint64(length) * np.uint64(0xD6E8FEB86659FD93))


def reduced_keys(words: list[str]) -> np.ndarray:
    """Hash of each reduced word; the words have one length."""
    found = symbols(words)
    with np.errstate(over="ignore"):
        return _sealed((found * _powers(found.shape[1])).sum(1, dtype=np.uint64), found.shape[1])


def neighbourhood(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all reduced words one edit away from those of words of one length, repeats included.

    Two arrays (words, neighbours): the shorter ones, and those of the same length or longer.
    """
    found = symbols(words)
    n, length = found.shape
    power = _powers(length + 1)
    every = np.arange(1, SYMBOLS + 1, dtype=np.uint64)
    before = np.zeros((n, length + 1), dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(found * power[:length], axis=1, out=before[:, 1:])
        whole = before[:, -1:]
        dropped = before[:, :-1] + (whole - before[:, 1:]) * np.uint64(INVERSE)
        swapped = (whole - found * power[:length])[:, :, None] + every * power[:length, None]
        grown = (before + (whole - before) * np.uint64(BASE))[:, :, None] + every * power[:, None]
        longer = [_sealed(swapped.reshape(n, -1), length), _sealed(grown.reshape(n, -1), length + 1)]
        return _sealed(dropped, length - 1), np.concatenate(longer, axis=1)


def _by_length(words: list[str]):
    """(places, words) of words of one length, few enough for one array of neighbours."""
    places: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        places.setdefault(len(word), []).append(i)
    for length, at in places.items():
        step = max(1, AT_ONCE // (2 * (length + 1) * SYMBOLS))
        for first in range(0, len(at), step):
            some = at[first : first + step]
            yield some, [words[i] for i in some]


def _keyed(batches):
    for batch in batches:
        words = batch.column(0).to_pylist()
        keys = np.zeros(len(words), dtype=np.uint64)
        for at, some in _by_length(words):
            keys[at] = reduced_keys(some)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys.view(np.int64))], names=["word", "n", "key"])


def _met(packed):
    def met(batches):
        seen = packed.value
        for batch in batches:
            for _, some in _by_length(batch.column(batch.schema.names.index("word")).to_pylist()):
                own, half = reduced_keys(some), len(some[0]) // 2
                left, right, halves = [own], [own], [np.full(len(own), half)]
                for near, at in zip(neighbourhood(some), ((len(some[0]) - 1) // 2, half)):
                    near = np.sort(near, axis=1)
                    keep = near > own[:, None]
                    keep[:, 1:] &= near[:, 1:] != near[:, :-1]
                    keep &= bitmap.is_present(seen, bitmap.place(near))
                    row, _ = np.nonzero(keep)
                    left.append(own[row])
                    right.append(near[keep])
                    halves.append(np.full(len(row), at))
                arrays = [np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64), np.concatenate(halves).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["key", "other", "half"])

    return met


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, typo: int = TYPO,
) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of at least ``min_letters`` letters and ``min_count`` occurrences.

    Where ``typo`` divides the crc32 of ``id:run`` the run loses a letter first; 0 leaves all runs as they are.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    counts = rows.mapInArrow(_counted(min_letters, typo), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every word of ``words`` (word, n, one row each) with each word exactly one edit away."""
    spark = words.sparkSession
    known = stored(words.select("word", "n").mapInArrow(_keyed, "word string, n bigint, key bigint"), "vocabulary")
    reduced = known.groupBy("key").agg(F.min("word").alias("word"))
    packed = spark.sparkContext.broadcast(bitmap.presence(reduced, "key"))
    met = reduced.mapInArrow(_met(packed), "key bigint, other bigint, half int")
    met = met.join(reduced.select(F.col("key").alias("other")), "other", "left_semi")
    sides = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.expr("left(word, half)").alias("part")),
        F.struct(F.lit(1).alias("side"), F.expr("right(word, half)").alias("part")),
    ))
    a = met.join(known, "key").select("key", "other", "half", sides.alias("of"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    halves = F.explode(F.expr("array_distinct(array(CAST(length(word) DIV 2 AS INT), CAST((length(word) - 1) DIV 2 AS INT)))"))
    b = known.withColumn("half", halves).select(
        F.col("key").alias("other"), "half", sides.alias("of"), F.col("word").alias("b"), F.col("n").alias("b_n")
    )
    # Where both halves agree, the first one counts.
    once = "(of.side = 0 OR left(a, half) <> left(b, half)) AND (key <> other OR a < b)"
    pairs = a.join(b, ["other", "half", "of"]).where(f"{once} AND levenshtein(a, b, 1) = 1")
    both = F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    ))
    return pairs.select(both.alias("pair")).select("pair.*")


def group_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, typo: int = TYPO, factor: int = 2,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the most frequent word one edit away (ties: the smallest) if it
    occurs at least ``factor`` times as often as the word, ``root`` the end of
    the chain of forms.  Each step of a chain multiplies the count by ``factor``
    at least, so there are no circles and chains stay short.

    Null texts have no words; a null id counts as empty text in ``id:run``.
    Rows that repeat count again.  Other columns of ``docs`` are ignored.  No
    words, or an empty table, give an empty result.
    """
    if factor < 2:
        raise ValueError("factor below 2: chains of forms may not end")
    words = stored(vocabulary(docs, id_col, text_col, min_letters, min_count, typo), "words")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    )
    is_form = -F.col("best.n") >= factor * F.col("n")
    found = stored(
        words.join(best, "word", "left").select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, -F.col("best.n")).alias("form_n"),
        ),
        "forms",
    )
    chains = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = words.agg(F.max("n")).first()[0] or 1
    hops, reach = max(1, int(most // min_count).bit_length()), 1
    while reach < hops:  # each round doubles how far a chain has been followed
        chains = stored(chains, "chains")
        ahead = chains.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        chains = chains.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"))
        reach *= 2
    return found.join(chains, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
