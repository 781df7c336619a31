"""Quality rules on repetition: how many characters of a text lie inside n-grams and lines it repeats.

Everything is measured on whole texts, many at once, with rolling 64-bit hashes
of lines and of windows of several lengths.  A text goes when it is short, when
8-word windows repeat too much, or when characters covered by repeated windows
or repeated lines exceed the share allowed for their length.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnfeatures.llm.words import PLAIN, Words, mix, run_hashes, runs, span_hashes, text_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of a window, and the per cent of a text's word characters that repeated windows of this length may cover.
COVERAGE = {5: 50, 8: 40, 13: 40}
#: Per cent of a text's characters that may lie in lines equal to an earlier one.
LINE_COVERAGE = 30
MIN_WORDS = 20
REPEAT_WINDOW, REPEAT_PERCENT = 8, 30
SYMBOLS = b"#*$%&|<>"

MEASURES = (
    ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    + [f"repeat_chars_{n}" for n in COVERAGE]
    + ["chars", "dup_line_chars"]
)


def repeated(hashes: np.ndarray, at: np.ndarray, later_only: bool = False) -> np.ndarray:
    """Which items equal another one of the same text; ``later_only``: an earlier one."""
    texts = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at))
    keyed = hashes ^ mix(texts + np.uint64(0x51ED27))
    order = np.argsort(keyed, kind="stable")
    same = keyed[order][1:] == keyed[order][:-1]
    out = np.zeros(len(hashes), dtype=bool)
    out[order[1:]] = same
    if not later_only:
        out[order[:-1]] |= same
    return out


def covered(words: Words, hashes: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in a window of ``n`` words that the text has twice or more."""
    windows, at = run_hashes(hashes, words.first, n)
    starts, _ = runs(words.first, n)
    starts = starts[repeated(windows, at)]
    edge = np.zeros(len(words.starts) + 1, dtype=np.int32)
    edge[starts] += 1
    edge[starts + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def measures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of some texts, see ``MEASURES``."""
    words = Words(data, offsets, lower=False)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    lengths = points[words.ends] - points[words.starts]
    hashes = words.hashes()

    def by_text(values, at):
        sums = np.concatenate(([0], np.cumsum(values)))
        return sums[at[1:]] - sums[at[:-1]]

    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    # Lines: a text starts one, and so does each line feed.
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], feeds + 1)), kind="stable")
    ends = np.sort(np.concatenate((offsets[1:], feeds)), kind="stable")
    lines_at = np.concatenate(([0], np.cumsum(by_text(data == 10, offsets) + 1)))
    spoken = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    line_again = repeated(span_hashes(data, starts, ends, PLAIN), lines_at, later_only=True) & spoken
    line_chars = points[ends] - points[starts]
    out = {
        "n_words": words.counts,
        "word_chars": by_text(lengths, words.first),
        "n_symbols": by_text(symbol[data], offsets),
        "n_dup_lines": by_text(line_again, lines_at),
        "n_repeat_words": by_text(covered(words, hashes, REPEAT_WINDOW), words.first),
        "chars": points[offsets[1:]] - points[offsets[:-1]],
        "dup_line_chars": by_text(np.where(line_again, line_chars, 0), lines_at),
    }
    for n in COVERAGE:
        out[f"repeat_chars_{n}"] = by_text(np.where(covered(words, hashes, n), lengths, 0), words.first)
    return {k: out[k].astype(np.int64) for k in MEASURES}


def verdict(m) -> tuple:
    """(base_failed, kept) of measures, given as columns of Spark or numpy."""
    failed = (m("n_words") < MIN_WORDS) | (100 * m("n_repeat_words") > REPEAT_PERCENT * m("n_words"))
    bad = failed | (100 * m("dup_line_chars") > LINE_COVERAGE * m("chars"))
    for n, percent in COVERAGE.items():
        bad = bad | (100 * m(f"repeat_chars_{n}") > percent * m("word_chars"))
    return failed, ~bad


def _measured(texts: pa.Array) -> dict[str, np.ndarray]:
    parts = [measures(data, offsets) for _, _, data, offsets in text_chunks(texts)]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in MEASURES}


def _measuring(batches):
    for batch in batches:
        found = _measured(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(found[k]) for k in MEASURES], names=["doc", *MEASURES]
        )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``MEASURES``, ``base_failed`` and ``kept``.

    A null text counts as empty and has no words, so it fails.  Ids may be null
    or repeated: every row is measured by itself.  Other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    kind = source.schema["doc"].dataType.simpleString()
    found = source.mapInArrow(_measuring, f"doc {kind}, " + ", ".join(f"{c} bigint" for c in MEASURES))
    failed, kept = verdict(F.col)
    return found.select(F.col("doc").alias(id_col), *MEASURES, failed.alias("base_failed"), kept.alias("kept"))


def _filtering(text_col: str):
    def filtering(batches):
        for batch in batches:
            found = _measured(batch.column(batch.schema.names.index(text_col)))
            yield batch.filter(pa.array(verdict(found.__getitem__)[1], pa.bool_()))

    return filtering


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""
    return docs.mapInArrow(_filtering(text_col), docs.schema)


