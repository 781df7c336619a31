"""Words of whole texts as numpy arrays: what several operators share.

A word is ``[^\\x20\\x09-\\x0D]+``.  These separators are single bytes in UTF-8,
so words are found on the bytes of many texts at once.  Words and runs of words
become 64-bit hashes that depend on content alone, equal on every machine.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text handled at once; one longer text is handled by itself.
CHUNK = 1 << 20

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit values of ``seed``."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed * 0x1234567 + 1))


def byte_values(lower: bool) -> np.ndarray:
    values = stream(256, 1)
    if lower:
        values[65:91] = values[97:123]
    return values


def separators() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


SEPARATOR = separators()
FOLDED, PLAIN = byte_values(True), byte_values(False)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to at least ``n``, mod 2**64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, CHUNK + 1), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 4 * CHUNK:
            _powers[base] = have
    return have


def text_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) for runs of rows of about ``limit`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last - first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Words:
    """The words of some texts.

    ``starts``, ``ends``: bytes of each word; ``first``: for each text the
    index of its first word, and the number of words at the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        self.data, self.offsets = data, offsets
        inside = ~SEPARATOR[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.values = FOLDED if lower else PLAIN

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A hash of each word."""
        return span_hashes(self.data, self.starts, self.ends, self.values)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span, from one running sum over all of them."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers(BASE, n)[:n], out=sums[1:])
    found = (sums[ends] - sums[starts]) * powers(INVERSE, n)[starts]
    return mix(found + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def runs(first: np.ndarray, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``n`` items inside each text: index of the first item of each window, offsets by text.

    ``short``: a text with 1 to n-1 items has one window, at its first item.
    """
    counts = np.diff(first)
    windows = np.maximum(counts - n + 1, 0)
    if short:
        windows = np.maximum(windows, counts > 0)
    offsets = np.zeros(len(windows) + 1, dtype=np.int64)
    np.cumsum(windows, out=offsets[1:])
    return np.arange(offsets[-1]) + np.repeat(first[:-1] - offsets[:-1], windows), offsets


def run_hashes(hashes: np.ndarray, first: np.ndarray, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``n`` words and the windows' offsets by text; ``short`` as in :func:`runs`."""
    at, offsets = runs(first, n, short)
    out = np.zeros(len(at), dtype=np.uint64)
    if not len(at):
        return out, offsets
    factors = powers(BASE, n)
    if not short:
        for j in range(n):
            out += hashes[at + j] * factors[j + 1]
        return mix(out), offsets
    ends = np.repeat(first[1:], np.diff(offsets))
    for j in range(n):
        inside = at + j < ends
        out += np.where(inside, hashes[np.minimum(at + j, len(hashes) - 1)] * factors[j + 1], np.uint64(0))
    return mix(out + np.minimum(ends - at, n).astype(np.uint64)), offsets
