"""Language of documents by a bidirectional gated recurrent network over bytes.

Each byte is labelled from the state of a unit that reads from the left and one
that reads from the right; a document's probabilities are the mean over all its
bytes.  Whole texts are read, in windows of ``WINDOW`` bytes with ``CONTEXT``
bytes on either side in which the states warm up: windows of all texts run as
one array, a long text costs no more per byte than a short one and holds no
more memory, and a text's result does not depend on which others it meets.

The network is trained in numpy by backpropagation through time, in one task, on
a bounded sample: of each language the ``SAMPLE`` pieces of ``PIECE`` bytes with
the smallest hashes, at most ``PER_TEXT`` of them from one text, each piece once.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnfeatures.llm.first import first_rows
from txnfeatures.llm.store import stored, text_batches
from txnfeatures.llm.words import PLAIN, span_hashes, text_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HIDDEN, WINDOW, CONTEXT = 12, 256, 16
SAMPLE, PIECE, PER_TEXT = 2048, 64, 4
STEPS, BATCH, RATE, SEED = 600, 128, 0.01, 5
#: Windows of one array.
AT_ONCE = 1024
#: Stands for bytes outside a text.
NONE = 256
UNKNOWN = "und"


def initial(languages: int, hidden: int = HIDDEN, seed: int = SEED) -> list[np.ndarray]:
    """[inputs (2, 257, 3 hidden), recurrent (2, hidden, 3 hidden), out (2 hidden, languages), bias (languages)].

    The two units read forward and backward; gates are in the order update, reset, new.
    """
    rng = np.random.default_rng(seed)
    shapes = [(2, NONE + 1, 3 * hidden), (2, hidden, 3 * hidden), (2 * hidden, languages), (languages,)]
    scales = [0.5, 1 / np.sqrt(hidden), 1 / np.sqrt(2 * hidden), 0]
    return [(rng.standard_normal(s) * c).astype(np.float32) for s, c in zip(shapes, scales)]


def _squashed(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place: between -1 and 1 like tanh, at a quarter of its time."""
    x /= np.abs(x) + np.float32(1)
    return x


def _slope(y: np.ndarray) -> np.ndarray:
    """Derivative of :func:`_squashed` where it is ``y``."""
    return np.square(1 - np.abs(y))


def states(weights: list[np.ndarray], symbols: np.ndarray, trace: list | None = None) -> np.ndarray:
    """(time, 2 hidden, texts): both units' states at each position of ``symbols`` (time, texts).

    Outside a text the states are 0.  ``trace`` receives what going back needs.
    Texts are the last axis everywhere: every operation runs along them.
    """
    inputs, recurrent = np.ascontiguousarray(weights[0].transpose(0, 2, 1)), np.ascontiguousarray(weights[1].transpose(0, 2, 1))
    hidden = recurrent.shape[2]
    time, n = symbols.shape
    inside = (symbols != NONE).astype(np.float32)
    both = np.empty((time, 2 * hidden, n), dtype=np.float32)
    h = np.zeros((2, hidden, n), dtype=np.float32)
    x = np.empty((2, 3 * hidden, n), dtype=np.float32)
    gates = np.empty_like(x)
    mask = np.empty((2, 1, n), dtype=np.float32)
    for t in range(time):
        back = time - 1 - t
        np.take(inputs[0], symbols[t], axis=1, out=x[0], mode="clip")
        np.take(inputs[1], symbols[back], axis=1, out=x[1], mode="clip")
        mask[0], mask[1] = inside[t], inside[back]
        np.matmul(recurrent, h, out=gates)
        zr = x[:, : 2 * hidden]
        zr += gates[:, : 2 * hidden]
        zr = _squashed(zr) * np.float32(0.5)
        zr += np.float32(0.5)
        z, r = zr[:, :hidden], zr[:, hidden:]
        new = r * gates[:, 2 * hidden :]
        new += x[:, 2 * hidden :]
        new = _squashed(new)
        before = h
        h = before - new
        h *= z
        h += new
        h *= mask
        both[t, :hidden] = h[0]
        both[back, hidden:] = h[1]
        if trace is not None:
            trace.append((before, z, r, new, gates[:, 2 * hidden :].copy(), mask.copy()))
    return both


def label_probabilities(weights: list[np.ndarray], both: np.ndarray) -> np.ndarray:
    """(time, languages, texts) for the states of :func:`states`."""
    out = np.matmul(weights[2].T, both)
    out += weights[3][:, None]
    out -= out.max(1, keepdims=True)
    np.exp(out, out=out)
    out /= out.sum(1, keepdims=True)
    return out


def gradients(weights: list[np.ndarray], symbols: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy of the labels of all positions inside texts, and its gradient by backpropagation through time."""
    inputs, recurrent, out, _ = weights
    hidden = recurrent.shape[1]
    time, n = symbols.shape
    trace: list = []
    both = states(weights, symbols, trace)
    found = label_probabilities(weights, both)
    inside = symbols != NONE
    count = max(1, int(inside.sum()))
    own = found[:, labels, np.arange(n)]
    loss = float(-np.log(np.maximum(own, 1e-30))[inside].sum() / count)
    d_out = found
    d_out[:, labels, np.arange(n)] -= 1
    d_out *= inside[:, None] / np.float32(count)
    grad_out, grad_bias = np.matmul(both, d_out.transpose(0, 2, 1)).sum(0), d_out.sum((0, 2))
    d_both = np.matmul(out, d_out)
    grad_recurrent = np.zeros_like(recurrent)
    d_inputs = np.empty((2, time, 3 * hidden, n), dtype=np.float32)
    carry = np.zeros((2, hidden, n), dtype=np.float32)
    for t in range(time - 1, -1, -1):
        before, z, r, new, recalled, mask = trace[t]
        back = time - 1 - t
        dh = carry
        dh[0] += d_both[t, :hidden]
        dh[1] += d_both[back, hidden:]
        dh *= mask
        d_new = dh * (1 - z) * _slope(new)
        d_z = dh * (before - new) * _slope(2 * z - 1) / 2
        d_r = d_new * recalled * _slope(2 * r - 1) / 2
        d_inputs[0, t], d_inputs[1, back] = np.concatenate([d_z, d_r, d_new], axis=1)
        d_gates = np.concatenate([d_z, d_r, d_new * r], axis=1)
        grad_recurrent += np.matmul(before, d_gates.transpose(0, 2, 1))
        carry = dh * z + np.matmul(recurrent, d_gates)
    grad_inputs = np.zeros_like(inputs)
    order = np.argsort(symbols, axis=None, kind="stable")
    seen, first = np.unique(symbols.ravel()[order], return_index=True)
    for side in range(2):
        flat = d_inputs[side].transpose(0, 2, 1).reshape(-1, 3 * hidden)
        grad_inputs[side, seen] = np.add.reduceat(flat[order], first)
    return loss, [grad_inputs, grad_recurrent, grad_out, grad_bias]


def fit(pieces: list[bytes], labels: np.ndarray, languages: int, steps: int = STEPS, seed: int = SEED) -> list[np.ndarray]:
    """Weights after ``steps`` of Adam; every batch draws languages evenly, then pieces."""
    rng = np.random.default_rng(seed)
    weights = initial(languages, seed=seed)
    longest = max(map(len, pieces))
    symbols = np.full((len(pieces), longest), NONE, dtype=np.int64)
    for i, piece in enumerate(pieces):
        symbols[i, : len(piece)] = np.frombuffer(piece, np.uint8)
    of = [np.flatnonzero(labels == k) for k in range(languages)]
    mean, spread = ([np.zeros_like(w) for w in weights] for _ in range(2))
    for step in range(1, steps + 1):
        drawn = np.array([of[k][rng.integers(len(of[k]))] for k in rng.integers(languages, size=BATCH)])
        _, grads = gradients(weights, np.ascontiguousarray(symbols[drawn].T), labels[drawn])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * (1 - (step - 1) / steps)
        for w, g, m, v in zip(weights, grads, mean, spread):
            g = g * np.float32(min(1.0, 1.0 / max(size, 1e-12)))
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.01) * (g * g - v)
            w -= np.float32(rate) * (m / np.float32(1 - 0.9**step)) / (np.sqrt(v / np.float32(1 - 0.99**step)) + np.float32(1e-6))
    return weights


def windows_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(symbols (time, windows), text of each window) for all texts, ``AT_ONCE`` windows at a time."""
    counts = -(-np.diff(offsets) // WINDOW)
    ends = np.cumsum(counts)
    around = np.arange(-CONTEXT, WINDOW + CONTEXT)[:, None]
    for first in range(0, int(ends[-1]) if len(ends) else 0, AT_ONCE):
        number = np.arange(first, min(first + AT_ONCE, int(ends[-1])))
        text = np.searchsorted(ends, number, side="right")
        start = offsets[text] + (number - (ends[text] - counts[text])) * WINDOW
        at = start + around
        symbols = data[np.clip(at, 0, len(data) - 1)].astype(np.int64)
        symbols[(at < offsets[text]) | (at >= offsets[text + 1])] = NONE
        yield symbols, text


def pooled(weights: list[np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, languages): mean probabilities over all bytes of each text; 0 for empty texts."""
    out = np.zeros((len(offsets) - 1, weights[2].shape[1]))
    core = slice(CONTEXT, CONTEXT + WINDOW)
    for symbols, text in windows_of(data, offsets):
        found = label_probabilities(weights, states(weights, symbols)[core])
        found *= (symbols[core] != NONE)[:, None]
        np.add.at(out, text, found.sum(0, dtype=np.float64).T)
    return out / np.maximum(np.diff(offsets), 1)[:, None]


def _pieces(sample: int):
    """The task's ``sample`` pieces of each language with the smallest hashes."""

    def pieces(batches):
        best: dict[str, list] = {}
        held: dict[str, set] = {}
        for batch in batches:
            langs = batch.column(batch.schema.names.index("lang")).to_pylist()
            texts = batch.column(batch.schema.names.index("text"))
            for row, rows, data, offsets in text_chunks(texts):
                for i in range(rows):
                    lang, low, high = langs[row + i], int(offsets[i]), int(offsets[i + 1])
                    if high == low:
                        continue
                    n = min(PER_TEXT, -(-(high - low) // PIECE))
                    starts = low + np.linspace(0, max(0, high - low - PIECE), n).astype(np.int64)
                    ends = np.minimum(starts + PIECE, high)
                    heap, seen = best.setdefault(lang, []), held.setdefault(lang, set())
                    # Hashes of the pieces' own bytes: a piece has the same hash wherever it stands.
                    hashes = span_hashes(data[low:high], starts - low, ends - low, PLAIN)
                    for h, a, b in zip(hashes.tolist(), starts, ends):
                        if h in seen or len(heap) >= sample and h >= -heap[0][0]:
                            continue
                        seen.add(h)
                        heapq.heappush(heap, (-h, data[a:b].tobytes()))
                        if len(heap) > sample:
                            seen.discard(-heapq.heappop(heap)[0])
        for lang, heap in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(heap), pa.string()), pa.array([-h for h, _ in heap], pa.uint64()).view(pa.int64()), pa.array([p for _, p in heap], pa.binary())],
                names=["lang", "hash", "piece"],
            )

    return pieces


def _trained(steps: int, seed: int):
    """One row: the languages and the weights fitted to all pieces; no row without pieces."""

    def trained(batches):
        rows = sorted((r["lang"], r["hash"], r["piece"]) for batch in batches for r in batch.to_pylist())
        if not rows:
            return
        languages = sorted({r[0] for r in rows})
        labels = np.array([languages.index(r[0]) for r in rows])
        weights = fit([r[2] for r in rows], labels, len(languages), steps, seed)
        yield pa.RecordBatch.from_arrays(
            [pa.array([languages], pa.list_(pa.string())), pa.array([[w.tobytes() for w in weights]], pa.list_(pa.binary()))],
            names=["languages", "weights"],
        )

    return trained


class Identifier:
    """Languages in sorted order and the weights of a trained network."""

    def __init__(self, languages: list[str], weights: list[np.ndarray]):
        self.languages, self.weights = languages, weights

    def predict(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
        """One row per row of ``docs``: id, the columns ``more``, ``lang_pred``, ``score``.

        ``score`` is the mean probability of the language.  Null texts, texts
        without a letter, and all texts where nothing was learned are ``und``
        with score 0; ties go to the first language.  Rows may repeat, ids may
        be null; other columns of ``docs`` are ignored.
        """
        text_batches(docs.sparkSession)
        rows = docs.select(
            F.col(id_col).alias("doc"), *[c.alias(f"_{i}") for i, c in enumerate(more.values())],
            F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col)).alias("text"),
        )
        kept = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields if f.name != "text"]
        known = docs.sparkSession.sparkContext.broadcast((list(self.languages), list(self.weights)))
        schema = ", ".join(f"`{n}` {t}" for n, t in kept) + ", lang_pred string, score double"
        found = rows.mapInArrow(_predicted(known, [n for n, _ in kept]), schema)
        return found.toDF(id_col, *more, "lang_pred", "score")


def _predicted(known, kept: list[str]):
    def predicted(batches):
        languages, weights = known.value
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index("text"))
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for first, rows, data, offsets in text_chunks(texts):
                if not len(data) or not languages:
                    continue
                found = pooled(weights, data, offsets)
                for i in np.flatnonzero(np.diff(offsets)):
                    best = int(found[i].argmax())
                    lang[first + i], score[first + i] = languages[best], min(1.0, found[i, best])
            columns = [batch.column(names.index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lang, pa.string()), pa.array(score)], names=[*kept, "lang_pred", "score"])

    return predicted


def train_identifier(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, steps: int = STEPS, seed: int = SEED
) -> Identifier:
    """A network that tells the non-null languages of ``docs`` apart.

    It learns from ``sample`` pieces of each language at most (the bound of what
    one task holds); texts without a letter teach nothing.  Without labelled
    text it knows no language.
    """
    text_batches(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    pieces = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _pieces(sample), "lang string, hash bigint, piece binary"
    )
    chosen = first_rows(pieces.distinct(), "lang", [F.col("hash"), F.col("piece")], sample).drop("rank")
    fitted = stored(chosen.coalesce(1).mapInArrow(_trained(steps, seed), "languages array<string>, weights array<binary>"), "network")
    row = fitted.first()
    if row is None:
        return Identifier([], [])
    shapes = [w.shape for w in initial(len(row["languages"]))]
    return Identifier(row["languages"], [np.frombuffer(bytes(w), np.float32).reshape(s) for w, s in zip(row["weights"], shapes)])
