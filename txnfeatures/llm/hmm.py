"""A hidden Markov language model of whole documents.

A text is its words (A-Z lower-cased) and one end token.  The model moves
through latent states and emits a symbol for each token; a symbol is one of
``SYMBOLS`` hash buckets of the vocabulary, which bounds the emission table no
matter how many words there are.  The word itself is drawn from its bucket by
its training count plus one, with one place for unknown words, so probabilities
over all words sum to one.  The bucket part of a text's probability does not
depend on states, hence

    log P(text) = log P(symbols), by the scaled forward recursion
                + sum over tokens of log ((c + 1) / (C + V + 1))

with C, V the bucket's training tokens and distinct words.  The counts c are
exact and of unbounded number: they meet the texts in a join, not a broadcast.

Training is Baum-Welch: every round, each partition runs forward and backward
over all its training texts and returns expected counts, which Spark sums by
symbol.  The recursions are exact over whole texts.  They run on many windows of
``WINDOW`` tokens at once: each window's transfer matrix first, then a chain
over the windows of each text for the vectors at their edges.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnfeatures.llm.store import stored
from txnfeatures.llm.words import Words, stream, text_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATES, SYMBOLS, ROUNDS, WINDOW, SEED = 4, 1 << 15, 4, 32, 7
#: A word is hot when it makes up at least 1/HOT of the training tokens: never more than HOT words (16 bytes each).
HOT = 1 << 21
#: Share of the overall symbol frequencies in each state's emissions: no state rules a symbol out.
SHARED = 0.1
#: Stands for the end of a text among word hashes.
END = np.uint64(0xE5D0F7EC7E5D0F7E)
RESCALE = 8
CHUNK = 1 << 21


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of some texts, the end token included, and the offsets by text."""
    words = Words(data, offsets)
    n = len(offsets) - 1
    at = words.first + np.arange(n + 1)
    tokens = np.empty(at[-1], dtype=np.uint64)
    ends = at[1:] - 1
    inside = np.ones(len(tokens), dtype=bool)
    inside[ends] = False
    tokens[inside] = words.hashes()
    tokens[ends] = END
    return tokens, at


def symbols_of(tokens: np.ndarray, symbols: int) -> np.ndarray:
    return (tokens & np.uint64(symbols - 1)).astype(np.int64)


@dataclass
class Parameters:
    """start (states), move (states, states), emit (symbols, states)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


class Windows:
    """Texts cut into windows of ``WINDOW`` symbols, -1 after the end of a text."""

    def __init__(self, symbols: np.ndarray, at: np.ndarray, model: Parameters):
        self.model, k = model, len(model.start)
        lengths = np.diff(at)
        self.count = -(-lengths // WINDOW)
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        self.n = int(self.first[-1])
        self.grid = np.full(self.n * WINDOW, -1, dtype=np.int64)
        self.grid[np.arange(len(symbols)) + np.repeat(self.first[:-1] * WINDOW - at[:-1], lengths)] = symbols
        self.grid = self.grid.reshape(self.n, WINDOW)
        self.order = np.argsort(-self.count, kind="stable")
        # Transfer matrix of each window: from the state before it to the state at its end.
        self.through = np.broadcast_to(np.eye(k), (self.n, k, k)).copy()
        self.log = np.zeros(self.n)
        for t in range(WINDOW):
            col = self.grid[:, t]
            rows = np.flatnonzero(col >= 0)
            if not len(rows):
                break
            step = (self.through[rows].reshape(-1, k) @ model.move).reshape(-1, k, k)
            self.through[rows] = step * model.emit[col[rows]][:, None, :]
            if t % RESCALE == RESCALE - 1 or t == WINDOW - 1:
                scale = self.through.sum((1, 2))
                self.through /= scale[:, None, None]
                self.log += np.log(scale)

    def active(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Texts that have a window number ``j``, and that window."""
        texts = self.order[: np.searchsorted(-self.count[self.order], -j, side="left")]
        return texts, self.first[texts] + j

    def forward(self) -> tuple[np.ndarray, np.ndarray]:
        """State distribution before each window; natural log probability of each text."""
        k = len(self.model.start)
        before, total = np.zeros((self.n, k)), np.zeros(len(self.count))
        state = np.tile(self.model.start, (len(self.count), 1))
        for j in range(int(self.count.max(initial=0))):
            texts, window = self.active(j)
            before[window] = state[texts]
            after = np.einsum("ni,nij->nj", state[texts], self.through[window])
            scale = after.sum(1)
            state[texts] = after / scale[:, None]
            total[texts] += np.log(scale) + self.log[window]
        return before, total

    def backward(self) -> np.ndarray:
        """For each window, weights of the states at its end by what follows."""
        k = len(self.model.start)
        after, weight = np.zeros((self.n, k)), np.ones((len(self.count), k))
        for j in reversed(range(int(self.count.max(initial=0)))):
            texts, window = self.active(j)
            after[window] = weight[texts]
            back = np.einsum("nij,nj->ni", self.through[window], weight[texts])
            weight[texts] = back / back.sum(1)[:, None]
        return after

    def expected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of start states, moves, and emissions (symbols, states)."""
        move, emit = self.model.move, self.model.emit
        before, _ = self.forward()
        k = before.shape[1]
        states = np.empty((WINDOW + 1, self.n, k))
        states[0] = before
        for t in range(WINDOW):
            col = self.grid[:, t]
            rows = np.flatnonzero(col >= 0)
            states[t + 1] = states[t]
            step = (states[t][rows] @ move) * emit[col[rows]]
            states[t + 1][rows] = step / step.sum(1)[:, None]
        weight, moves = self.backward(), np.zeros((k, k))
        shares = np.empty((WINDOW, self.n, k))
        for t in reversed(range(WINDOW)):
            col = self.grid[:, t]
            rows = np.flatnonzero(col >= 0)
            share = states[t + 1][rows] * weight[rows]
            shares[t, rows] = share / share.sum(1)[:, None]
            onward = emit[col[rows]] * weight[rows]
            back = onward @ move.T
            moves += move * ((states[t][rows] / (states[t][rows] * back).sum(1)[:, None]).T @ onward)
            weight[rows] = back / back.sum(1)[:, None]
        heads = self.model.start * weight[self.first[:-1]]
        flat = self.grid.T.ravel()
        seen = flat >= 0
        counts = [np.bincount(flat[seen], shares[..., i].ravel()[seen], len(emit)) for i in range(k)]
        return (heads / heads.sum(1)[:, None]).sum(0), moves, np.stack(counts, 1)


def _counting(batches):
    """(word hash, count) of the tokens, summed over a few million of them."""
    pending, size = [], 0

    def flush():
        words, counts = np.unique(np.concatenate(pending), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))], names=["word", "c"])

    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column(0)):
            tokens, _ = token_hashes(data, offsets)
            pending.append(tokens)
            size += len(tokens)
            if size >= 1 << 22:
                yield flush()
                pending, size = [], 0
    if pending:
        yield flush()


def _expecting(shared, symbols: int):
    """Expected counts of one partition: rows (symbol, one number for each state); moves and starts have symbols below 0."""

    def expecting(batches):
        model = shared.value
        k = len(model.start)
        start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((symbols, k))
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0), CHUNK):
                tokens, at = token_hashes(data, offsets)
                s, m, e = Windows(symbols_of(tokens, symbols), at, model).expected()
                start, move, emit = start + s, move + m, emit + e
        used = np.flatnonzero(emit.sum(1))
        ids = np.concatenate((used, -1 - np.arange(k), [-1 - k]))
        values = np.concatenate((emit[used], move, start[None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids.astype(np.int32))] + [pa.array(values[:, i]) for i in range(k)],
            names=["symbol"] + [f"s{i}" for i in range(k)],
        )

    return expecting


def _scoring(shared, symbols: int):
    """For each text: tokens, known hot tokens, the sums that need no join, and the hashes of all other tokens."""

    def scoring(batches):
        model, spread, hot, hot_counts = shared.value
        gain = np.log10(hot_counts + 1.0)
        for batch in batches:
            names = batch.schema.names
            kept = [batch.column(names.index(c)) for c in ("doc", "held_out")]
            n, known, words_sum, rest, cold, cold_n = [], [], [], [], [], []
            for _, rows, data, offsets in text_chunks(batch.column(names.index("text")), CHUNK):
                tokens, at = token_hashes(data, offsets)
                symbol = symbols_of(tokens, symbols)
                place = np.minimum(np.searchsorted(hot, tokens), max(len(hot) - 1, 0))
                is_hot = hot[place] == tokens if len(hot) else np.zeros(len(tokens), dtype=bool)
                _, logs = Windows(symbol, at, model).forward()
                n.append(np.diff(at))
                known.append(np.add.reduceat(is_hot.astype(np.int64), at[:-1]))
                words_sum.append(np.add.reduceat(np.where(is_hot, gain[place], 0.0) if len(hot) else np.zeros(len(tokens)), at[:-1]))
                rest.append(logs / np.log(10) - np.add.reduceat(spread[symbol], at[:-1]))
                cold.append(tokens[~is_hot])
                cold_n.append(np.add.reduceat((~is_hot).astype(np.int64), at[:-1]))
            flat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
            ends = np.concatenate(([0], np.cumsum(flat(cold_n, np.int64)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat(cold, np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(flat(n, np.int64)), pa.array(flat(known, np.int64)), pa.array(flat(words_sum, float)),
                 pa.array(flat(rest, float)), lists],
                names=["doc", "held_out", "n_tokens", "hot_known", "hot_sum", "rest", "cold"],
            )

    return scoring


@dataclass
class HiddenMarkovModel:
    """A trained model: parameters and counts by symbol in memory (bounded), counts by word as a stored table."""

    parameters: Parameters
    symbols: int
    counts: DataFrame
    tokens: int
    distinct: int
    bucket_tokens: np.ndarray
    bucket_words: np.ndarray

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out=None) -> DataFrame:
        """One row per row of ``docs``: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
        (add-one unigram) and ``score`` (this model), both log10.

        A null or empty text is just its end token.  Rows that share an id, or
        have none, are scored each by itself.  ``held_out`` is a condition that
        marks rows kept from training; it is only passed on.
        """
        spark = docs.sparkSession
        is_hot = F.col("c") * HOT >= self.tokens
        hot = self.counts.where(is_hot).toArrow()
        words = hot.column("word").combine_chunks().to_numpy().view(np.uint64)
        order = np.argsort(words)
        spread = np.log10(self.bucket_tokens + self.bucket_words + 1.0)
        shared = spark.sparkContext.broadcast(
            (self.parameters, spread, words[order], hot.column("c").combine_chunks().to_numpy()[order])
        )
        source = docs.select(
            F.col(id_col).alias("doc"),
            F.coalesce(held_out if held_out is not None else F.lit(False), F.lit(False)).alias("held_out"),
            F.col(text_col).alias("text"),
        )
        kind = source.schema["doc"].dataType.simpleString()
        scored = stored(
            source.mapInArrow(
                _scoring(shared, self.symbols),
                f"doc {kind}, held_out boolean, n_tokens bigint, hot_known bigint, hot_sum double, rest double, cold array<bigint>",
            ).withColumn("row", F.monotonically_increasing_id()),
            "scored",
        )
        # A cold word is rare in training; words that training lacks find no partner and add nothing.
        cold = (
            scored.select("row", F.explode("cold").alias("word"))
            .join(self.counts.where(~is_hot), "word")
            .groupBy("row")
            .agg(F.sum(F.log10(F.col("c") + 1)).alias("cold_sum"), F.count("*").alias("cold_known"))
        )
        gain = F.col("hot_sum") + F.coalesce("cold_sum", F.lit(0.0))
        base = float(np.log10(self.tokens + self.distinct + 1.0))
        return scored.drop("cold").join(cold, "row", "left").select(
            F.col("doc").alias(id_col),
            "held_out",
            "n_tokens",
            (F.col("hot_known") + F.coalesce("cold_known", F.lit(0))).alias("n_known"),
            F.lit(self.tokens).cast("bigint").alias("train_tokens"),
            (gain - F.col("n_tokens") * base).alias("base_score"),
            (gain + F.col("rest")).alias("score"),
        )


def train(
    docs: DataFrame, text_col: str = "text", states: int = STATES, symbols: int = SYMBOLS, rounds: int = ROUNDS
) -> HiddenMarkovModel:
    """Fit on all rows of ``docs``; null texts count as empty, an empty table gives a model of smoothing alone.

    ``symbols`` is a power of two.  What the driver holds is bounded: two
    numbers and one emission row for each symbol.
    """
    spark = docs.sparkSession
    texts = docs.select(text_col)
    counts = stored(
        texts.mapInArrow(_counting, "word bigint, c bigint").groupBy("word").agg(F.sum("c").alias("c")), "counts"
    )
    by_symbol = (
        counts.groupBy(F.col("word").bitwiseAND(symbols - 1).alias("symbol"))
        .agg(F.sum("c").alias("tokens"), F.count("*").alias("words"))
        .toArrow()
    )
    at = by_symbol.column("symbol").to_numpy()
    tokens, words = np.zeros(symbols, dtype=np.int64), np.zeros(symbols, dtype=np.int64)
    tokens[at], words[at] = by_symbol.column("tokens").to_numpy(), by_symbol.column("words").to_numpy()
    overall = (tokens + 1.0) / (tokens.sum() + symbols)
    noise = (stream(symbols * states, SEED) >> np.uint64(11)).astype(float).reshape(symbols, states) / (1 << 53)
    emit = overall[:, None] * (0.5 + noise)
    stay = np.full((states, states), 0.3 / max(states - 1, 1)) + np.eye(states) * (0.7 - 0.3 / max(states - 1, 1))
    model = Parameters(np.full(states, 1 / states), stay / stay.sum(1)[:, None], emit / emit.sum(0))
    columns = [f"s{i}" for i in range(states)]
    for _ in range(rounds if tokens.sum() else 0):
        shared = spark.sparkContext.broadcast(model)
        summed = (
            texts.mapInArrow(_expecting(shared, symbols), "symbol int, " + ", ".join(f"{c} double" for c in columns))
            .groupBy("symbol")
            .agg(*[F.sum(c).alias(c) for c in columns])
            .toArrow()
        )
        ids = summed.column("symbol").to_numpy()
        values = np.stack([summed.column(c).to_numpy() for c in columns], 1)
        emit, move, start = np.zeros((symbols, states)), np.zeros((states, states)), np.zeros(states)
        emit[ids[ids >= 0]] = values[ids >= 0]
        for i, row in zip(ids[ids < 0], values[ids < 0]):
            if i == -1 - states:
                start = row
            else:
                move[-1 - i] = row
        emit = (1 - SHARED) * emit / np.maximum(emit.sum(0), 1e-300) + SHARED * overall[:, None]
        model = Parameters(
            (start + 1) / (start + 1).sum(), (move + 1) / (move + 1).sum(1)[:, None], emit / emit.sum(0)
        )
        shared.unpersist()
    return HiddenMarkovModel(model, symbols, counts, int(tokens.sum()), int(words.sum()), tokens, words)


def is_held_out(id_col: str = "doc_id", parts: int = 7, part: int = 2):
    """Rows whose crc32 of the id as text leaves ``part``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))
