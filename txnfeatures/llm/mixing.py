"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents all have the same expected number of copies, its target
over its size.  The whole part is taken; the fractions are rounded together:
two documents trade mass, weighted by their sizes, in a random direction (with
the odds that keep both expectations) until one of them is 0 or 1.  A trade
changes no source's words, so what is left at the end is one fraction for each
source, rounded to the nearer side: taken words miss the target by at most half a document.

The trades run as a tree.  First each bucket of some thousand documents, in
order of falling size, down to one open document, most often a small one; then ``FAN`` open documents of
neighbouring buckets at a time, level by level, to one for each source.  All
draws are hashes of the documents traded, so reruns agree.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from txnfeatures.llm.store import stored
from txnfeatures.llm.words import Words, text_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Documents in a bucket, buckets met in one step of the tree.
BUCKET, FAN = 8192, 64
ADDED = ["_size", "_source_size", "_target", "_copies"]
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
MASK = (1 << 64) - 1


def draw(seed: int, a: int, b: int) -> float:
    """A number in [0, 1) that depends on two hashes."""
    x = (a * 0x9E3779B97F4A7C15 ^ b * 0xC2B2AE3D27D4EB4F ^ seed * 0x165667B19E3779F9) & MASK
    for _ in range(2):
        x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & MASK
    return ((x ^ (x >> 29)) >> 11) / (1 << 53)


def trade(p: float, wp: float, q: float, wq: float, u: float) -> tuple[float, float]:
    """New fractions after one trade; at least one is 0 or 1 and p * wp + q * wq is as before."""
    up, down = min((1 - p) * wp, q * wq), min(p * wp, (1 - q) * wq)
    move = up if u * (up + down) < down else -down
    p, q = p + move / wp, q - move / wq
    snap = lambda x: 0.0 if x < 1e-12 else 1.0 if x > 1 - 1e-12 else x
    return snap(p), snap(q)


def _sizing(text_field: str | None):
    """Add ``_size``, the words of the text: field ``text_field`` of ``_row``, or the last column, which then goes."""

    def sizing(batches):
        for batch in batches:
            columns, names = batch.columns, batch.schema.names
            if text_field is None:
                text, columns, names = columns[-1], columns[:-1], names[:-1]
            else:
                text = pc.struct_field(columns[names.index("_row")], [text_field])
            counts = [Words(data, offsets).counts for _, _, data, offsets in text_chunks(text)]
            size = pa.array(np.concatenate(counts) if counts else np.zeros(0), pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, size], names=[*names, "_size"])

    return sizing


def targets(sizes: DataFrame) -> DataFrame:
    """Add ``target`` to (key, source, source_size), one row for each source.

    Sources in code point order, null last, weigh 1, 2, 3, 1 ...; a target is
    weight times a level, at most ``MOST_COPIES`` times the source's size, the
    level such that targets sum to all sizes.  Sources are few next to
    documents: the windows here see one row for each.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("_rank") - 1) % len(WEIGHTS) + 1)
    ranked = ranked.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * float(MOST_COPIES))
    order = W.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    everything = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # If all sources before this one are at their cap, the others share what is left by weight.
    left = F.sum("source_size").over(everything) - F.coalesce(
        F.sum("_cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)
    )
    sharing = F.sum("_weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    ranked = ranked.withColumn("_level", left / sharing).withColumn("_turn", F.row_number().over(order))
    fits = F.col("_cap") >= F.col("_weight") * F.col("_level")
    level = F.min_by("_level", F.when(fits, F.col("_turn"))).over(everything)
    return ranked.select("key", "source", "source_size", F.least("_cap", F.col("_weight") * level).alias("target"))


def _rounding(seed: int):
    """Rows sorted by (key, bucket): add ``_copies`` and ``_open``, the fraction still to be decided (one row a bucket)."""

    def rounding(batches):
        group = held = None  # held: the open row, [batch number, row, fraction, weight, hash]
        number, parked = 0, None

        def closing(fraction):
            base = parked.column(parked.schema.names.index("_copies"))[0].as_py()
            done = fraction in (0.0, 1.0)
            return with_columns(parked, [base + int(fraction) if done else base], [0.0 if done else fraction])

        def with_columns(batch, copies, open_):
            keep = [c for c in batch.schema.names if c not in ("_copies", "_open")]
            return pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.names.index(c)) for c in keep], pa.array(copies, pa.int64()), pa.array(open_, pa.float64())],
                names=[*keep, "_copies", "_open"],
            )

        for batch in batches:
            number += 1
            get = lambda c, b=batch: b.column(b.schema.names.index(c)).to_pylist()
            keys, buckets, sizes, rates, hashes = (get(c) for c in ("_key", "_bucket", "_size", "_rate", "_hash"))
            copies, open_ = [0] * len(keys), [0.0] * len(keys)
            absent = set()

            def settle(slot, fraction):
                """Note the outcome of an open row; one of an earlier batch is emitted now."""
                if slot[0] == number:
                    if fraction in (0.0, 1.0):
                        copies[slot[1]] += int(fraction)
                    else:
                        open_[slot[1]] = fraction
                    return None
                return closing(fraction)

            for i, at in enumerate(zip(keys, buckets)):
                if at != group:
                    if held is not None and (out := settle(held, held[2])) is not None:
                        yield out
                    group, held = at, None
                if not sizes[i]:
                    continue
                copies[i] = int(rates[i])
                fraction = rates[i] - copies[i]
                if fraction < 1e-12:
                    continue
                row = [number, i, fraction, float(sizes[i]), hashes[i] & MASK]
                if held is None:
                    held = row
                    continue
                p, q = trade(held[2], held[3], fraction, row[3], draw(seed, held[4], row[4]))
                held[2], row[2] = p, q
                for one in (held, row):
                    if one[2] in (0.0, 1.0) and (out := settle(one, one[2])) is not None:
                        yield out
                held = next((one for one in (held, row) if one[2] not in (0.0, 1.0)), None)
            if held is not None and held[0] == number:
                parked = with_columns(batch.slice(held[1], 1), [copies[held[1]]], [0.0])
                absent.add(held[1])
            whole = with_columns(batch, copies, open_)
            yield whole.filter(pa.array([i not in absent for i in range(len(copies))], pa.bool_())) if absent else whole
        if held is not None:
            yield closing(held[2])

    return rounding


def _meeting(seed: int):
    """Trade between the open documents of neighbouring buckets; all but one get ``add`` 0 or 1."""

    def meeting(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["weight", "bucket"], ascending=[False, True]).reset_index(drop=True)
        fractions, held = list(rows["fraction"]), None
        for i in range(len(rows)):
            if held is None:
                held = i
                continue
            u = draw(seed, int(rows["hash"][held]) & MASK, int(rows["hash"][i]) & MASK)
            fractions[held], fractions[i] = trade(fractions[held], rows["weight"][held], fractions[i], rows["weight"][i], u)
            held = next((j for j in (held, i) if fractions[j] not in (0.0, 1.0)), None)
        rows["fraction"] = fractions
        return rows

    return meeting


def mix(
    docs: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    seed: int = 29,
) -> DataFrame:
    """The columns of ``keep`` (all, if not given) with ``_size``, ``_source_size``, ``_target`` and ``_copies``.

    One row per row of ``docs``; ``_copies`` says how often the mix takes it, at
    most ``MOST_COPIES``.  A null or word-less text has size 0 and is taken 0
    times.  A null source is a source of its own.  Null and repeated ids and
    equal rows are each a document; equal ones may get different copies.
    Existing columns of these four names are replaced.
    """
    keep = [c for c in (keep or docs.columns) if c not in ADDED]
    return _mixed_rows(docs, source_col, id_col, text_col, keep, seed).select("_row.*", *ADDED)


def _mixed_rows(docs: DataFrame, source_col: str, id_col: str, text_col: str, keep: list[str], seed: int) -> DataFrame:
    """``_row``, a struct of the columns of ``keep``, and ``ADDED``."""
    key = F.when(F.col(source_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source_col).cast("string")))
    # The row travels as one struct, so no name of a column can clash with those
    # needed here; a text that is not kept goes before anything is shuffled.
    row, hashed = F.struct(*keep).alias("_row"), F.xxhash64(F.lit(seed), id_col, text_col).alias("_hash")
    text = [] if text_col in keep else [F.col(text_col).alias("_text")]
    named = docs.select(row, key.alias("_key"), hashed, *text)
    schema = T.StructType([*named.drop("_text").schema, T.StructField("_size", T.LongType())])
    rows = named.mapInArrow(_sizing(None if text else text_col), schema)
    sizes = rows.groupBy(F.col("_key").alias("key")).agg(F.sum("_size").alias("source_size"), F.count("*").alias("docs"))
    source = F.when(F.col("key") != "-", F.substring("key", 2, 1 << 30))
    sizes = stored(sizes.withColumn("source", source), "sizes")
    plan = stored(targets(sizes.drop("docs")).join(sizes.select("key", "docs"), "key"), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.select(
        F.col("key").alias("_key"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
        rate.alias("_rate"), F.ceil(F.col("docs") / BUCKET).alias("_buckets"),
    )
    ready = rows.join(plan, "_key").withColumn("_bucket", F.pmod(F.xxhash64("_hash"), F.col("_buckets"))).drop("_buckets")
    schema = T.StructType([*ready.schema, T.StructField("_copies", T.LongType()), T.StructField("_open", T.DoubleType())])
    ordered = ready.repartition("_key", "_bucket").sortWithinPartitions("_key", "_bucket", F.desc("_size"), "_hash")
    rounded = stored(ordered.mapInArrow(_rounding(seed), schema), "rounded")
    open_ = rounded.where("_open > 0")
    level = stored(
        open_.select(
            F.col("_key").alias("key"), F.col("_bucket").alias("bucket"), F.col("_size").cast("double").alias("weight"),
            F.col("_hash").alias("hash"), F.col("_open").alias("fraction"),
        ),
        "open",
    )
    decided = []
    span, buckets = 1, -(-(sizes.agg(F.max("docs")).first()[0] or 0) // BUCKET)
    while buckets > span:
        span *= FAN
        group = F.floor(F.col("bucket") / span)
        level = stored(level.groupBy("key", group.alias("_group")).applyInPandas(_meeting(seed), level.schema), "open")
        decided.append(level.where("fraction IN (0, 1)"))
        level = level.where("fraction > 0 AND fraction < 1")
    # One open document for each source is left, a small one as the order is by falling size: to the nearer side.
    decided.append(level.withColumn("fraction", F.when(F.col("fraction") >= 0.5, 1.0).otherwise(0.0)))
    adds = decided[0]
    for more in decided[1:]:
        adds = adds.union(more)
    adds = adds.select(F.col("key").alias("_key"), F.col("bucket").alias("_bucket"), F.col("fraction").cast("bigint").alias("_add"))
    settled = open_.join(adds, ["_key", "_bucket"]).withColumn("_copies", F.col("_copies") + F.col("_add"))
    columns = ["_row", *ADDED]
    return rounded.where("_open = 0").select(columns).union(settled.select(columns))


def mixed(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", seed: int = 29) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, columns as they were."""
    taken = _mixed_rows(docs, source_col, id_col, text_col, docs.columns, seed)
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))
    return taken.select("_row", repeated.alias("_copy")).select("_row.*")
