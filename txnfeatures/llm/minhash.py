"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, the smallest
and the largest hash, so a signature costs half the hash evaluations.  Bands of
values make buckets; links between documents of a bucket are confirmed on the
full shingle sets, and documents joined by confirmed links form a component.

No step emits all pairs of a bucket.  Documents with equal sets are one node.
In each bucket the node with the most bucket mates is compared with the others
(a star), which joins groups of copies.  What is left are buckets whose nodes
still belong to different components; those outside its largest component are
compared with all, in blocks of about ``BLOCK`` nodes, and a comparison returns
only links that join components.  That last step is exact for buckets of any
size; its work grows with the number of nodes that the stars left unlinked
times that of their bucket mates.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnfeatures.llm.store import Run, stored
from txnfeatures.llm.words import Words, mix, run_hashes, stream, text_chunks
from txnfeatures.operators.joins import attach_by_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Signature values in a band; half of them smallest, half largest hashes in turn.
ROWS = 5
#: Probability that a pair right at the threshold shares no band.
MISS = 1e-6
#: Nodes on each side of one comparison of the last step, members compared with one copy of a star's centre.
BLOCK = 256


def bands_for(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS)))


def shingle_sets(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, rows, data, offsets in text_chunks(texts):
        words = Words(data, offsets)
        grams, at = run_hashes(words.hashes(), words.first, shingle, short=True)
        for i in range(rows):
            yield np.unique(grams[at[i] : at[i + 1]])


def set_key(grams: np.ndarray) -> bytes:
    """128 bits that stand for a shingle set."""
    n = np.uint64(len(grams))
    return np.array(
        [mix(grams + np.uint64(1)).sum() + n, mix(grams * np.uint64(3)).sum() ^ n], dtype=np.uint64
    ).tobytes()


def signatures(grams: np.ndarray, at: np.ndarray, permutations: int) -> np.ndarray:
    """(texts, 2 * permutations): smallest and largest hash of each permutation.  No text may be empty."""
    flips, factors = stream(permutations, 11), stream(permutations, 12) | np.uint64(1)
    out = np.empty((len(at) - 1, 2 * permutations), dtype=np.uint64)
    for i in range(permutations):
        hashed = (grams ^ flips[i]) * factors[i]
        hashed ^= hashed >> np.uint64(29)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        out[:, 2 * i] = np.minimum.reduceat(hashed, at[:-1])
        out[:, 2 * i + 1] = np.maximum.reduceat(hashed, at[:-1])
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """(texts, bands): one hash of the values of each band."""
    out = np.zeros((len(signature), bands), dtype=np.uint64)
    for b in range(bands):
        for j in range(ROWS):
            out[:, b] = mix(out[:, b] + signature[:, b * ROWS + j] * np.uint64(2 * j + 1))
    return out


def _sketch(shingle: int, bands: int):
    permutations = -(-bands * ROWS // 2)

    def sketch(batches):
        for batch in batches:
            columns = batch.schema.names
            texts = batch.column(columns.index("text"))
            n, keys, found = [], [], []
            for _, rows, data, offsets in text_chunks(texts):
                words = Words(data, offsets)
                grams, at = run_hashes(words.hashes(), words.first, shingle, short=True)
                full = np.flatnonzero(np.diff(at))
                for i in range(rows):
                    unique = np.unique(grams[at[i] : at[i + 1]])
                    n.append(len(unique))
                    keys.append(set_key(unique) if len(unique) else None)
                values = np.zeros((rows, bands), dtype=np.uint64)
                if len(full):
                    # Texts without windows take no room, so the starts of the others are all there is.
                    starts = np.append(at[full], at[-1])
                    values[full] = band_keys(signatures(grams, starts, permutations), bands)
                found.append(values)
            flat = np.concatenate(found) if found else np.zeros((0, bands), dtype=np.uint64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(flat) + 1) * bands, pa.int32()), pa.array(flat.ravel().view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(columns.index("doc")), batch.column(columns.index("seen")),
                 pa.array(n, pa.int64()), pa.array(keys, pa.binary()), lists],
                names=["doc", "seen", "n", "key", "bands"],
            )

    return sketch


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct hashes."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _matching(shingle: int):
    """Keep rows whose text has the set named by ``key``: an id may belong to several texts."""

    def matching(batches):
        for batch in batches:
            keys = batch.column(batch.schema.names.index("key")).to_pylist()
            sets = shingle_sets(batch.column(batch.schema.names.index("text")), shingle)
            same = pa.array([set_key(s) == k for s, k in zip(sets, keys)], pa.bool_())
            yield batch.filter(same).select(["node", "bands", "text"])

    return matching


def _stars(shingle: int, percent: int):
    """Rows sorted by (centre, part, centre first): compare each row with the last centre seen."""

    def stars(batches):
        centre, grams = None, None
        for batch in batches:
            cols = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            sets = shingle_sets(cols["text"], shingle)
            left, right = [], []
            for c, node, own in zip(cols["centre"].to_pylist(), cols["node"].to_pylist(), sets):
                if c == node:
                    centre, grams = c, own
                elif c == centre and linked(grams, own, percent):
                    left.append(c)
                    right.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return stars


def _blocks(shingle: int, percent: int):
    """Links of the nodes of one side to those of the other that join different components.

    Two nodes are compared only in the first band they share, so once in all.
    """

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        band = int(group["band"].iloc[0])
        sides = [group[group["probe"] == probe].drop_duplicates("node") for probe in (False, True)]
        (node, probe), labels = (x["node"].to_numpy() for x in sides), (x["label"].to_numpy() for x in sides)
        label, probe_label = labels
        out, parent = [], {c: c for c in [*label, *probe_label]}
        if not len(node) or not len(probe):
            return pd.DataFrame(out, columns=["a", "b"]).astype("int64")
        sets = list(shingle_sets(pa.array(sides[0]["text"]), shingle))
        sizes = np.array([len(x) for x in sets])
        flat, at = np.concatenate(sets), np.cumsum(sizes) - sizes
        bands, probe_bands = (np.stack(x["bands"].to_numpy())[:, :band] for x in sides)

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        for i, own in enumerate(shingle_sets(pa.array(sides[1]["text"]), shingle)):
            mine = root(probe_label[i])
            fits = (100 * sizes >= percent * len(own)) & (100 * len(own) >= percent * sizes)
            fits &= ~(bands == probe_bands[i]).any(1)
            fits &= np.array([root(c) != mine for c in label])
            if not fits.any():
                continue
            place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            common = np.add.reduceat((own[place] == flat).astype(np.int64), at)
            fits &= 100 * common >= percent * (sizes + len(own) - common)
            for j in np.flatnonzero(fits):
                if root(label[j]) != root(probe_label[i]):
                    out.append((node[j], probe[i]))
                    parent[root(probe_label[i])] = root(label[j])
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return compare


def components(edges: DataFrame, run: Run | None = None) -> DataFrame:
    """(node, label): the smallest node reachable over ``edges`` (a, b), for nodes with an edge.

    Each round every node takes the smallest label among its neighbours and
    itself, then the label of its label; rounds needed grow with the logarithm
    of the longest path.  A round is one job: it is stored, so nothing is
    recomputed after a loss, and the write counts the labels that changed.
    """
    run = run or Run(edges.sparkSession, "components")
    both = run.stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = run.stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        around = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "label", F.lit(None).cast("bigint").alias("was"))
        near = around.union(labels.select("node", "label", F.col("label").alias("was")))
        near = near.groupBy("node").agg(F.min("label").alias("label"), F.min("was").alias("was"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        after = near.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label"), "was")
        after, found = run.stored(after, "labels", changed=F.count_if(F.col("label") != F.col("was")))
        labels = after.drop("was")
        if not found["changed"]:
            return labels


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 85
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``, ``text_hash`` (xxhash64 of the text).

    Texts are lower-cased (A-Z); the set of a text is its distinct runs of
    ``shingle`` words, or the whole text where it has fewer words.  Two texts are
    linked when 100 * |both| >= percent * |either|.  ``component_id`` is the
    smallest id reachable; ``kept`` marks the rows that carry it.

    Null or word-less texts have 0 shingles, no links, and are their own
    component.  Rows that share an id are separate documents; a null id never
    names a component unless all ids in it are null, and is kept only then.
    Other columns of ``docs`` are ignored.  An empty table gives an empty result.
    """
    bands, run = bands_for(percent), Run(docs.sparkSession, "near-dedup")
    source = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).withColumn(
        "seen", F.xxhash64("text")
    )
    sketches = run.stored(
        source.mapInArrow(_sketch(shingle, bands), "doc bigint, seen bigint, n bigint, key binary, bands array<bigint>"),
        "sketches",
    )
    # One node for each distinct set.  (unnamed, at) finds one of its texts again.
    place = F.struct(F.col("doc").isNull().alias("unnamed"), F.coalesce("doc", "seen").alias("at"))
    nodes = run.stored(
        sketches.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min("doc").alias("first_doc"), F.min(place).alias("place"), F.count("*").alias("copies"), F.min("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    bucket = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    crowd = bucket.groupBy("band", "value").agg(F.count("*").alias("mates")).where("mates > 1")
    # Only buckets of two and more; every bucket knows how many nodes it has.
    buckets = run.stored(bucket.join(crowd, ["band", "value"]), "buckets")
    mates = buckets.groupBy("node").agg(F.sum("mates").alias("degree"))
    texts = _texts(source, nodes.join(mates.select("node"), "node", "left_semi"), shingle, run)
    centres = (
        buckets.join(mates, "node")
        .groupBy("band", "value")
        .agg(F.max_by("node", F.struct("degree", -F.col("node"))).alias("centre"))
    )
    pairs = buckets.join(centres, ["band", "value"]).where("node <> centre").select("centre", "node").distinct()
    links = run.stored(_star_links(pairs, texts, shingle, percent), "links")
    labels = components(links, run)
    more, found = run.stored(_rest_links(buckets, labels, texts, shingle, percent), "more", links=F.count("*"))
    if found["links"]:
        # From here on a component of the stars is one node.
        end = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
        joined = more.join(end("a"), "a", "left").join(end("b"), "b", "left")
        joined = joined.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
        joined = components(joined, run).select(F.col("node").alias("met"), F.col("label").alias("end"))
        labels = nodes.select("node").join(labels, "node", "left").withColumn("met", F.coalesce("label", "node"))
        labels = labels.join(joined, "met", "left").select("node", F.coalesce("end", "met").alias("label"))
    names = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = names.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    found = run.stored(names.join(first, "label").select("key", "copies", "component_id"), "components")
    run.discard("nodes", "buckets", "texts", "links", "more", "edges", "labels")
    out = attach_by_key(sketches.drop("bands"), found, "key", "copies", ["component_id"])
    component = F.coalesce("component_id", "doc")
    return out.select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc")).alias("kept"),
        F.col("seen").alias("text_hash"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id, with all its columns.

    Rows are told apart by a number of their own, stored with them, so ids may
    be missing or shared: of rows with equal ids the one with the smallest text
    hash stays, and rows without an id only where no row of the group has one.
    Rows without words are groups of their own.  Columns may have any names.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = stored(docs.select(row.alias("row"), F.monotonically_increasing_id().alias("number")), "numbered")
    own = rows.select("number", F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).alias("text"))
    found = near_duplicates(own, "number", "text", shingle, percent).select("number", "component_id", "text_hash")
    first = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash", "number")
    kept = found.join(own.select("number", "id"), "number").groupBy("component_id").agg(F.min(first).alias("first"))
    return rows.join(kept.select(F.col("first.number").alias("number")), "number", "left_semi").select("row.*")


def _texts(source: DataFrame, nodes: DataFrame, shingle: int, run: Run) -> DataFrame:
    """(node, bands, text) for the given nodes, each once whichever of its rows it is found in."""
    keyed = source.select(F.col("doc").isNull().alias("unnamed"), F.coalesce("doc", "seen").alias("at"), "text")
    wanted = nodes.select("place.unnamed", "place.at", "node", "key", "bands")
    matching = (
        keyed.join(wanted, ["unnamed", "at"])
        .select("node", "key", "bands", "text")
        .mapInArrow(_matching(shingle), "node bigint, bands array<bigint>, text string")
    )
    # Rows may repeat: each task hands on one text of a node, whichever it is.
    one = matching.groupBy("node").agg(F.first(F.struct("bands", "text")).alias("one"))
    return run.stored(one.select("node", "one.bands", "one.text"), "texts")


def _star_links(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Confirmed links of (centre, node) pairs.

    A centre's text goes once to every part of its members, not once to every
    pair; the number of parts follows the number of members, so no centre is hot.
    """
    sizes = pairs.groupBy("centre").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("parts"))
    members = pairs.join(sizes, "centre").select(
        "centre", "node", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part")
    )
    heads = sizes.select("centre", F.col("centre").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rows = members.union(heads).join(texts, "node").select("centre", "part", "node", "text")
    dealt = rows.repartition("centre", "part").sortWithinPartitions("centre", "part", F.col("centre") != F.col("node"))
    return dealt.mapInArrow(_stars(shingle, percent), "a bigint, b bigint")


def _rest_links(buckets: DataFrame, labels: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between nodes that share a bucket and not a component.

    The nodes of a bucket outside its largest component (the probes) meet all
    its nodes; the largest component, which stars found, is not compared with itself.
    """
    place = ["band", "value"]
    known = buckets.join(labels, "node", "left").select(*place, "node", F.coalesce("label", "node").alias("label"))
    sizes = known.groupBy(*place, "label").agg(F.count("*").alias("n"))
    open_ = sizes.groupBy(*place).agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
    open_ = open_.where("all > most").select(
        *place, "main",
        F.ceil(F.col("all") / BLOCK).alias("parts"), F.ceil((F.col("all") - F.col("most")) / BLOCK).alias("chunks"),
    )
    placed = known.join(open_, place)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    every = placed.select(
        *place, "node", "label", F.pmod(F.xxhash64("node", "band"), F.col("parts")).alias("part"), each("chunks").alias("chunk"), F.lit(False).alias("probe")
    )
    probes = placed.where("label <> main").select(
        *place, "node", "label", each("parts").alias("part"), F.pmod(F.xxhash64("band", "node"), F.col("chunks")).alias("chunk"), F.lit(True).alias("probe")
    )
    rows = every.union(probes).join(texts, "node")
    return rows.groupBy(*place, "part", "chunk").applyInPandas(_blocks(shingle, percent), "a bigint, b bigint")
