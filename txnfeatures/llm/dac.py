"""Token ids as directly addressable codes.

An id is cut into chunks of a few bits, lowest first.  Level 0 has the lowest
chunk of every id and a bitmap that says whether it goes on; level 1 has the
next chunk of those that do, and so on.  A rank directory (ones before each
block of bits) turns a position of one level into a position of the next, so
any id can be read from its position without decoding its neighbours.

A stored corpus is a Parquet table of segments, written by Spark and so
complete or absent, in ascending order of ids: ``(part, seq, doc_ids,
doc_tokens, payload)``, ``payload`` being the codes of all ids of a segment.
"""

from __future__ import annotations

import gc
import struct
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from txnfeatures.llm.positions import running
from txnfeatures.llm.words import PLAIN, span_hashes, text_chunks
from txnfeatures.sources.writers import scratch_uri

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bits of each level's chunks, for ids of up to 32 bits.
BITS = (8, 8, 8, 8)
#: Bits of a bitmap for which the rank directory has one entry.
BLOCK = 512
#: Tokens after which a segment is closed; a document is never split.
SEGMENT_TOKENS = 1 << 18
MAGIC = b"DAC1"
END_ID = 0
#: Units of text in each of the two generations that a worker remembers, bytes of text encoded at once.
CACHE = 150_000
ENCODE_BYTES = 2 << 20


def pack(ids: np.ndarray) -> bytes:
    """The file format: MAGIC, number of levels, then for each level its number of ids, chunks, bitmap, directory."""
    values, levels = ids.astype(np.uint32), []
    for depth, bits in enumerate(BITS):
        last = depth == len(BITS) - 1
        rest = values >> np.uint32(bits)
        more = np.zeros(len(values), dtype=bool) if last else rest > 0
        chunk = (values & np.uint32((1 << bits) - 1)).astype(np.uint8)
        blocks = np.add.reduceat(more, np.arange(0, len(more), BLOCK)) if len(more) else np.zeros(0, np.int64)
        before = np.concatenate(([0], np.cumsum(blocks)[:-1])).astype("<u4") if len(more) else np.zeros(0, "<u4")
        bitmap = np.packbits(more, bitorder="little")
        levels.append(struct.pack("<Q", len(values)) + chunk.tobytes() + bitmap.tobytes() + before.tobytes())
        values = rest[more]
        if not len(values):
            break
    return MAGIC + struct.pack("<B", len(levels)) + b"".join(levels)


class Codes:
    """Reader of one payload; ``codes[i]`` touches one chunk, bit and directory entry for each level of that id."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a payload of directly addressable codes")
        at, self.levels = 5, []
        for _ in range(payload[4]):
            (n,) = struct.unpack_from("<Q", payload, at)
            at += 8
            chunk = np.frombuffer(payload, np.uint8, n, at)
            bitmap = np.frombuffer(payload, np.uint8, -(-n // 8), at + n)
            at += n + len(bitmap)
            before = np.frombuffer(payload, "<u4", -(-n // BLOCK), at)
            at += 4 * len(before)
            self.levels.append((chunk, bitmap, before))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = 0
        for (chunk, bitmap, before), bits in zip(self.levels, BITS):
            value |= int(chunk[i]) << shift
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            head = np.unpackbits(bitmap[block * BLOCK // 8 : (i >> 3) + 1], bitorder="little")
            i = int(before[block]) + int(head[: i - block * BLOCK].sum())
            shift += bits
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level from the last."""
        higher = np.zeros(0, np.uint32)
        for (chunk, bitmap, _), bits in reversed(list(zip(self.levels, BITS))):
            out = chunk.astype(np.uint32)
            more = np.unpackbits(bitmap, count=len(chunk), bitorder="little").view(bool)
            if len(higher):
                out[more] |= higher << np.uint32(bits)
            higher = out
        return higher


class Encoder:
    """Ids of whole texts, each distinct unit of text encoded once.

    The vocabulary first splits text by a pattern into pieces and never merges
    across their edges.  Some edges show in the bytes around them: before a
    space and what is not white space, around a single line feed, before a full
    stop or comma after a letter.  Text is cut into units there, on the bytes of
    many texts at once; the library encodes units not met before (a bounded
    memory holds those that were, the ones met lately first), and ids are put together by position.
    A text with unusual white space is one unit, and so is one that holds an added
    token of the vocabulary (such as its end marker) literally: the library takes
    that for the token's id and treats the text around it as texts of their own.
    """

    #: White space of Unicode beyond space, tab, line feed and carriage return; lead bytes that it can have.
    UNUSUAL = "\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
    LEADS = b"\x0b\x0c\x1c\x1d\x1e\x1f\xc2\xe1\xe2\xe3"

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.markers = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @classmethod
    def kept(cls, path: str) -> Encoder:
        """The encoder of this worker process: tasks after one another read the file once and share what was learnt."""
        import os

        import tokenizers

        # This module travels with every task anew; the library's is the same for all of them.
        encoders = tokenizers.__dict__.setdefault("_kept_encoders", {})
        file = os.stat(path)
        key = (path, file.st_mtime_ns, file.st_size)
        if key not in encoders:
            encoders.clear()
            encoders[key] = cls(path)
        return encoders[key]

    def cuts(self, data: np.ndarray, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """First byte of each unit."""
        white, letter, lead = (np.zeros(256, dtype=bool) for _ in range(3))
        white[list(b" \t\n\r")] = True
        letter[list(range(65, 91)) + list(range(97, 123))] = True
        lead[list(self.LEADS)] = True
        at = offsets[:-1][np.diff(offsets) > 0]
        last = offsets[1:][np.diff(offsets) > 0] - 1
        is_white = white[data]
        before, after = np.roll(is_white, 1), np.roll(is_white, -1)
        before[at], after[last] = True, True
        feed = (data == 10) & ~before
        cut = ((data == 32) & ~after) | feed
        cut[1:] |= feed[:-1] & ~is_white[1:]
        cut[1:] |= ((data[1:] == 46) | (data[1:] == 44)) & letter[data[:-1]]
        cut[at] = True
        if lead[data].any():
            for a, b in zip(at, last + 1):
                if lead[data[a:b]].any():
                    text = bytes(data[a:b]).decode()
                    if any(c in text for c in self.UNUSUAL):
                        cut[a + 1 : b] = False
        for marker in self.markers:
            place = raw.find(marker)
            while place >= 0:
                text = np.searchsorted(offsets, place, "right") - 1
                cut[offsets[text] + 1 : offsets[text + 1]] = False
                place = raw.find(marker, max(int(offsets[text + 1]), place + 1))
        return np.flatnonzero(cut)

    def distinct(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One unit of each kind, and the kind of each unit; equal by hash, then confirmed byte by byte."""
        _, index, kind = np.unique(span_hashes(data, starts, ends, PLAIN), return_index=True, return_inverse=True)
        lengths, shift = ends - starts, starts - starts[index][kind]
        if (lengths == lengths[index][kind]).all() and (data[np.arange(len(data)) - np.repeat(shift, lengths)] == data).all():
            return index, kind
        seen: dict[bytes, int] = {}
        kind = np.array([seen.setdefault(bytes(data[a:b]), len(seen)) for a, b in zip(starts, ends)])
        return np.unique(kind, return_index=True)[1], kind

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as bytes and offsets, and the ids' offsets by text."""
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        raw = data.tobytes()
        starts = self.cuts(data, raw, offsets)
        ends = np.append(starts[1:], len(data))
        index, kind = self.distinct(data, starts, ends)
        units = [raw[a:b] for a, b in zip(starts[index].tolist(), ends[index].tolist())]
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known
        missing = [u for u in units if u not in self.known]
        self.known.update((u, self.older[u]) for u in missing if u in self.older)
        fresh = [u for u in missing if u not in self.known]
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        # Hundreds of thousands of small objects without cycles: collecting garbage meanwhile only costs time.
        gc.disable()
        try:
            found = encode([u.decode() for u in fresh], add_special_tokens=False)
            self.known.update((u, array("I", e.ids).tobytes()) for u, e in zip(fresh, found))
        finally:
            gc.enable()
        coded = [self.known[u] for u in units]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        heads = np.cumsum(sizes) - sizes
        counts = sizes[kind]
        ends_at = np.cumsum(counts)
        ids = np.frombuffer(b"".join(coded), "<u4")[np.arange(ends_at[-1]) - np.repeat(ends_at - counts - heads[kind], counts)]
        return ids, np.concatenate(([0], ends_at))[np.searchsorted(starts, offsets)]


def _encoding(path: str, end_id: int, segment_tokens: int):
    def encoding(batches):
        encode = Encoder.kept(path)
        end = np.array([end_id], "<u4")
        docs, lengths, parts, size, seq = [], [], [], 0, 0
        part = TaskContext.get().partitionId()

        def close():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int64())), pa.array([pack(np.concatenate(parts))], pa.binary())],
                names=["part", "seq", "doc_ids", "doc_tokens", "payload"],
            )

        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for first, rows, data, offsets in text_chunks(batch.column(1), ENCODE_BYTES):
                ids, at = encode(data, offsets)
                for i in range(rows):
                    docs.append(ids_of[first + i])
                    parts += (ids[at[i] : at[i + 1]], end)
                    lengths.append(int(at[i + 1] - at[i]) + 1)
                    size += lengths[-1]
                    if size >= segment_tokens:
                        yield close()
                        docs, lengths, parts, size, seq = [], [], [], 0, seq + 1
        if docs:
            yield close()

    return encoding


def write_codes(
    docs: DataFrame,
    tokenizer: str,
    uri: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    segment_tokens: int = SEGMENT_TOKENS,
) -> str:
    """Encode every text with the tokenizer file, append ``end_id`` to each, store segments; returns their place.

    Documents are in ascending id order, null ids first, equal ids in order of
    their text's hash.  A null or empty text is its end id alone.  ``tokenizer``
    must be a byte-level vocabulary at a path that workers have.  Other columns are ignored.
    """
    uri = uri or scratch_uri(docs.sparkSession, "codes")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc", tie).sortWithinPartitions("doc", tie)
    fields = "part bigint, seq bigint, doc_ids array<bigint>, doc_tokens array<bigint>, payload binary"
    ordered.mapInArrow(_encoding(tokenizer, end_id, segment_tokens), fields).write.parquet(uri)
    return uri


def _reading(batches):
    for batch in batches:
        cols = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        for row in range(batch.num_rows):
            ids = Codes(cols["payload"][row].as_py()).all()
            lengths = cols["doc_tokens"][row].values.to_numpy()
            ends = np.cumsum(lengths)
            starts = ends - lengths
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [cols["doc_ids"][row].values, pa.array(starts + cols["before"][row].as_py()),
                 pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc", "start", "n_tokens", "ids_crc32"],
            )


def segments(spark, uri: str) -> DataFrame:
    """The segments with ``tokens`` and ``before``, the number of ids in all earlier segments."""
    rows = spark.read.parquet(uri)
    sizes = rows.select("part", "seq", F.aggregate("doc_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("tokens"))
    parts = running(sizes.groupBy("part").agg(F.sum("tokens").alias("all")), "part", "all", "ahead").select("part", "ahead")
    inside = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    placed = sizes.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(parts, "part")
    placed = placed.select("part", "seq", "tokens", (F.col("inside") + F.col("ahead")).alias("before"))
    return rows.join(placed, ["part", "seq"])


def read_codes(spark, uri: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the stored segments: id, ``start``, ``n_tokens``, ``ids_crc32``."""
    rows = segments(spark, uri).select("doc_ids", "doc_tokens", "payload", "before")
    out = rows.mapInArrow(_reading, "doc bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return out.withColumnRenamed("doc", id_col)
