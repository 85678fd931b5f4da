"""Token ids in binary files that give any token directly.

A segment holds the ids of consecutive documents as directly addressable codes:
each id is cut into 8-bit chunks, level 0 holds the lowest chunk of every id,
a continuation bitmap marks the ids that go on, and level k + 1 holds the next
chunk of those that do, so the place of an id in level k + 1 is the rank of its
bit in level k's bitmap. A rank directory has the count of set bits before every
512th, so a token is read with one byte, one popcount of at most 64 bytes per
further level, and no decoding of its neighbours.

Segment bytes (little-endian), kept in the ``payload`` column of Parquet files:
``b"DAC1"``, u32 number of levels, u64 number of ids, then per level u64 number
of chunks, the chunks, and, except after the last level, the bitmap (bit i of
byte i // 8 for chunk i) and the u32 rank directory.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecopy.llm._pretoken import worker_codec
from tidecopy.llm._store import Stage, shuffle_width, text_bytes
from tidecopy.llm._text import buffer_of, lean, pieces

MAGIC = b"DAC1"
RANK_BITS = 512
SEGMENT_BYTES = 8 << 20     # text that one segment holds (one document at least)
DIRECTORY_ROWS = 100_000    # partitions whose first tokens are broadcast; more are joined by a shuffle
_POP = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def dac_encode(ids: np.ndarray) -> bytes:
    """Directly addressable codes of ids below 2**32."""
    v = ids.astype(np.uint32)
    levels = []
    while True:
        rest = v >> np.uint32(8)
        go = rest > 0
        last = not go.any()
        part = struct.pack("<Q", len(v)) + (v & np.uint32(0xFF)).astype(np.uint8).tobytes()
        if not last:
            bits = np.packbits(go, bitorder="little")
            before = np.concatenate([[0], np.cumsum(_POP[bits], dtype=np.uint32)])[:-1]
            part += bits.tobytes() + before[::RANK_BITS // 8].astype("<u4").tobytes()
        levels.append(part)
        if last:
            return MAGIC + struct.pack("<IQ", len(levels), len(ids)) + b"".join(levels)
        v = rest[go]


class DacReader:
    """Reads ids out of one segment."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a DAC1 segment")
        n_levels, self.n = struct.unpack_from("<IQ", payload, 4)
        at, self.levels = 16, []
        for k in range(n_levels):
            (m,) = struct.unpack_from("<Q", payload, at)
            at += 8
            chunks = np.frombuffer(payload, np.uint8, m, at)
            at += m
            bits = ranks = None
            if k < n_levels - 1:
                size = (m + 7) // 8
                bits = np.frombuffer(payload, np.uint8, size, at)
                at += size
                size = -(-size // (RANK_BITS // 8))
                ranks = np.frombuffer(payload, "<u4", size, at)
                at += 4 * size
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """Token i, from one chunk per level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            out |= int(chunks[i]) << (8 * k)
            if bits is None or not (bits[i >> 3] >> (i & 7)) & 1:
                break
            block = i // RANK_BITS
            first = block * (RANK_BITS // 8)
            i = int(ranks[block]) + int(_POP[bits[first:i >> 3]].sum()) + int(_POP[bits[i >> 3] & ((1 << (i & 7)) - 1)])
        return out

    def all(self) -> np.ndarray:
        out = np.zeros(self.n, dtype=np.uint32)
        at = np.arange(self.n)
        for k, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks.astype(np.uint32) << np.uint32(8 * k)
            if bits is not None:
                at = at[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out


_SEGMENT = "part int, seq int, n_tokens long, doc_ids binary, no_id binary, counts binary, payload binary"


def _segments(spec, end_id: int):
    @lean
    def run(batches):
        codec, part, seq = worker_codec(spec.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids_of = batch.column(0)
            ids = np.asarray(ids_of.fill_null(0)).astype("<i8")
            null = np.asarray(ids_of.is_null())
            data, off = buffer_of(batch.column(1))
            for i, j, text, po in pieces(data, off, SEGMENT_BYTES):
                tokens, counts = codec.encode(text, po)
                ends = np.cumsum(counts)
                tokens = np.insert(tokens, ends, np.uint32(end_id))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(tokens)], pa.int64()),
                     pa.array([ids[i:j].tobytes()]), pa.array([np.packbits(null[i:j]).tobytes()]),
                     pa.array([(counts + 1).astype("<u4").tobytes()]), pa.array([dac_encode(tokens)])],
                    ["part", "seq", "n_tokens", "doc_ids", "no_id", "counts", "payload"])
                seq += 1

    return run


def write_tokens(docs: DataFrame, model: str, stage: Stage, *, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 2) -> DataFrame:
    """Write the segments of all documents in ascending order of id (null first)
    and return them as read back. The text is shuffled once, by ranges of the id
    and the text's hash, so a repeated id can't fill one task."""
    spark = docs.sparkSession
    with open(model, "rb") as f:
        spec = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = (rows.repartitionByRange(shuffle_width(spark), "doc_id", tie).sortWithinPartitions("doc_id", tie))
    return stage.write(ordered.mapInArrow(_segments(spec, end_id), _SEGMENT))


def read_documents(segments: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start (tokens of all documents
    before it), n_tokens, ids_crc32, and where it lies (part, seq, first)."""
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    sizes = segments.select("part", "seq", "n_tokens")
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row per written partition
    parts = totals.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    directory = (sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(parts, "part")
                 .select("part", "seq", (F.col("before") + F.col("inside")).alias("base")))
    small = sizes.count() <= DIRECTORY_ROWS
    placed = segments.join(F.broadcast(directory) if small else directory, ["part", "seq"])
    return placed.select("base", "part", "seq", "doc_ids", "no_id", "counts", "payload").mapInArrow(
        _documents, "doc_id long, start long, n_tokens long, ids_crc32 long, part int, seq int, first long")


@lean
def _documents(batches):
    for batch in batches:
        for row in batch.to_pylist():
            counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
            ids = np.frombuffer(row["doc_ids"], "<i8")
            null = np.unpackbits(np.frombuffer(row["no_id"], np.uint8), count=len(ids)).astype(bool)
            tokens = DacReader(row["payload"]).all().astype("<u4")
            ends = np.cumsum(counts)
            raw = memoryview(tokens.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
            k = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=null), pa.array(row["base"] + ends - counts), pa.array(counts), pa.array(crc, pa.int64()),
                 pa.array(np.full(k, row["part"], np.int32)), pa.array(np.full(k, row["seq"], np.int32)), pa.array(ends - counts)],
                ["doc_id", "start", "n_tokens", "ids_crc32", "part", "seq", "first"])


def token_output(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 2) -> DataFrame:
    """Encode, write, read back: one row per row of ``docs``.

    A null text is empty and yields its end id alone; rows with a null id come
    first, in the order of their texts' hashes, as do rows that share an id;
    equal rows each have their own place; an empty table gives an empty result;
    other columns don't matter.
    """
    stage = Stage(docs.sparkSession, "token_output")
    return read_documents(write_tokens(docs, model, stage, id_col=id_col, text_col=text_col, end_id=end_id))
