"""Which fingerprints occur again anywhere in the corpus?

Fingerprints travel in blocks: a block (the texts of one batch) hands each of
its distinct fingerprints, with a mark if the block itself has it twice, to the
bucket of its top bits, and gets one bit back for each. However often a
fingerprint occurs, a block sends it once, so no bucket grows with a hot group;
buckets are even because fingerprints are hashes.
"""

from __future__ import annotations

import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecopy.llm._text import U64, grouped

BUCKETS_PER_PARTITION = 2


def new_block() -> int:
    """A number for a block; both its rows and its fingerprints come from one write."""
    return secrets.randbits(62)


class Packed:
    """A block's distinct fingerprints (rows of ``keys``: one or two 64-bit words
    each) by bucket; ``slot`` leads from each original position to its place."""

    def __init__(self, keys: np.ndarray, buckets: int):
        self.width = keys.shape[1]
        order, head = grouped(keys[:, 0], keys)
        group = np.cumsum(head) - 1
        self.slot = np.empty(len(keys), dtype=np.int64)
        self.slot[order] = group
        self.keys, n = keys.take(order[head], axis=0), np.bincount(group, minlength=int(head.sum()))
        self.twice = n > 1
        # in the order of the first word's upper bits, so a bucket is a run
        self.cut = np.searchsorted(self.keys[:, 0] >> U64(40), (np.arange(buckets + 1, dtype=U64) << U64(24)) // U64(buckets))

    def rows(self) -> list[bytes]:
        return [self.keys[a:b].tobytes() + self.twice[a:b].tobytes() for a, b in zip(self.cut[:-1], self.cut[1:])]


def _again(width: int):
    size = 8 * width + 1

    def run(key, table):
        raw = table["x"].to_pylist()
        n = [len(x) // size for x in raw]
        keys = np.concatenate([np.frombuffer(x, "<u8", k * width).reshape(-1, width) for x, k in zip(raw, n)])
        hit = np.concatenate([np.frombuffer(x, bool, k, k * width * 8) for x, k in zip(raw, n)]).copy()
        order, head = grouped(keys[:, 0], keys)
        group = np.cumsum(head) - 1
        often = np.bincount(group) > 1
        hit[order] |= often[group]
        bits = [np.packbits(x).tobytes() for x in np.split(hit, np.cumsum(n)[:-1])]
        return pa.table({"blk": table["blk"], "bucket": table["bucket"], "bits": pa.array(bits, pa.binary())})

    return run


def repeated(sent: DataFrame, width: int = 1) -> DataFrame:
    """``sent``: blk, bucket, x (binary, of ``Packed.rows``; the empty ones left out).
    Result: blk, hits (array of (bucket, bits)): a bit per fingerprint, set if it
    occurs twice or more in the corpus.

    A fingerprint seen once by its block but by others too is hit through them;
    one the block has twice is hit for every block that has it."""
    bits = sent.groupBy("bucket").applyInArrow(_again(width), "blk long, bucket int, bits binary")
    return bits.groupBy("blk").agg(F.collect_list(F.struct("bucket", "bits")).alias("hits"))


def stored(blocks: DataFrame) -> DataFrame:
    """The rows to send of blocks that keep them (``xs``, one per bucket)."""
    return blocks.select("blk", F.posexplode("xs").alias("bucket", "x")).where(F.length("x") > 0)


def sent_batch(blk: int, packed: Packed) -> pa.RecordBatch:
    """The rows to send of a block whose fingerprints are made anew each time."""
    rows = packed.rows()
    some = [i for i, x in enumerate(rows) if x]
    return pa.RecordBatch.from_arrays(
        [pa.array([blk] * len(some), pa.int64()), pa.array(some, pa.int32()), pa.array([rows[i] for i in some], pa.binary())],
        ["blk", "bucket", "x"])


def hits_of(packed: Packed, hits: list[dict] | None) -> np.ndarray:
    """For each original position: does its fingerprint occur again?"""
    mask = np.zeros(len(packed.keys), dtype=bool)
    for h in hits or []:
        a, b = packed.cut[h["bucket"]], packed.cut[h["bucket"] + 1]
        mask[a:b] = np.unpackbits(np.frombuffer(h["bits"], np.uint8), count=b - a).astype(bool)
    return mask[packed.slot]
