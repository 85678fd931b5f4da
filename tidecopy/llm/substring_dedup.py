"""Repeated word windows by level-wise doubling.

A window of ``length`` words can only repeat if the shorter windows in it do. The
levels are length / 4, length / 2 and length words (9, 18, 35 for 35): at each
one, of the windows still alive, the shorter window with the least hash inside
each is looked up across the corpus, and windows whose choice is unique die.
The survivors are extended to twice that length; the last level looks up every
surviving window itself, by 128 bits, so what is left is exact. A level moves
fingerprints in blocks (``_exchange``), the first one about 7 % of the words'
and the later ones those of the surviving regions alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecopy.llm._exchange import BUCKETS_PER_PARTITION, Packed, hits_of, new_block, repeated, sent_batch, stored
from tidecopy.llm._store import Stage, row_key, shuffle_width, text_bytes
from tidecopy.llm._text import (
    MAX64, anchors, buffer_of, covered, fits, pieces, runs, sliding, window_hashes, word_hashes, words,
)

PIECE = 6 << 20     # text of one block
_INNER = 1 << 18    # text hashed at a time

# A block of texts: keys of the rows, words of each, positions and hashes looked up.
_TEXTS = "blk long, xs array<binary>, k1 binary, k2 binary, size binary, at binary, h binary"
# A block of regions: keys of the rows they come from, first word, number and hashes
# of words; what a level looks up follows from the hashes.
_REGIONS = "blk long, k1 binary, k2 binary, first binary, size binary, codes binary"


def levels_of(length: int) -> list[int]:
    """Doubling lengths up to ``length``: the first has at most 9 words."""
    out = [length]
    while out[0] > 9:
        out.insert(0, -(-out[0] // 2))
    return out


def _row(schema: str, blk: int, *values) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    cols = [pa.array([v], pa.list_(pa.binary())) if isinstance(v, list) else pa.array([np.ascontiguousarray(v).tobytes()], pa.binary())
            for v in values]
    return pa.RecordBatch.from_arrays([pa.array([blk]), *cols], names)


def _regions_row(k1, k2, first, size, codes) -> pa.RecordBatch:
    return _row(_REGIONS, new_block(), np.asarray(k1, "<i8"), np.asarray(k2, "<i8"), np.asarray(first, "<i4"),
                np.asarray(size, "<i4"), codes)


def _lookups(codes: np.ndarray, off: np.ndarray, level: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions to look up and their keys: the least-hash window of ``level`` words in
    each window of ``length`` words, or each window itself at the last level."""
    ok = fits(off, length)
    h = window_hashes(codes, level)
    if level == length:
        at = np.flatnonzero(ok)
        return at, np.stack([h[at], window_hashes(codes, level, 1)[at]], axis=1)
    at = anchors(h, ok, length - level + 1)
    return at, h[at][:, None]


def _first_blocks(levels: list[int], buckets: int):
    level, length = levels[0], levels[-1]

    def run(batches):
        for batch in batches:
            k1, k2 = (np.asarray(batch.column(i)) for i in (0, 1))
            data, off = buffer_of(batch.column(2))
            for i, j, text, po in pieces(data, off, PIECE):
                ats, hs, sizes, base = [], [], [], 0
                for _, _, part, qo in pieces(text, po, _INNER):
                    s, e, by = words(part, qo)
                    at, h = _lookups(word_hashes(part, s, e), by, level, length)
                    ats.append(at + base)
                    hs.append(h)
                    sizes.append(np.diff(by))
                    base += len(s)
                h = np.concatenate(hs)
                yield _row(_TEXTS, new_block(), Packed(h, buckets).rows(), k1[i:j].astype("<i8"), k2[i:j].astype("<i8"),
                           np.concatenate(sizes).astype("<i4"), np.concatenate(ats).astype("<i4"), h)

    return run


def _alive(row: dict, level: int, length: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of a block's words start a window that survives the level; the regions' offsets."""
    size = np.frombuffer(row["size"], "<i4").astype(np.int64)
    off = np.concatenate([[0], np.cumsum(size)])
    if "codes" in row:
        at, h = _lookups(np.frombuffer(row["codes"], "<u8"), off, level, length)
    else:
        at = np.frombuffer(row["at"], "<i4").astype(np.int64)
        h = np.frombuffer(row["h"], "<u8").reshape(-1, 2 if level == length else 1)
    hit = hits_of(Packed(h, buckets), row["hits"])
    n = int(off[-1])
    if level == length:
        alive = np.zeros(n, dtype=bool)
        alive[at[hit]] = True
        return alive, off
    all_, good = np.full(n, MAX64), np.full(n, MAX64)
    all_[at] = h[:, 0]
    good[at[hit]] = h[hit, 0]
    w = length - level + 1
    return fits(off, length) & (sliding(good, w) == sliding(all_, w)) & (sliding(good, w) < MAX64), off


def _regions(row: dict, alive: np.ndarray, off: np.ndarray, length: int):
    """Survivors as word spans: region of origin, first word in the block, words spanned."""
    s, e = runs(alive, off)
    region = np.searchsorted(off, s, side="right") - 1
    return region, s, e - s + length - 1


def _survivors(level: int, length: int, buckets: int):
    """Of the first level: spans per row, (k1, k2, first, size as arrays)."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                alive, off = _alive(row, level, length, buckets)
                region, s, n = _regions(row, alive, off, length)
                if not len(s):
                    continue
                first = s - off[region]
                if "first" in row:
                    first = first + np.frombuffer(row["first"], "<i4")[region]
                yield _spans(row, region, first, n)

    return run


def _spans(row: dict, region: np.ndarray, first: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """One result row per region of origin that has spans."""
    head = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
    off = np.append(head, len(region)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(off), pa.array(x.astype(np.int32))) for x in (first, n)]
    k1, k2 = (np.frombuffer(row[k], "<i8")[region[head]] for k in ("k1", "k2"))
    return pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), *lists], ["k1", "k2", "first", "size"])


def _region_blocks(batches):
    """Blocks of regions, from texts and their surviving spans."""
    for batch in batches:
        data, off = buffer_of(batch.column(2))
        k1, k2 = (np.asarray(batch.column(i)) for i in (0, 1))
        firsts, sizes = batch.column(3), batch.column(4)
        for i, _, text, po in pieces(data, off, PIECE):
            region, first, size, codes = [], [], [], []
            d = i
            for a, b, part, qo in pieces(text, po, _INNER):
                s, e, by = words(part, qo)
                w = word_hashes(part, s, e)
                for x in range(b - a):
                    f = firsts[d].values.to_numpy(zero_copy_only=False)
                    n = sizes[d].values.to_numpy(zero_copy_only=False)
                    region.append(np.full(len(f), d))
                    first.append(f)
                    size.append(n)
                    codes += [w[by[x] + p:by[x] + p + m] for p, m in zip(f.tolist(), n.tolist())]
                    d += 1
            region, first, size = (np.concatenate(v) for v in (region, first, size))
            yield _regions_row(k1[region], k2[region], first, size, np.concatenate(codes))


def _send(level: int, length: int, buckets: int):
    """What blocks of regions look up at a level."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                off = np.concatenate([[0], np.cumsum(np.frombuffer(row["size"], "<i4"), dtype=np.int64)])
                _, h = _lookups(np.frombuffer(row["codes"], "<u8"), off, level, length)
                yield sent_batch(row["blk"], Packed(h, buckets))

    return run

    return run


def _next_blocks(before: int, length: int, buckets: int):
    """Blocks of the next level, from those of the level before and their hits."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                alive, off = _alive(row, before, length, buckets)
                region, s, n = _regions(row, alive, off, length)
                if not len(s):
                    continue
                codes = np.frombuffer(row["codes"], "<u8")
                codes = np.concatenate([codes[a:a + m] for a, m in zip(s.tolist(), n.tolist())])
                k1, k2 = (np.frombuffer(row[k], "<i8")[region] for k in ("k1", "k2"))
                first = np.frombuffer(row["first"], "<i4")[region] + s - off[region]
                yield _regions_row(k1, k2, first, n, codes)

    return run


def repeated_spans(docs: DataFrame, length: int, stage: Stage, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k1, k2 (``row_key``), first, size (arrays): the maximal word spans that windows
    occurring twice or more cover, for the rows that have any. Equal rows share a key and their spans."""
    spark = docs.sparkSession
    buckets = BUCKETS_PER_PARTITION * shuffle_width(spark)
    levels = levels_of(length)
    rows = docs.select(*row_key(id_col, text_col), text_bytes(text_col).alias("text"))
    blocks = stage.write(rows.mapInArrow(_first_blocks(levels, buckets), _TEXTS))

    def met(blocks: DataFrame, level: int) -> DataFrame:
        width = 2 if level == length else 1
        if "xs" in blocks.columns:
            return blocks.drop("xs").join(repeated(stored(blocks), width), "blk")
        sent = blocks.select("blk", "size", "codes").mapInArrow(_send(level, length, buckets), "blk long, bucket int, x binary")
        return blocks.join(repeated(sent, width), "blk")

    span_rows = "k1 long, k2 long, first array<int>, size array<int>"
    for k, level in enumerate(levels):
        last = level == length
        if last or k == 0:
            spans = stage.write(met(blocks, level).mapInArrow(_survivors(level, length, buckets), span_rows)
                                .groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "size")).alias("s"))
                                .select("k1", "k2", F.array_distinct(F.flatten(F.transform(
                                    "s", lambda x: F.arrays_zip(x["first"], x["size"])))).alias("z"))
                                .select("k1", "k2", F.col("z.first").alias("first"), F.col("z.size").alias("size")))
            stage.drop(blocks)
            stage.release()
            if last:
                return spans
            texts = rows.join(spans.hint("shuffle_hash"), ["k1", "k2"])
            blocks = stage.write(texts.select("k1", "k2", "text", "first", "size").mapInArrow(_region_blocks, _REGIONS))
            stage.drop(spans)
            stage.release()
        else:
            after = stage.write(met(blocks, level).mapInArrow(_next_blocks(level, length, buckets), _REGIONS))
            stage.drop(blocks)
            stage.release()
            blocks = after
    raise AssertionError("the last level returns")


def _kept(batches):
    for batch in batches:
        firsts, sizes = batch.column(2), batch.column(3)
        n_words, removed, digest = [], [], []
        for t, f, n in zip(batch.column(1).to_pylist(), firsts.to_pylist(), sizes.to_pylist()):
            w = (t or b"").split()    # on 0x20 and 0x09 to 0x0D
            n_words.append(len(w))
            if f:
                gone = np.zeros(len(w) + 1, dtype=np.int32)
                np.add.at(gone, f, 1)
                np.add.at(gone, np.add(f, n), -1)
                gone = np.cumsum(gone[:-1]) > 0
                w = [x for x, g in zip(w, gone.tolist()) if not g]
            removed.append(n_words[-1] - len(w))
            digest.append(hashlib.sha256(b" ".join(w)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(digest, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def substring_dedup(docs: DataFrame, length: int = 35, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (of the kept
    words joined by one space).

    A null or empty text has no words; texts shorter than a window keep all of
    them; equal rows repeat each other and lose every word they cover; a null id
    stays null; an empty table gives an empty result; other columns don't matter.
    """
    stage = Stage(docs.sparkSession, "substring")
    spans = repeated_spans(docs, length, stage, id_col=id_col, text_col=text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_key(id_col, text_col), text_bytes(text_col).alias("text"))
    met = rows.join(spans.hint("shuffle_hash"), ["k1", "k2"], "left")
    return met.select("doc_id", "text", "first", "size").mapInArrow(
        _kept, "doc_id long, n_words long, n_removed long, kept_sha256 string")
