"""Repeated byte strings by a distributed difference-cover sort.

Only text that can hold a repeat is sorted: of the 20-byte strings in each
``length``-byte window the one with the least hash is looked up across the corpus
(``_exchange``), and windows whose choice is unique are out. What is left, as
regions, goes through the difference-cover steps for the cover {1, 2} modulo 3,
positions counted within a region:

1. At sampled positions (1 or 2 modulo 3), strings of ``CHAR`` bytes are sorted
   across the corpus and named; equal strings get equal names.
2. Triples of names, at i, i + CHAR - 1 and i + 2 (CHAR - 1) (the same residue), are sorted and
   named again. These names stand for ``SPAN`` = 3 CHAR - 2 bytes, and as prefixes of
   ``length`` bytes are all that is compared, the recursion ends here.
3. Any two positions have a shift d of 0, 1 or 2 after which both are sampled.
   For each d the positions that are sampled after d get the key: d bytes,
   the name there, and the bytes up to ``length``. Sorting each of the three
   merges the other positions in. Neighbours with equal keys have equal
   prefixes; the least document id among them is what counts. A position takes
   part in two of the three sorts and between them meets every equal position.

The sorts move distinct keys of blocks to buckets of a hash, so a string that
stands everywhere is sent once a block. Regions that share their least
repeated string are put in the same blocks before; large such families are
dealt to several tasks. Of equal ``length``-byte strings in a block, found by a hash and
compared byte for byte, those of the least document go on and stand for the
others, which are removed. A key that one block alone has gets no name, and
what needs the name is discarded: no other block has a string that holds it at
a sampled position. The pair of equal positions in two blocks still meets, as
both have all names after the shift that makes both sampled. The three sorts
of step 3 are one exchange with buckets of their own. A block's names are kept
once per distinct key and looked up anew by each step, so a step moves the
regions' bytes and names, and no step keeps a number per position. Names and ids
are written with 4 bytes where their measured range allows it, else with 8.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecopy.llm._exchange import BUCKETS_PER_PARTITION, Packed, hits_of, new_block, repeated, sent_batch
from tidecopy.llm._store import Stage, row_key, shuffle_width, small, text_bytes
from tidecopy.llm._text import (
    _BYTE, MAX64, U64, anchors, buffer_of, covered, expand, fits, grouped, mix, pieces, runs, sliding, window_hashes,
)

SEED = 20             # bytes of the strings that are looked up first
CHAR = 16             # bytes of the first names
SPAN = 3 * CHAR - 2   # bytes of the second names
BLOCK = 2 << 20       # region bytes of one block
BUCKET = 1 << 20      # region bytes to one bucket at least
FAMILY = 512          # regions of a family that go to one task
_PIECE, _INNER = 8 << 20, 1 << 18

_SEEDS = "blk long, k1 binary, k2 binary, size binary, at binary, h binary"


def _seed_blocks(length: int):
    def run(batches):
        for batch in batches:
            k1, k2 = (np.asarray(batch.column(i)) for i in (0, 1))
            data, off = buffer_of(batch.column(2))
            for i, j, text, po in pieces(data, off, _PIECE):
                ats, hs = [], []
                for a, _, part, qo in pieces(text, po, _INNER):
                    h = window_hashes(_BYTE[part], SEED)
                    at = anchors(h, fits(qo, length), length - SEED + 1)
                    ats.append(at + po[a])
                    hs.append(h[at])
                at, h = np.concatenate(ats), np.concatenate(hs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([new_block()]),
                     *(pa.array([x.tobytes()], pa.binary()) for x in (
                         k1[i:j].astype("<i8"), k2[i:j].astype("<i8"), np.diff(po).astype("<i8"), at.astype("<i4"), h))],
                    ["blk", "k1", "k2", "size", "at", "h"])

    return run


def _send_seeds(buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield sent_batch(row["blk"], Packed(np.frombuffer(row["h"], "<u8")[:, None], buckets))

    return run


def _seed_spans(length: int, buckets: int):
    """Regions of the rows that have any: first byte, bytes, least repeated seed."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                size = np.frombuffer(row["size"], "<i8")
                off = np.concatenate([[0], np.cumsum(size)])
                at, h = np.frombuffer(row["at"], "<i4").astype(np.int64), np.frombuffer(row["h"], "<u8")
                hit = hits_of(Packed(h[:, None], buckets), row["hits"])
                every, good = np.full(off[-1], MAX64), np.full(off[-1], MAX64)
                every[at] = h
                good[at[hit]] = h[hit]
                w = length - SEED + 1
                least, alive = np.empty(off[-1], dtype=U64), np.empty(off[-1], dtype=bool)
                for i, j, part, po in pieces(good, off, _INNER):
                    text = slice(off[i], off[j])
                    least[text] = sliding(part, w)
                    alive[text] = fits(po, length) & (least[text] == sliding(every[text], w)) & (least[text] < MAX64)
                s, e = runs(alive, off)
                if not len(s):
                    continue
                doc = np.searchsorted(off, s, side="right") - 1
                family = np.minimum.reduceat(np.append(least, MAX64), np.stack([s, e], axis=1).reshape(-1))[::2]
                head = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                cut = pa.array(np.append(head, len(doc)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cut, pa.array(x)) for x in (
                    (s - off[doc]).astype(np.int32), (e - s + length - 1).astype(np.int32), family.view(np.int64))]
                k1, k2 = (pa.array(np.frombuffer(row[k], "<i8")[doc[head]]) for k in ("k1", "k2"))
                yield pa.RecordBatch.from_arrays([k1, k2, *lists], ["k1", "k2", "first", "size", "family"])

    return run


def _cut_regions(batches):
    """Texts and their regions, as a row per region."""
    for batch in batches:
        data, off = buffer_of(batch.column(3))
        out = {k: [] for k in ("k1", "k2", "doc", "first", "family", "bytes")}
        lists = [batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5, 6)]
        for d, (k1, k2, doc, firsts, sizes, families) in enumerate(zip(*lists)):
            for f, n, fam in zip(firsts, sizes, families):
                a = off[d] + f
                for k, v in zip(out, (k1, k2, doc, f, fam, data[a:a + n].tobytes())):
                    out[k].append(v)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))


_REGIONS = ("blk long, k1 binary, k2 binary, doc binary, first binary, size binary, data binary, "
            "gone_k1 binary, gone_k2 binary, gone_first binary, gone_size binary")


def words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as one number (zeros after the end)."""
    out = np.append(data, np.zeros(7, np.uint8)).astype(U64)
    for k in (1, 2, 4):
        out = (out[:-k] << U64(8 * k)) | out[k:]
    return out


def _same_strings(data: np.ndarray, one: np.ndarray, two: np.ndarray, length: int) -> np.ndarray:
    """For each pair of places, the first ones ascending: is the string of ``length`` bytes the same?

    In a run of places, each one byte after the one before on both sides, the strings overlap:
    the first 8 bytes of each and all of the last's are all bytes of the run's strings."""
    word = words_at(data)
    steps = [*range(0, length - 8, 8), length - 8]
    same = word[one] == word[two]
    last = np.ones(len(one), dtype=bool)
    last[:-1] = (one[1:] != one[:-1] + 1) | (two[1:] != two[:-1] + 1)
    last = np.flatnonzero(last)
    if same.all() and all((word[one[last] + k] == word[two[last] + k]).all() for k in steps):
        return same
    for k in steps:
        same &= word[one + k] == word[two + k]
    return same


def least_docs(data: np.ndarray, off: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of whole ``length``-byte strings, and whether their region's document is the least
    of those that hold the same string here."""
    at = np.flatnonzero(fits(off, length))
    if not len(at):
        return at, np.zeros(0, bool)
    h = window_hashes(_BYTE[data], length)[at]
    order, head = grouped(h, h[:, None])
    several = ~head                 # of the groups of two or more: the others' strings stand once
    several[:-1] |= several[1:]
    order, head = order[several], head[several]
    # every place against the first of its group, in the order of the text
    first = np.arange(len(at))
    first[order] = order[head][np.cumsum(head) - 1]
    again = np.flatnonzero(first != np.arange(len(at)))
    for x in np.unique(h[again[~_same_strings(data, at[again], at[first[again]], length)]]):      # rare: different strings of one hash
        a, b = (np.searchsorted(h[order], x, side) for side in ("left", "right"))
        text = {int(i): data[at[i]:at[i] + length].tobytes() for i in order[a:b]}
        order[a:b] = sorted(text, key=text.get)
        head[a + 1:b] = [text[int(i)] != text[int(j)] for i, j in zip(order[a:b - 1], order[a + 1:b])]
    least = np.ones(len(at), dtype=bool)
    if len(order):
        own = doc[np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))[at[order]]]
        least[order] = own == np.minimum.reduceat(own, np.flatnonzero(head))[np.cumsum(head) - 1]
    return at, least


def _least_regions(regions: list[np.ndarray], length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Regions (k1, k2, doc, first, size, data) without the strings that a smaller document among
    them holds too; and the byte spans (k1, k2, first, size) of those strings."""
    k1, k2, doc, first, size, data = regions
    off = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    at, least = least_docs(data, off, doc, length)
    mask = np.zeros(len(data), dtype=bool)
    mask[at[~least]] = True
    s, e = runs(covered(mask, length), off)
    reg = np.searchsorted(off, s, side="right") - 1
    gone = [k1[reg], k2[reg], (first[reg] + s - off[reg]).astype("<i4"), (e - s).astype("<i4")]
    mask[:] = False
    mask[at[least]] = True
    s, e = runs(mask, off)
    reg, n = np.searchsorted(off, s, side="right") - 1, e - s + length - 1
    return [k1[reg], k2[reg], doc[reg], (first[reg] + s - off[reg]).astype("<i4"), n.astype("<i4"), data[expand(s, n)]], gone


def _region_blocks(length: int):
    """Blocks of regions. doc: the id in an order of unsigned numbers, null last. Of equal strings in a
    block those of its least document stay, and stand for the others, which are removed."""
    def run(batches):
        held, spans = None, []

        def block():
            return pa.RecordBatch.from_arrays(
                [pa.array([new_block()]), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
                                            for x in (*held, *map(np.concatenate, zip(*spans))))],
                [c.split()[0] for c in _REGIONS.split(", ")])

        for batch in batches:
            data, off = buffer_of(batch.column(5))
            null = np.asarray(batch.column(2).is_null())
            doc = np.asarray(batch.column(2).fill_null(0)).astype(np.int64).view(U64) ^ U64(1 << 63)
            doc[null] = MAX64
            cols = [np.asarray(batch.column(0)), np.asarray(batch.column(1)), doc, np.asarray(batch.column(3)).astype("<i4")]
            for i, j, part, po in pieces(data, off, BLOCK // 2):
                new = [*(c[i:j] for c in cols), np.diff(po).astype("<i4"), part]
                held = [np.concatenate(x) for x in zip(held, new)] if held else [x.copy() for x in new]
                if len(held[-1]) >= BLOCK:
                    held, gone = _least_regions(held, length)
                    spans.append(gone)
                    if 2 * len(held[-1]) >= BLOCK:
                        yield block()
                        held, spans = None, []
        if held:
            held, gone = _least_regions(held, length)
            spans.append(gone)
            yield block()

    return run


def _gone_spans(batches):
    """The removed spans that blocks hold."""
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(row[f"gone_{c}"], t)) for c, t in (("k1", "<i8"), ("k2", "<i8"), ("first", "<i4"), ("size", "<i4"))],
                ["k1", "k2", "first", "size"])


@dataclass(frozen=True)
class Plan:
    """What the steps share: length of the strings, buckets, how names and ids are written."""

    length: int
    buckets: int
    name: str       # "<u4" or "<u8"
    low: str        # the same for ids, which are sent as their distance from ``least``
    least: int

    def columns(self, step: str) -> list[str]:
        if step == "char":
            return ["<u8", "<u8"]
        if step == "triple":
            return [self.name] * 3
        return [self.name, "<u4" if self.length - SPAN <= 4 else "<u8", self.low]

    def size(self, step: str) -> int:
        return sum(np.dtype(c).itemsize for c in self.columns(step))


def _every_third(mask: np.ndarray, count: int) -> np.ndarray:
    """Is ``mask`` set at a place and at every third one after it, ``count`` places in all?"""
    out, have = mask.copy(), 1
    while have < count:
        more = min(have, count - have)
        out[:-3 * more] &= out[3 * more:]
        out[-3 * more:] = False
        have += more
    return out


class Block:
    """A block's regions; every ``length``-byte string of a region is one to be looked up."""

    def __init__(self, row: dict, plan: Plan):
        self.row, self.plan = row, plan
        self.data = np.frombuffer(row["data"], np.uint8)
        size = np.frombuffer(row["size"], "<i4").astype(np.int64)
        self.off = np.concatenate([[0], np.cumsum(size)])
        self.region = np.repeat(np.arange(len(size), dtype=np.int32), size)
        at = np.arange(len(self.data), dtype=np.int32)
        self.residue = ((at - self.off.astype(np.int32)[:-1][self.region]) % 3).astype(np.int8)
        self.left = self.off.astype(np.int32)[1:][self.region] - at
        self.word = words_at(self.data)
        doc = np.frombuffer(row["doc"], "<u8")
        # a null id is the largest distance
        self.doc = np.where(doc == MAX64, U64(np.iinfo(plan.low).max), doc - U64(plan.least))

    def bytes_at(self, at: np.ndarray, n: int) -> np.ndarray:
        """The n <= 8 bytes from each position on."""
        return self.word[at] >> U64(64 - 8 * n) if n else np.zeros(len(at), dtype=U64)

    def names(self, step: str) -> np.ndarray:
        """Every position's name of a step (0: no other block has its key, or no key)."""
        (_, at, keys), = self.keys(step)
        k = Keyed(keys, self.plan.buckets)
        names = np.zeros(k.cut[-1], dtype=U64)
        for a in self.row[f"a_{step}"] or []:
            names[k.cut[a["bucket"]]:k.cut[a["bucket"] + 1]] = np.frombuffer(a["y"], self.plan.name)
        full = np.zeros(len(self.data), dtype=U64)
        full[at] = names[k.slot]
        return full

    def keys(self, step: str) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(shift, positions, their keys (rows of 64-bit words)) of a step."""
        if step == "char":
            at = np.flatnonzero((self.residue != 0) & (self.left >= CHAR))
            return [(0, at, np.stack([self.word[at], self.word[at + 8]], axis=1))]
        if step == "triple":
            name = self.names("char")
            # an equal triple elsewhere has all names of this residue in its span
            at = np.flatnonzero((self.residue != 0) & (self.left >= SPAN) & _every_third(name != 0, (SPAN - CHAR) // 3 + 1))
            return [(0, at, np.stack([name[at + k * (CHAR - 1)] for k in range(3)], axis=1))]
        name = self.names("triple")
        i = np.flatnonzero(self.left >= self.plan.length)
        out = []
        for d in range(3):
            at = i[name[i + d] != 0]
            rest = self.plan.length - d - SPAN
            out.append((d, at, np.stack([name[at + d], (self.bytes_at(at, d) << U64(8 * rest)) | self.bytes_at(at + d + SPAN, rest)], axis=1)))
        return out


class Keyed:
    """Distinct keys in the order of a hash, cut into buckets."""

    def __init__(self, keys: np.ndarray, buckets: int):
        h = _hash(keys)
        self.order, self.head = grouped(h, keys)
        self.all = keys
        self.cut = np.searchsorted(h[self.order[self.head]] >> U64(40), (np.arange(buckets + 1, dtype=U64) << U64(24)) // U64(buckets))

    @property
    def keys(self) -> np.ndarray:
        return self.all.take(self.order[self.head], axis=0)

    @property
    def slot(self) -> np.ndarray:
        """The place of each position's key among the distinct ones."""
        out = np.empty(len(self.order), dtype=np.int32)
        out[self.order] = np.cumsum(self.head, dtype=np.int32) - np.int32(1)
        return out

    def least(self, values: np.ndarray) -> np.ndarray:
        """The least of the positions' values, for each distinct key."""
        return np.minimum.reduceat(values[self.order], np.flatnonzero(self.head)) if len(values) else values


def _hash(keys: np.ndarray) -> np.ndarray:
    h = np.zeros(len(keys), dtype=U64)
    for k in range(keys.shape[1]):
        h = mix(h ^ keys[:, k]) + U64(0x9E3779B97F4A7C15)
    return h


def _send(step: str, plan: Plan):
    columns = plan.columns(step)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row, plan)
                for d, at, keys in b.keys(step):
                    k = Keyed(keys, plan.buckets)
                    values = [*k.keys.T]
                    if step == "merge":
                        values.append(k.least(b.doc[b.region[at]]))
                    some = np.flatnonzero(np.diff(k.cut))
                    x = [b"".join(v[k.cut[i]:k.cut[i + 1]].astype(c).tobytes() for v, c in zip(values, columns)) for i in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), row["blk"], np.int64)), pa.array(some + d * plan.buckets, pa.int32()), pa.array(x, pa.binary())],
                        ["blk", "bucket", "x"])

    return run


def _answer(step: str, plan: Plan):
    """Names of a bucket's keys (0 for those of one block only), or a bit per key: has another
    block a smaller document for it?"""
    columns, size = plan.columns(step), plan.size(step)

    def run(key, table):
        raw = table["x"].to_pylist()
        n = [len(x) // size for x in raw]
        values = []
        for j, c in enumerate(columns):
            skip = sum(np.dtype(x).itemsize for x in columns[:j])
            values.append(np.concatenate([np.frombuffer(x, c, m, skip * m) for x, m in zip(raw, n)]).astype(U64))
        keys = np.stack(values[:2] if step == "merge" else values, axis=1)
        order, head = grouped(_hash(keys), keys)
        group = np.cumsum(head) - 1
        if step == "merge":
            least = np.minimum.reduceat(values[2][order], np.flatnonzero(head))
            out = np.empty(len(keys), dtype=bool)
            out[order] = least[group] < values[2][order]
            parts = [np.packbits(x).tobytes() for x in np.split(out, np.cumsum(n)[:-1])]
        else:
            several = np.bincount(group) > 1      # a block sends a key once
            name = np.where(several, (np.cumsum(several) - 1) * plan.buckets + key[0].as_py() + 1, 0)
            if int(name.max()) > np.iinfo(plan.name).max:
                raise OverflowError("more names than their width allows")
            out = np.empty(len(keys), dtype=plan.name)
            out[order] = name[group]
            parts = [x.tobytes() for x in np.split(out, np.cumsum(n)[:-1])]
        return pa.table({"blk": table["blk"], "bucket": table["bucket"], "y": pa.array(parts, pa.binary())})

    return run


def _removed(plan: Plan):
    """Removed byte spans per row, from the answers of the three sorts."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if not row["a_merge"]:
                    continue
                b = Block(row, plan)
                gone = np.zeros(len(b.data), dtype=bool)
                for d, at, keys in b.keys("merge"):
                    k = Keyed(keys, plan.buckets)
                    smaller = np.zeros(k.cut[-1], dtype=bool)
                    for a in row["a_merge"]:
                        i = a["bucket"] - d * plan.buckets
                        if 0 <= i < plan.buckets:
                            smaller[k.cut[i]:k.cut[i + 1]] = np.unpackbits(np.frombuffer(a["y"], np.uint8), count=k.cut[i + 1] - k.cut[i])
                    gone[at] |= smaller[k.slot]
                s, e = runs(covered(gone, plan.length), b.off)
                if not len(s):
                    continue
                reg = b.region[s]
                k1, k2, first = (np.frombuffer(row[c], t)[reg] for c, t in (("k1", "<i8"), ("k2", "<i8"), ("first", "<i4")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1), pa.array(k2), pa.array((first + s - b.off[reg]).astype(np.int32)), pa.array((e - s).astype(np.int32))],
                    ["k1", "k2", "first", "size"])

    return run


def _plan(rows: DataFrame, spans: DataFrame, length: int, buckets: int) -> Plan:
    total = spans.agg(F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = min(buckets, total // BUCKET + 1)
    lo, hi = rows.agg(F.min("doc"), F.max("doc")).first()
    lo, hi = (lo or 0), (hi or 0)
    # half of the range is left for unevenness of the buckets, and the top for null ids
    return Plan(length, buckets, "<u4" if 2 * total + 2 * buckets < 2**32 else "<u8",
                "<u4" if hi - lo < 2**32 - 1 else "<u8", lo + 2**63 if hi - lo < 2**32 - 1 else 0)


def removed_spans(docs: DataFrame, length: int, stage: Stage, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k1, k2 (``row_key``), first, size (arrays): byte spans covered by strings of ``length``
    bytes that also start in a document with a smaller id."""
    spark = docs.sparkSession
    buckets = BUCKETS_PER_PARTITION * shuffle_width(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), *row_key(id_col, text_col), text_bytes(text_col).alias("text"))
    seeds = stage.write(rows.select("k1", "k2", "text").mapInArrow(_seed_blocks(length), _SEEDS))
    sent = seeds.select("blk", "h").mapInArrow(_send_seeds(buckets), "blk long, bucket int, x binary")
    spans = stage.write(seeds.join(repeated(sent), "blk").mapInArrow(
        _seed_spans(length, buckets), "k1 long, k2 long, first array<int>, size array<int>, family array<long>")
        .dropDuplicates(["k1", "k2"]))
    del sent
    stage.drop(seeds)
    stage.release()
    plan = _plan(rows, spans, length, buckets)
    cut = (rows.join(spans.hint("shuffle_hash"), ["k1", "k2"]).select("k1", "k2", "doc", "text", "first", "size", "family")
           .mapInArrow(_cut_regions, "k1 long, k2 long, doc long, first int, family long, bytes binary"))
    large = stage.write(spans.select(F.explode("family").alias("family")).groupBy("family").agg(F.count(F.lit(1)).alias("n"))
                        .where(F.col("n") > FAMILY))
    part = F.pmod("k1", F.ceil(F.coalesce("n", F.lit(1)) / F.lit(FAMILY)).cast("long"))
    dealt = (cut.join(small(large), "family", "left").withColumn("part", part)
             .repartition(shuffle_width(spark), "family", "part").sortWithinPartitions("family", "part"))
    kept = stage.write(dealt.select("k1", "k2", "doc", "first", "family", "bytes").mapInArrow(_region_blocks(length), _REGIONS))
    stage.drop(spans)
    stage.release()
    blocks = kept.select("blk", "k1", "k2", "doc", "first", "size", "data")
    answers: dict[str, DataFrame] = {}

    def met(steps) -> DataFrame:
        df = blocks
        for s in steps:
            df = df.join(answers[s], "blk", "left")
        return df

    for step, needs in (("char", []), ("triple", ["char"]), ("merge", ["char", "triple"])):
        sent = met(needs).mapInArrow(_send(step, plan), "blk long, bucket int, x binary")
        back = sent.groupBy("bucket").applyInArrow(_answer(step, plan), "blk long, bucket int, y binary")
        answers[step] = stage.write(back.groupBy("blk").agg(F.collect_list(F.struct("bucket", "y")).alias(f"a_{step}")))
        del sent, back
        stage.release()
    found = "k1 long, k2 long, first int, size int"
    out = stage.write(met(answers).mapInArrow(_removed(plan), found)
                      .union(kept.select("gone_k1", "gone_k2", "gone_first", "gone_size").mapInArrow(_gone_spans, found))
                      .groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.struct("first", "size"))).alias("z"))
                      .select("k1", "k2", F.col("z.first").alias("first"), F.col("z.size").alias("size")))
    stage.drop(kept, *answers.values())
    stage.release()
    return out


def _kept(batches):
    for batch in batches:
        n, removed, spans, digest = [], [], [], []
        for t, f, m in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            t = t or b""
            h, at, cut, count = hashlib.sha256(), 0, 0, 0
            for a, k in zip(f or [], m or []):      # in order; those of neighbouring regions may meet
                if a > at or count == 0:
                    h.update(t[at:a])
                    count += 1
                    at = a
                if a + k > at:
                    cut += a + k - at
                    at = a + k
            h.update(t[at:])
            n.append(len(t))
            removed.append(cut)
            spans.append(count)
            digest.append(h.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, removed, spans)), pa.array(digest, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def suffix_dedup(docs: DataFrame, length: int = 50, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 (of the remaining bytes).

    A null text is empty; texts shorter than ``length`` keep every byte; rows that
    share an id don't remove from each other; a null id counts as larger than any
    other, and null ids don't remove from each other; an empty table gives an
    empty result; other columns don't matter. ``length`` is SPAN + 2 at least and SPAN + 8 at most.
    """
    if not SPAN + 2 <= length <= SPAN + 8:
        raise ValueError(f"length must be {SPAN + 2} to {SPAN + 8}")
    stage = Stage(docs.sparkSession, "suffix")
    spans = removed_spans(docs, length, stage, id_col=id_col, text_col=text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_key(id_col, text_col), text_bytes(text_col).alias("text"))
    met = rows.join(spans.hint("shuffle_hash"), ["k1", "k2"], "left")
    return met.select("doc_id", "text", "first", "size").mapInArrow(
        _kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
