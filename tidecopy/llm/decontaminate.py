"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are compared in lower case (A-Z) with every run of
white space as one space, as UTF-8 bytes. An item is cut into overlapping
segments; a segment of m bytes allows e = rate * m edits. By the q-gram lemma a
text region within e edits of it shares at least m - q + 1 - q * e of its
q-grams, all in diagonals at most e apart. So a document is searched in three
steps, each over whole texts: count the positions whose q-gram is in the
benchmark at all, per stretch of a segment's length; where they are enough,
count shared q-grams by segment and by overlapping diagonal band; where a band
has enough, align the segment to the band by dynamic programming, many bands at
a time. Only the alignment decides.

Tasks normalise and cut the items into a staged table of segments. They go to
the search in blocks of at most ``BLOCK_BYTES`` of segments, also where an item
has more: one block is indexed by the driver and broadcast, all documents are
searched, the matches are staged and the broadcast is destroyed before the next.
So the driver holds one block, whatever the benchmark's size; the documents are
read once a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecopy.llm._store import Stage, free_names, row_key, text_bytes
from tidecopy.llm._text import _BYTE, _SPACE, U64, buffer_of, covered, expand, fits, pieces, window_hashes

BLOCK_BYTES = 4 << 20  # bytes of segments, about twice those of their text
_ROWS = 1 << 13        # segments of one batch
_PIECE = 1 << 18
_MAP_BITS = 22
_STEP = 16            # diagonals that a band has to itself
_CELLS = 1 << 21      # cells of one alignment row worked on at a time

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[_SPACE] = 32


@dataclass(frozen=True)
class Budget:
    """q: length of the q-grams; segment, stride: cut of the items, in bytes; rate:
    edits allowed per byte; least: items with fewer bytes match nothing."""

    q: int = 10
    segment: int = 100
    stride: int = 50
    rate: float = 0.07
    least: int = 40

    def edits(self, m: int) -> int:
        """Edits that a segment of m bytes allows; fewer where the lemma could not filter."""
        return max(0, min(int(self.rate * m), (m - self.q) // self.q))

    def shared(self, m: int) -> int:
        return max(1, m - self.q + 1 - self.q * self.edits(m))


def normalise(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = _LOWER[data]
    space = low == 32
    keep = np.ones(len(low), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[off[(off >= 0) & (off < len(low))]] = True
    total = np.zeros(len(low) + 1, dtype=np.int64)
    np.cumsum(keep, out=total[1:])
    return low[keep], total[off]


def cut(raw: bytes, budget: Budget) -> Iterator[bytes]:
    """The normalised segments of an item."""
    data = np.frombuffer(raw, dtype=np.uint8)
    text, _ = normalise(data, np.array([0, len(data)]))
    text = text.tobytes().strip(b" ")
    if len(text) < budget.least:
        return
    last = max(0, len(text) - budget.segment)
    for a in range(0, last, budget.stride):
        yield text[a:a + budget.segment]
    yield text[last:last + budget.segment]


class Index:
    """Segments of a block of benchmark items and where each q-gram stands in them."""

    def __init__(self, items: list[tuple[int, bytes]], budget: Budget, *, whole: bool = True):
        """``items``: (id, text); or (id, segment) if not ``whole``."""
        pairs = [(s, item) for item, raw in items for s in (cut(raw, budget) if whole else [raw])]
        segs, owner = [s for s, _ in pairs], [i for _, i in pairs]
        self.owner = pa.array(owner, pa.int64())        # null for items without an id
        self.m = np.array([len(s) for s in segs], dtype=np.int64)
        self.e = np.array([budget.edits(m) for m in self.m.tolist()], dtype=np.int64)
        self.need = np.array([budget.shared(m) for m in self.m.tolist()], dtype=np.int64)
        self.letters = np.zeros((len(segs), int(self.m.max(initial=0))), dtype=np.uint8)
        for i, s in enumerate(segs):
            self.letters[i, :len(s)] = np.frombuffer(s, np.uint8)
        buf = np.frombuffer(b"".join(segs), np.uint8)
        off = np.concatenate([[0], np.cumsum(self.m)]).astype(np.int64)
        h = window_hashes(_BYTE[buf], budget.q)
        at = np.flatnonzero(fits(off, budget.q))
        seg = np.searchsorted(off, at, side="right") - 1
        order = np.argsort(h[at], kind="stable")
        self.grams, first = np.unique(h[at][order], return_index=True)
        self.first = np.append(first, len(at))
        self.seg, self.place = seg[order], (at - off[seg])[order]
        self.seen = np.zeros(1 << _MAP_BITS, dtype=bool)
        self.seen[(self.grams >> U64(64 - _MAP_BITS)).astype(np.int64)] = True
        self.q = budget.q


def _segments(budget: Budget):
    def run(batches):
        for batch in batches:
            for item, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                segs = cut(raw, budget)
                while some := list(islice(segs, _ROWS)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(some), pa.int64()), pa.array(some, pa.binary())], ["item_id", "segment"])

    return run


def _blocks(segments: DataFrame, budget: Budget) -> Iterator[Index]:
    held, size = [], 0
    for item, raw in segments.toLocalIterator():
        if held and size + len(raw) > BLOCK_BYTES:
            yield Index(held, budget, whole=False)
            held, size = [], 0
        held.append((item, bytes(raw)))
        size += len(raw)
    if held:
        yield Index(held, budget, whole=False)


def _align(ix: Index, text: np.ndarray, seg: np.ndarray, base: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Edits between each segment and the best stretch of text near its diagonal.

    base: text position of the band's first diagonal for the segment's start; a
    band is as wide as a band of the count plus e on either side."""
    out = np.empty(len(seg), dtype=np.int64)
    if not len(seg):
        return out
    e = int(ix.e.max())
    width = _STEP + 3 * e + 1
    many = max(1, _CELLS // width)
    ramp = np.arange(width, dtype=np.int32)
    padded = np.append(text, np.uint8(0))
    for a in range(0, len(seg), many):
        s, b = seg[a:a + many], base[a:a + many] - e
        m = ix.m[s]
        d = np.zeros((len(s), width), dtype=np.int32)
        for i in range(1, int(m.max()) + 1):
            at = b[:, None] + (i - 1) + ramp[None, :]
            inside = (at >= lo[a:a + many, None]) & (at < hi[a:a + many, None])
            letter = padded[np.where(inside, at, len(text))]
            new = d + (letter != ix.letters[s, min(i, ix.letters.shape[1]) - 1][:, None])
            new[:, :-1] = np.minimum(new[:, :-1], d[:, 1:] + 1)
            new = np.minimum.accumulate(new - ramp, axis=1) + ramp
            d = np.where((i <= m)[:, None], new, d)
        out[a:a + many] = d.min(axis=1)
    return out


def search(ix: Index, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, segment and edits of every match in a buffer."""
    texts, segs, edits = [], [], []
    if not len(ix.m):
        return (np.zeros(0, np.int64),) * 3
    reach = int((ix.m + ix.e).max())
    for first, _, part, po in pieces(data, off, _PIECE):
        text, to = normalise(part, po)
        h = window_hashes(_BYTE[text], ix.q)
        at = np.flatnonzero(ix.seen[(h >> U64(64 - _MAP_BITS)).astype(np.int64)] & fits(to, ix.q))
        gram = np.minimum(np.searchsorted(ix.grams, h[at]), len(ix.grams) - 1)
        real = ix.grams[gram] == h[at]
        at, gram = at[real], gram[real]
        if len(at) < ix.need.min():
            continue
        # stretches of a segment's length that hold enough q-grams of any segments
        need = int(ix.need.min())
        enough = np.zeros(len(at), dtype=bool)
        lead = at[need - 1:] - at[:len(at) - need + 1] < reach
        starts = np.zeros(len(at), dtype=bool)
        starts[:len(lead)] = lead
        enough = covered(starts, need)
        at, gram = at[enough], gram[enough]
        if not len(at):
            continue
        n = ix.first[gram + 1] - ix.first[gram]
        occ = expand(ix.first[gram], n)
        at, seg, place = np.repeat(at, n), ix.seg[occ], ix.place[occ]
        doc = np.searchsorted(to, at, side="right") - 1
        diag = at - place + reach                      # not negative
        band = diag // _STEP
        second = diag % _STEP < ix.e[seg]
        bands = len(text) // _STEP + 2 * reach // _STEP + 3
        key = (doc * len(ix.m) + seg) * bands + band + 1
        key, count = np.unique(np.concatenate([key, key[second] - 1]), return_counts=True)
        band, rest = key % bands - 1, key // bands
        seg, doc = rest % len(ix.m), rest // len(ix.m)
        hit = count >= ix.need[seg]
        seg, doc, band = seg[hit], doc[hit], band[hit]
        found = _align(ix, text, seg, band * _STEP - reach, to[doc], to[doc + 1])
        good = found <= ix.e[seg]
        texts.append(doc[good] + first)
        segs.append(seg[good])
        edits.append(found[good])
    return tuple(np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (texts, segs, edits))


def _matches(index, base: int):
    """Matches with a block, whose first segment has the number ``base``."""
    def run(batches):
        ix = index.value
        for batch in batches:
            data, off = buffer_of(batch.column(3))
            doc, seg, edits = search(ix, data, off)
            ids = [batch.column(i).take(pa.array(doc)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*ids, ix.owner.take(pa.array(seg)), pa.array(seg + base), pa.array(edits)],
                                             ["doc_id", "k1", "k2", "item_id", "segment", "edits"])

    return run


def _found(docs: DataFrame, bench: DataFrame, budget: Budget, stage: Stage, id_col: str, text_col: str, item_col: str,
           item_text: str) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_key(id_col, text_col), text_bytes(text_col).alias("text"))
    schema = "doc_id long, k1 long, k2 long, item_id long, segment long, edits long"
    segments = stage.write(bench.where(F.col(item_text).isNotNull()).select(
        F.col(item_col).cast("long"), text_bytes(item_text)).mapInArrow(_segments(budget), "item_id long, segment binary"))
    parts, base = [], 0
    for ix in _blocks(segments, budget):
        index = spark.sparkContext.broadcast(ix)
        parts.append(stage.write(rows.mapInArrow(_matches(index, base), schema)))
        index.destroy(blocking=True)
        base += len(ix.m)
    stage.drop(segments)
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)


def leaks(docs: DataFrame, bench: DataFrame, budget: Budget = Budget(), *, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and benchmark item it holds: doc_id, item_id, n_segments
    (segments of the item found), edits (least of any).

    Documents that hold none have no row. Null or empty texts hold nothing; items
    whose text is null, empty or under ``least`` bytes match nothing; items without
    an id are searched and give one row together, with a null item_id; rows that
    share an id give one row per item together; empty tables give an empty result;
    other columns don't matter.

    A quote of a part of an item is certain to be found from segment + stride - 1
    normalised bytes on (149 as set): it then holds a whole segment. A shorter one
    is found only if its offset lets it reach a segment within the edits allowed;
    a smaller ``stride`` lowers the bound to ``segment`` at the least.
    """
    found = _found(docs, bench, budget, Stage(docs.sparkSession, "leaks"), id_col, text_col, item_col, item_text)
    return found.groupBy("doc_id", "item_id").agg(F.countDistinct("segment").alias("n_segments"), F.min("edits").alias("edits"))


def drop_leaking(docs: DataFrame, bench: DataFrame, budget: Budget = Budget(), *, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with an id or without, with all
    their columns. Quotes of parts of items: see ``leaks``."""
    stage = Stage(docs.sparkSession, "leaks")
    key1, key2, leak1, leak2 = free_names(docs, "key1", "key2", "leak1", "leak2")
    bad = stage.write(
        _found(docs, bench, budget, stage, id_col, text_col, item_col, item_text).select("k1", "k2").distinct()
        .withColumnsRenamed({"k1": leak1, "k2": leak2}))
    k1, k2 = row_key(id_col, text_col)
    return (docs.select("*", k1.alias(key1), k2.alias(key2))
            .join(bad, (F.col(key1) == F.col(leak1)) & (F.col(key2) == F.col(leak2)), "left_anti")
            .select(*docs.columns))
