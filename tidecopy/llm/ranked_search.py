"""Ranked lexical search on K2-treaps over the term-document grid.

Documents are indexed in blocks, cut where a task reads them, so that no text or
posting is shuffled. A block's grid has a row for each of its terms (frequent ones
first) and a column for each of its documents; a posting is a point whose value is
its impact, the part of the score that does not depend on the item. The grid is cut
into quadrants, these into theirs and so on, until a cell holds one point. Every
cell stores the greatest impact inside as the difference to its parent's; a cell
with several points a 4-bit mask of its non-empty quadrants, whose running sum gives
the place of its children; a cell with one point what is left of its coordinates.

An item descends with all its terms together: a state is a range of documents and,
for each term, the cell on the path of the term's row that covers the range. The sum
of weight times greatest impact bounds the scores in the range. The ranges with the
greatest bounds are halved first; a term drops out where its row's quadrant is empty
or its cell's only point lies in another row, and a range whose cells are single
points gives its documents' exact scores. A range goes when its bound is below the
k-th best score so far.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecopy.llm._store import Stage, text_bytes
from tidecopy.llm._text import U64, buffer_of, byte_prefix, expand, pieces, runs, span_hash
from tidecopy.session import checkpoint_dir

BLOCK_POSTINGS = 1 << 20     # postings that close a block (a document is never cut)
BLOCKS_A_FILE = 8            # blocks are rows of about 5 MB
ITEM_TERMS = 1 << 20         # distinct terms of the items searched in one pass over the index
_PIECE = 1 << 19
_WIDTH = 128                 # ranges halved in one step
_POP = np.array([bin(i).count("1") for i in range(16)], dtype=np.int32)
_BELOW = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], dtype=np.int32)
# Terms: ASCII letters and digits and whatever is beyond ASCII; A-Z are lower-cased.
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[0x80:] = _INSIDE[0x30:0x3A] = _INSIDE[0x41:0x5B] = _INSIDE[0x61:0x7B] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term of the texts in a buffer, and each text's first term (plus the total)."""
    starts, ends = runs(_INSIDE[data], off)
    return span_hash(byte_prefix(_LOWER[data]), starts, ends), np.searchsorted(starts, off)


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits 0 to 31 moved to the even places."""
    x = x.astype(U64)
    for by, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                     (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << U64(by))) & U64(keep)
    return x


def _gathered(x: np.ndarray) -> np.ndarray:
    """The bits at the even places."""
    x = x & U64(0x5555555555555555)
    for by, keep in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF),
                     (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> U64(by))) & U64(keep)
    return x.astype(np.int64)


def _planes(a: np.ndarray) -> bytes:
    """Numbers byte by byte, lowest bytes first, so that zero bytes stand together; upper all-zero planes left out."""
    raw = a.astype("<u8").view(np.uint8).reshape(-1, 8)
    used = (int(a.max(initial=0)).bit_length() + 7) // 8
    return raw[:, :used].T.tobytes()


def _numbers(raw: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    if n:
        flat = np.frombuffer(raw, np.uint8).reshape(-1, n)
        out[:, :len(flat)] = flat.T
    return out.reshape(-1).view("<u8")


def build_block(doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int) -> tuple[dict, np.ndarray]:
    """The stored form of a block's postings (distinct pairs of document number and term hash, by
    document), and its documents in the order of their columns: those whose strongest term is the same
    stand together (texts of one language do), and among them those in which it is as strong."""
    order_of, row, df = np.unique(term, return_inverse=True, return_counts=True)
    by_df = np.argsort(-df, kind="stable")
    place = np.empty(len(by_df), dtype=np.int64)
    place[by_df] = np.arange(len(by_df))
    row = place[row]
    strongest = np.full(n_docs, -1, dtype=np.int64)
    if len(doc):
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        strongest[doc[first]] = np.maximum.reduceat((impact << 32) - row, first)
    most, at_row = (strongest + (1 << 32) - 1) >> 32, -strongest & ((1 << 32) - 1)
    columns = np.lexsort((-most, at_row))
    column = np.empty(n_docs, dtype=np.int64)
    column[columns] = np.arange(n_docs)
    height = max(1, (max(len(df), n_docs) - 1).bit_length())
    code = (_spread(row) << U64(1)) | _spread(column[doc])
    order = np.argsort(code)
    code, value = code[order], impact[order]
    leaf_bits, masks, deltas, rests, above = [], [], [], [], None
    for level in range(height + 1):
        if not len(code):
            break
        key = code >> U64(2 * (height - level))
        head = np.ones(len(key), dtype=bool)
        head[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(head)
        most = np.maximum.reduceat(value, first)
        size = np.diff(np.append(first, len(key)))
        if above is None:
            deltas.append(most)
        else:
            parent = key[first] >> U64(2)
            new = np.ones(len(first), dtype=bool)
            new[1:] = parent[1:] != parent[:-1]
            deltas.append(above[np.cumsum(new) - 1] - most)
            quadrant = np.left_shift(1, (key[first] & U64(3)).astype(np.uint8)).astype(np.uint8)
            masks.append(np.bitwise_or.reduceat(quadrant, np.flatnonzero(new)))
        leaf = size == 1
        leaf_bits.append(leaf)
        rests.append(code[first[leaf]] & U64((1 << 2 * (height - level)) - 1))
        inner = np.repeat(~leaf, size)
        code, value, above = code[inner], value[inner], most[~leaf]
    cat = lambda xs, t: np.concatenate([np.zeros(0, t), *xs])
    bits = cat(leaf_bits, bool)
    return {"n_docs": n_docs, "height": height, "n_nodes": len(bits), "terms": order_of[by_df].tobytes(),
            "dfs": df[by_df].astype(np.int64).tobytes(), "leaves": np.packbits(bits).tobytes(),
            "masks": cat(masks, np.uint8).tobytes(), "deltas": _planes(cat(deltas, np.int64)), "rests": _planes(cat(rests, U64))}, columns


class Block:
    """A stored block, ready to be searched."""

    def __init__(self, stored: dict):
        self.height, n = stored["height"], stored["n_nodes"]
        row_terms = np.frombuffer(stored["terms"], U64)
        self.row = np.argsort(row_terms)
        self.terms = row_terms[self.row]
        self.leaf = np.unpackbits(np.frombuffer(stored["leaves"], np.uint8), count=n).astype(bool)
        masks = np.frombuffer(stored["masks"], np.uint8)
        self.mask = np.zeros(n, dtype=np.uint8)
        self.mask[~self.leaf] = masks
        # rank: a cell's first child, or the number of its single point
        self.first = np.empty(n, dtype=np.int64)
        self.first[~self.leaf] = 1 + np.cumsum(_POP[masks]) - _POP[masks]
        self.first[self.leaf] = np.arange(int(self.leaf.sum()))
        self.delta = _numbers(stored["deltas"], n).astype(np.int64)
        rest = _numbers(stored["rests"], int(self.leaf.sum()))
        self.point_row, self.point_col = _gathered(rest >> U64(1)), _gathered(rest)

    def rows_of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the terms the block has, and their rows."""
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        has = np.flatnonzero(self.terms[at] == hashes) if len(self.terms) else np.zeros(0, np.int64)
        return has, self.row[at[has]]

    def _states(self, level, col, count, term, node, value, rows, weight):
        """States (ranges, each with ``count`` terms and their cells), without terms whose cell's only
        point lies in another row, and with the ranges' bounds; best first, ``_WIDTH`` at a time."""
        of = np.repeat(np.arange(len(count)), count)
        low = (1 << (self.height - level)) - 1
        other = self.leaf[node] & (((self.point_row[np.where(self.leaf[node], self.first[node], 0)] ^ rows[term]) & low[of]) != 0)
        here = np.flatnonzero(~other)
        of, term, node, value = of[here], term[here], node[here], value[here]
        count = np.bincount(of, minlength=len(count))
        bound = np.bincount(of, weights=value * weight[term], minlength=len(count)).astype(np.int64)     # below 2**53
        start = np.cumsum(count) - count
        order = np.argsort(-bound, kind="stable")[:int((bound > 0).sum())]
        for i in range(0, len(order), _WIDTH):
            some = order[i:i + _WIDTH]
            at = expand(start[some], count[some])
            yield bound[some], level[some], col[some], count[some], term[at], node[at], value[at]

    def search(self, rows: np.ndarray, weight: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores of the documents of score ``least`` (1 at least) or more, down to the k-th best."""
        cols, scores, number = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        none, each = np.zeros(1, np.int64), np.arange(len(rows))
        queue = []
        opened = [(none, none, np.array([len(rows)]), each, np.zeros(len(rows), np.int64), np.full(len(rows), self.delta[0]))]
        while opened or queue:
            for state in opened:
                for part in self._states(*state, rows, weight):
                    number += 1
                    heappush(queue, (-int(part[0][0]), number, part))
            opened, parts, size = [], [], 0
            while queue and size < _WIDTH and -queue[0][0] >= least:
                parts.append(heappop(queue)[2])
                size += len(parts[-1][0])
            if not parts:
                break
            bound, level, col, count, term, node, value = (np.concatenate(x) for x in zip(*parts))
            single = np.add.reduceat(self.leaf[node].astype(np.int64), np.cumsum(count) - count) == count
            ready = single & (bound >= least)
            if ready.any():
                at = np.repeat(ready, count)
                got = self._scores(*(np.repeat(x, count)[at] for x in (level, col)), node[at], value[at] * weight[term[at]])
                cols, scores = np.concatenate([cols, got[0]]), np.concatenate([scores, got[1]])
                if len(scores) >= k:
                    least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                keep = scores >= least
                cols, scores = cols[keep], scores[keep]
            open_ = ~single & (bound >= least)
            if open_.any():
                at = np.repeat(open_, count)
                opened = [self._halves(level[open_], col[open_], count[open_], term[at], node[at], value[at], rows)]
        return cols, scores

    def _halves(self, level, col, count, term, node, value, rows):
        """The left and the right halves of some ranges."""
        of = np.repeat(np.arange(len(count)), count)
        shift = (self.height - 1 - level)[of]
        leaf, mask, first = self.leaf[node], self.mask[node].astype(np.int64), self.first[node]
        upper = ((rows[term] >> shift) & 1) * 2
        point = np.where(leaf, (self.point_col[np.where(leaf, first, 0)] >> shift) & 1, -1)
        out = []
        for side in (0, 1):
            inner = (mask >> (upper + side)) & 1 == 1
            here = np.flatnonzero(inner | (point == side))
            into, n = inner[here], node[here]
            child = np.where(into, first[here] + _BELOW[mask[here], upper[here] + side], n)
            out.append((level + 1, col * 2 + side, np.bincount(of[here], minlength=len(count)), term[here], child,
                        value[here] - np.where(into, self.delta[child], 0)))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _scores(self, level, col, node, part):
        """Exact scores in ranges whose cells are single points."""
        left = self.height - level
        full = (col << left) | (self.point_col[self.first[node]] & ((1 << left) - 1))
        cols, which = np.unique(full, return_inverse=True)
        scores = np.bincount(which, weights=part).astype(np.int64)
        return cols[scores > 0], scores[scores > 0]


def _count(batches):
    for batch in batches:
        for _, _, part, po in pieces(*buffer_of(batch.column(0)), _PIECE):
            _, by = terms(part, po)
            n = np.diff(by)
            yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], ["n", "terms"])


_BLOCK = ("n_docs long, height int, n_nodes long, terms binary, dfs binary, leaves binary, masks binary, deltas binary, "
          "rests binary, doc_ids array<long>")


def _blocks(n_all: int, l_all: int, most: int):
    def stored(held):
        ids, doc, term, impact = (pa.concat_arrays([h[0] for h in held]), *(np.concatenate([h[i] for h in held]) for i in (1, 2, 3)))
        block, columns = build_block(doc, term, impact, len(ids))
        ids = ids.take(pa.array(columns))
        lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([block["n_docs"]], pa.int64()), pa.array([block["height"]], pa.int32()), pa.array([block["n_nodes"]], pa.int64()),
             *[pa.array([block[c]], pa.binary()) for c in ("terms", "dfs", "leaves", "masks", "deltas", "rests")], lists],
            ["n_docs", "height", "n_nodes", "terms", "dfs", "leaves", "masks", "deltas", "rests", "doc_ids"])

    def run(batches):
        held, docs, size = [], 0, 0
        for batch in batches:
            data, off = buffer_of(batch.column(1))
            for i, j, part, po in pieces(data, off, _PIECE):
                h, by = terms(part, po)
                n = np.diff(by)
                voc, ids = np.unique(h, return_inverse=True)
                pair, tf = np.unique(np.repeat(np.arange(j - i), n) * max(1, len(voc)) + ids, return_counts=True)
                doc = pair // max(1, len(voc))
                # m, by distinct length, in Python's whole numbers
                lengths, of = np.unique(n, return_inverse=True)
                m = np.array([10 + (90 * x * n_all) // max(1, l_all) for x in lengths.tolist()], dtype=np.int64)[of]
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
                held.append((batch.column(0).slice(i, j - i).cast(pa.int64()), doc + docs, voc[pair % max(1, len(voc))], impact))
                docs, size = docs + j - i, size + len(pair)
                if size >= most:
                    yield stored(held)
                    held, docs, size = [], 0, 0
        if size:
            yield stored(held)

    return run


class SearchIndex:
    """A written index: its blocks and the counts that weights need."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
        row = spark.read.schema("n long, terms long").parquet(f"{path}/counts").first()
        self.n_docs, self.n_terms = row["n"], row["terms"]


def build_index(docs: DataFrame, path: str | None = None, *, block_postings: int = BLOCK_POSTINGS, id_col: str = "doc_id",
                text_col: str = "text") -> SearchIndex:
    """Index every row of ``docs`` under ``path`` (a folder that all executors share;
    by default a new one in the checkpoint folder); ``SearchIndex(spark, path)`` opens it again.

    The texts are read twice, for the counts and for the blocks. Null and empty texts
    are in no posting; a null id stays null; repeated rows are documents of their own;
    an empty table gives an index that finds nothing; other columns don't matter.
    """
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark)}/search-{uuid.uuid4().hex}"
    text = text_bytes(text_col).alias("text")
    counts = docs.select(text).mapInArrow(_count, "n long, terms long").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("terms"), F.lit(0)).alias("terms"))
    counts.write.parquet(f"{path}/counts")
    n, all_terms = spark.read.schema("n long, terms long").parquet(f"{path}/counts").first()
    (docs.select(F.col(id_col).cast("long").alias("doc_id"), text).mapInArrow(_blocks(n, all_terms, block_postings), _BLOCK)
     .write.option("compression", "zstd").option("maxRecordsPerFile", BLOCKS_A_FILE).parquet(f"{path}/blocks"))
    return SearchIndex(spark, path)


def _item_terms(batches):
    for batch in batches:
        data, off = buffer_of(batch.column(2))
        h, by = terms(data, off)
        sets = [np.unique(h[a:b]) for a, b in zip(by[:-1], by[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s.tobytes() for s in sets], pa.binary())],
                                         ["row", "item_id", "terms"])


def _passes(items: DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Items with their terms, as many at a time as have ``ITEM_TERMS`` terms together."""
    held, size = [], 0
    for row, raw in items.select("row", "terms").toLocalIterator():
        held.append((row, np.frombuffer(raw, U64)))
        size += len(held[-1][1])
        if size >= ITEM_TERMS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _frequencies(wanted):
    def run(batches):
        want = wanted.value
        for batch in batches:
            for raw, dfs in zip(batch.column(0), batch.column(1)):
                have, df = np.frombuffer(raw.as_buffer(), U64), np.frombuffer(dfs.as_buffer(), np.int64)
                at = np.minimum(np.searchsorted(want, have), len(want) - 1)
                hit = want[at] == have
                yield pa.RecordBatch.from_arrays([pa.array(at[hit]), pa.array(df[hit])], ["i", "df"])

    return run


def _best(queries, k: int):
    """The k best documents of each item in a task's blocks; a block starts from what the blocks before it gave."""
    def run(batches):
        best = {row: [] for row, _, _ in queries.value}
        for batch in batches:
            for stored in batch.to_pylist():
                ids = stored["doc_ids"]
                block = Block(stored)
                for row, hashes, weight in queries.value:
                    top = best[row]
                    has, rows = block.rows_of(hashes)
                    cols, scores = block.search(rows, weight[has], k, top[-1][0] if len(top) == k else 1)
                    found = [(s, ids[c]) for c, s in zip(cols.tolist(), scores.tolist())]
                    if found:
                        best[row] = sorted(top + found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        out = [(row, s, i) for row, top in best.items() for s, i in top]
        yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], pa.int64()) for j in range(3)], ["row", "score", "doc_id"])

    return run


def search(index: SearchIndex, items: DataFrame, k: int = 10, *, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The k highest-scoring documents of every item: item_id, rank, doc_id, score.

    A term weighs floor(1000 ln((2N + 2) / (2 df + 1))); its impact in a document is
    10^9 tf div (1000 tf + 8 m), m = 10 + 90 n N div L. Equal scores go by doc_id, a
    null one last; documents of score 0 are not ranked. Items without terms (null,
    empty) and items that find nothing have no rows; a null item_id stays null;
    repeated items are each searched; an empty table of items gives an empty result;
    other columns don't matter. Items pass through the driver and are broadcast by
    their distinct term hashes, at most about 8 MB (and one item's) at a time.
    """
    spark = index.spark
    stage = Stage(spark, "ranked")
    rows = stage.write(items.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("item_id"),
        text_bytes(text_col).alias("text")).mapInArrow(_item_terms, "row long, item_id long, terms binary"))
    found = spark.createDataFrame([], "row long, score long, doc_id long")
    for some in _passes(rows):
        want = np.unique(np.concatenate([t for _, t in some]))
        if not len(want):
            continue
        wanted = spark.sparkContext.broadcast(want)
        df = np.zeros(len(want), dtype=np.int64)
        for i, n in (index.blocks.select("terms", "dfs").mapInArrow(_frequencies(wanted), "i long, df long")
                     .groupBy("i").agg(F.sum("df").alias("df")).toLocalIterator()):
            df[i] = n
        weight = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)
        at = [(row, t[df[np.searchsorted(want, t)] > 0]) for row, t in some]
        queries = spark.sparkContext.broadcast([(row, t, weight[np.searchsorted(want, t)]) for row, t in at if len(t)])
        found = found.unionAll(stage.write(index.blocks.mapInArrow(_best(queries, k), "row long, score long, doc_id long")))
        for sent in (wanted, queries):
            sent.destroy()
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(rows.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")
