"""N-gram Jaccard join with a token-group matrix.

A document's set holds the hashes of its word shingles. Documents with one set
are one class; classes are joined.

Order of tokens: those that some block of documents holds twice come last (a
bitmap of fixed size remembers them), ties go by hash. Two different sets that
reach the threshold (0.8 or more) share at least c = 4 of their first
n - ceil(t n) + c tokens in this order, so only those are looked at, and only
the ones that occur again anywhere (``_exchange``); a class with fewer than c
of them links with no other.

Groups: in a few rounds every class is compared with one hub of the classes it
shares tokens with and, if it links, joins the hub's label. Classes of one label
make a group; classes that are alone with their label are grouped by the most
common of their tokens, so similar ones meet there too. Groups are cut into
parts of ``GROUP`` classes. The rounds end when few comparisons still link; they
decide nothing but links that were verified.

Matrix: for each group the union of its members' tokens, and which members have
which. A class that shares first tokens with a group of another label is a query
to it: if the query's overlap with the union is below t times its size, no member
can link and the group stays closed; otherwise it is opened, and its row of the matrix
gives the overlap with every member at once. A group's queries are cut into parts of
about ``GROUP``, each with the group's matrix. Members of a group with several
labels ask their own group too. So every pair of classes that could link is
excluded by the bound, compared, or known to be connected, and a group sends on
a forest of its links, never its pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecopy.llm._exchange import BUCKETS_PER_PARTITION, Packed, hits_of, new_block, repeated, stored
from tidecopy.llm._store import Stage, free_names, row_key, shuffle_width, small, text_bytes
from tidecopy.llm._text import U64, buffer_of, expand, lean, mix, pieces, prefix_hash, span_hash, word_hashes, words
from tidecopy.llm.components import components

SHARED = 4            # c: first tokens that two linked classes share
GROUP = 512           # classes of one group, and of one part of its queries
ROUNDS = 3            # rounds of hubs, at most
FEW = 50              # no further round if fewer than one comparison in so many links
MAP_BITS = 24         # bits of the map of frequent tokens
_PIECE = 6 << 20
_INNER = 1 << 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes, ascending, back to back; and their offsets."""
    low = _LOWER[data]
    s, e, by = words(low, off)
    codes = word_hashes(low, s, e)
    n = np.diff(by)
    count = np.where(n == 0, 0, np.maximum(1, n - k + 1))
    at = np.concatenate([[0], np.cumsum(count)])
    start = np.arange(at[-1]) + np.repeat(by[:-1] - at[:-1], count)
    h = span_hash(prefix_hash(codes), start, np.minimum(start + k, np.repeat(by[1:], count)))
    doc = np.repeat(np.arange(len(n)), count)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(n) + 1))


def class_of(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A 64-bit number for each set, the same for equal sets; sets without tokens have 0."""
    total = np.zeros(len(h) + 1, dtype=U64)
    np.cumsum(mix(h ^ U64(0x2545F4914F6CDD1D)), out=total[1:])
    return (total[off[1:]] - total[off[:-1]]).view(np.int64)


def _frequent(k: int):
    """Bits of the tokens that two documents of one block share, in rows of 2**16 bits."""
    @lean
    def run(batches):
        seen = np.zeros(1 << MAP_BITS, dtype=bool)
        for batch in batches:
            data, off = buffer_of(batch.column(0))
            for _, _, text, po in pieces(data, off, _PIECE):
                block = []
                for _, _, part, qo in pieces(text, po, _INNER):
                    h, so = shingle_sets(part, qo, k)
                    _, first = np.unique(class_of(h, so), return_index=True)   # copies count once
                    keep = np.zeros(len(so) - 1, dtype=bool)
                    keep[first] = True
                    block.append(h[np.repeat(keep, np.diff(so))])
                h = np.sort(np.concatenate(block))
                seen[(h[1:][h[1:] == h[:-1]] >> U64(64 - MAP_BITS)).astype(np.int64)] = True
        rows = seen.reshape(-1, 1 << 16)
        some = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([np.packbits(rows[i]).tobytes() for i in some], pa.binary())], ["part", "bits"])

    return run


def _either(table):
    bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in table["bits"].to_pylist()])
    return pa.table({"part": table["part"][:1], "bits": pa.array([bits.tobytes()], pa.binary())})


def frequent_map(rows: DataFrame, k: int) -> np.ndarray:
    """The bitmap of frequent tokens: 2 ** MAP_BITS bits (2 MB), whatever the corpus."""
    parts = (rows.select("text").mapInArrow(_frequent(k), "part int, bits binary")
             .groupBy("part").applyInArrow(_either, "part int, bits binary").collect())
    out = np.zeros((1 << (MAP_BITS - 16), 1 << 13), dtype=np.uint8)
    for r in parts:
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


_BLOCK = "blk long, xs array<binary>, doc_id array<long>, k1 array<long>, k2 array<long>, n array<int>, class array<long>, owner binary, slot binary"


def _blocks(k: int, percent: int, bitmap, buckets: int):
    @lean
    def run(batches):
        frequent = np.unpackbits(bitmap.value).view(bool)
        for batch in batches:
            data, off = buffer_of(batch.column(3))
            for i, j, text, po in pieces(data, off, _PIECE):
                ns, cs, owners, tokens, base = [], [], [], [], 0
                for a, b, part, qo in pieces(text, po, _INNER):
                    h, so = shingle_sets(part, qo, k)
                    n = np.diff(so)
                    c = class_of(h, so)
                    doc = np.repeat(np.arange(len(n)), n)
                    order = np.lexsort((h, frequent[(h >> U64(64 - MAP_BITS)).astype(np.int64)], doc))
                    first = np.where(n >= SHARED, n + percent * n // -100 + SHARED, 0)    # n - ceil(t n) + c
                    take = np.arange(len(h)) - so[:-1][doc] < first[doc]
                    owners.append(doc[take] + base)
                    tokens.append(h[order][take])
                    ns.append(n)
                    cs.append(c)
                    base += b - a
                n, c = np.concatenate(ns), np.concatenate(cs)
                owner, token = np.concatenate(owners), np.concatenate(tokens)
                _, first = np.unique(c, return_index=True)      # of a block's copies, one looks up
                once = np.zeros(len(c), dtype=bool)
                once[first] = True
                owner, token = owner[once[owner]], token[once[owner]]
                packed = Packed(token[:, None], buckets)
                ids = [pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), batch.column(x)[i:j]) for x in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([new_block()]), pa.array([packed.rows()], pa.list_(pa.binary())), *ids,
                     pa.array([n.astype(np.int32)]), pa.array([c]), pa.array([owner.astype("<i4").tobytes()]),
                     pa.array([packed.slot.astype("<i4").tobytes()])],
                    ["blk", "xs", "doc_id", "k1", "k2", "n", "class", "owner", "slot"])

    return run


@lean
def _postings(batches):
    """(token, class, n) of the looked-up tokens that occur again."""
    for batch in batches:
        for row in batch.to_pylist():
            keys = np.concatenate([np.frombuffer(x, "<u8", len(x) // 9) for x in row["xs"]])
            mask = [np.zeros(len(x) // 9, dtype=bool) for x in row["xs"]]
            for h in row["hits"]:
                mask[h["bucket"]] = np.unpackbits(np.frombuffer(h["bits"], np.uint8), count=len(mask[h["bucket"]])).astype(bool)
            slot = np.frombuffer(row["slot"], "<i4")
            hit = np.concatenate(mask)[slot]
            owner = np.frombuffer(row["owner"], "<i4")[hit]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[slot[hit]].view(np.int64)), pa.array(np.array(row["class"])[owner]),
                 pa.array(np.array(row["n"], dtype=np.int32)[owner])], ["token", "class", "n"])


def _sets(k: int):
    """(class, set, copies); of the copies of a row, a task sends one."""
    @lean
    def run(batches):
        seen = set()
        for batch in batches:
            first = [n == 1 or not (c in seen or seen.add(c)) for c, n in zip(batch["class"].to_pylist(), batch["copies"].to_pylist())]
            batch = batch.filter(pa.array(first, pa.bool_()))
            data, off = buffer_of(batch["text"])
            for i, j, part, po in pieces(data, off, _INNER):
                h, so = shingle_sets(part, po, k)
                yield pa.RecordBatch.from_arrays(
                    [batch["class"][i:j], pa.array([h[a:b].tobytes() for a, b in zip(so[:-1], so[1:])], pa.binary()), batch["copies"][i:j]],
                    ["class", "set", "copies"])

    return run


def _links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = _overlap(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _linked(pairs: DataFrame, sets: DataFrame, percent: int, n: int) -> DataFrame:
    """Of n staged pairs (class, hub), one per class: those that link."""
    @lean
    def run(batches):
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            ok = [_links(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent) for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["class", "hub"]).filter(pa.array(ok, pa.bool_()))

    hubs = (sets.join(small(pairs.select(F.col("hub").alias("class")).distinct(), n), "class", "left_semi")
            .select(F.col("class").alias("hub"), F.col("set").alias("hub_set")))
    met = sets.join(small(pairs, n), "class").join(hubs, "hub").select("class", "hub", "set", "hub_set")
    return met.mapInArrow(run, "class long, hub long")


def _shared(posted: DataFrame) -> DataFrame:
    """Postings of tokens that several classes share, of classes with enough of them."""
    several = posted.groupBy("token").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi").select("token")
    kept = posted.join(several, "token", "left_semi")
    enough = kept.groupBy("class").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= SHARED).select("class")
    return kept.join(enough, "class", "left_semi")


class _Group:
    """The matrix of one group: its union of tokens and who has them."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(x) for x in sets], dtype=np.int64)
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.n)
        order = np.argsort(tokens, kind="stable")
        self.union, first = np.unique(tokens[order], return_index=True)
        self.first = np.append(first, len(tokens))
        self.owner = owner[order]

    def links(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Members that link with the query; none if the bound closes the group."""
        at = np.searchsorted(self.union, query)
        at[at == len(self.union)] = 0
        at = at[self.union[at] == query]
        if 100 * len(at) < percent * len(query):
            return np.zeros(0, np.int64)
        n = self.first[at + 1] - self.first[at]
        both = np.bincount(self.owner[expand(self.first[at], n)], minlength=len(self.n))
        return np.flatnonzero((100 * both >= percent * (len(query) + self.n - both)) & (both > 0))


def _open(percent: int):
    """One group and a part of its queries (in part 0 its own members among them, if
    their labels differ): a forest of links, as (class, hub)."""
    def run(key, members, queries):
        own, label = members["class"].to_pylist(), members["label"].to_pylist()
        out = {"class": [], "hub": []}
        if own:
            sets = [np.frombuffer(x, "<u8") for x in members["set"].to_pylist()]
            group, root = _Group(sets), {}

            def find(x):
                while root.setdefault(x, x) != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for c, l in zip(own, label):        # one label: connected already
                root[find(c)] = find(("label", l))
            asking = list(zip(queries["q_class"].to_pylist(), queries["q_set"].to_pylist()))
            if key[1].as_py() == 0 and len(set(label)) > 1:
                asking += zip(own, members["set"].to_pylist())
            for q, x in asking:
                for m in group.links(np.frombuffer(x, "<u8"), percent).tolist():
                    if (a := find(q)) != (b := find(own[m])):
                        root[a] = b
                        out["class"].append(q)
                        out["hub"].append(own[m])
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return run


def _near(n: str, m: str, percent: int) -> str:
    return f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m})"


def jaccard_classes(docs: DataFrame, stage: Stage, *, k: int = 4, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Staged: doc_id, k1, k2 (``row_key``), n_shingles, class, component (a class number,
    the same for all that are connected)."""
    if not 80 <= percent <= 100:    # below, sets of fewer than SHARED tokens could link
        raise ValueError("percent must be 80 to 100")
    spark = docs.sparkSession
    buckets = BUCKETS_PER_PARTITION * shuffle_width(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_key(id_col, text_col), text_bytes(text_col).alias("text"))
    bitmap = spark.sparkContext.broadcast(frequent_map(rows, k))
    blocks = stage.write(rows.mapInArrow(_blocks(k, percent, bitmap, buckets), _BLOCK))
    members = stage.write(blocks.select(F.explode(F.arrays_zip("doc_id", "k1", "k2", "n", "class")).alias("d")).select(
        "d.doc_id", "d.k1", "d.k2", F.col("d.n").alias("n_shingles"), "d.class"))
    hits = repeated(stored(blocks))
    posted = (blocks.select("blk", "xs", "class", "n", "owner", "slot").join(hits, "blk")
              .mapInArrow(_postings, "token long, class long, n int").distinct())
    posted = stage.write(posted)
    stage.drop(blocks)
    stage.release()
    shared = stage.write(_shared(posted))
    stage.drop(posted)
    posted, shared = shared, stage.write(_shared(shared))      # what went may leave others alone
    stage.drop(posted)
    if shared.isEmpty():      # no class can link with another
        out = stage.write(members.withColumn("component", F.col("class")))
        stage.drop(members, shared)
        return out
    # the sets of the classes that are left: of each class, one row's text; and one only
    # of the rows that share id and text
    chosen = stage.write(members.join(shared.select("class").distinct(), "class", "left_semi").groupBy("class", "k1", "k2")
                         .agg(F.count(F.lit(1)).alias("copies")).groupBy("class")
                         .agg(F.min(F.struct("k1", "k2", "copies")).alias("k")).select("class", "k.k1", "k.k2", "k.copies"))
    texts = rows.select("k1", "k2", "text").join(small(chosen), ["k1", "k2"]).select("class", "text", "copies")
    made = stage.write(texts.mapInArrow(_sets(k), "class long, set binary, copies long"))
    several = stage.write(made.where("copies > 1").select("class", "set").dropDuplicates(["class"]))
    sets = made.where("copies = 1").select("class", "set").unionAll(several)
    stage.release()
    # rounds of hubs
    labels = stage.write(shared.groupBy("class").agg(F.max("n").alias("n")).withColumn("label", F.col("class")))
    found = []
    for r in range(ROUNDS):
        named = shared.join(labels.select("class", "label"), "class")
        hub = named.groupBy("token").agg(
            F.min(F.struct(F.xxhash64("class", F.lit(r)).alias("o"), "class", "n", "label")).alias("h"),
            F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select(
            "token", F.col("h.class").alias("hub"), F.col("h.n").alias("hn"), F.col("h.label").alias("hub_label"))
        pairs = (named.join(hub, "token").where("label <> hub_label AND " + _near("n", "hn", percent))
                 .groupBy("class", "hub").agg(F.count(F.lit(1)).alias("c"), F.max("hub_label").alias("hub_label"))
                 .where(F.col("c") >= SHARED))
        best = stage.write(pairs.groupBy("class").agg(F.max(F.struct("c", "hub", "hub_label")).alias("b"))
                           .select("class", "b.hub", "b.hub_label"))
        tried = best.count()
        if not tried:
            break
        linked = stage.write(_linked(best.select("class", "hub"), sets, percent, tried))
        found.append(linked)
        moved = linked.join(best, ["class", "hub"]).select("class", F.col("hub_label").alias("new"))
        before = labels
        labels = stage.write(before.join(moved, "class", "left").select("class", "n", F.coalesce("new", "label").alias("label")))
        few = linked.count() * FEW < tried
        stage.drop(before, best)
        stage.release()
        if few:
            break
    # groups: classes of one label, or with one most common token
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    common = shared.groupBy("token").agg(F.count(F.lit(1)).alias("c"))
    nearest = (shared.select("class", "token").join(common, "token").groupBy("class")
               .agg(F.max(F.struct("c", "token")).alias("m")).select("class", "m.token"))
    alone = F.col("size") == 1
    keyed = stage.write(labels.join(sizes, "label").join(nearest, "class").select(
        "class", "n", "label", "size", alone.alias("alone"),
        F.when(alone, F.xxhash64("token", F.lit("token"))).otherwise(F.xxhash64("label", F.lit("label"))).alias("gkey")))
    many = keyed.groupBy("gkey").agg(F.ceil(F.count(F.lit(1)) / F.lit(GROUP)).cast("long").alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("class", F.lit("group")), F.coalesce("parts", F.lit(1).cast("long")))
    grouped = stage.write(keyed.join(many, "gkey", "left").select(
        "class", "n", "label", "size", "alone", F.xxhash64("gkey", part).alias("grp")))
    # queries: tokens that several labels share; the class of the smaller label (or, of
    # equal ones, of the lesser group) asks the group of the other
    named = shared.select("token", "class").join(grouped, "class")
    open_ = named.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("token")
    named = stage.write(named.join(open_, "token", "left_semi"))
    queries = named.select("token", "class", "n", F.col("label").alias("ql"), F.col("size").alias("qs"), F.col("grp").alias("qg"))
    groups = named.groupBy("token", "grp").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.first("size").alias("gs"),
                                               F.min(F.when(~F.col("alone"), F.col("label"))).alias("gl"))
    asked = stage.write(queries.join(groups, "token").where(
        f"(qs < gs OR (qs = gs AND qg < grp)) AND NOT (gl <=> ql) AND 100 * most >= {percent} * n AND 100 * n >= {percent} * least")
        .groupBy("class", "grp").agg(F.countDistinct("token").alias("c")).where(F.col("c") >= SHARED).select("class", "grp"))
    # groups that are asked, and those whose members ask one another
    mixed = grouped.where("alone").groupBy("grp").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("grp")
    # a group's queries are cut into parts too; its members go to each
    cuts = stage.write(asked.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / F.lit(GROUP)).cast("long").alias("cuts"))
                       .join(mixed, "grp", "full").select("grp", F.coalesce("cuts", F.lit(1).cast("long")).alias("cuts")))
    answering = stage.write(grouped.join(cuts, "grp").select(
        "class", "grp", "label", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("cut")))
    asked_in = stage.write(asked.join(cuts, "grp").select("class", "grp", F.pmod(F.xxhash64("class", F.lit("query")), "cuts").alias("cut")))
    side = sets.join(small(answering), "class").select("grp", "cut", "class", "label", "set")
    asking = sets.join(small(asked_in), "class").select(
        F.col("grp").alias("q_grp"), F.col("cut").alias("q_cut"), F.col("class").alias("q_class"), F.col("set").alias("q_set"))
    across = stage.write(side.groupBy("grp", "cut").cogroup(asking.groupBy("q_grp", "q_cut")).applyInArrow(
        _open(percent), "class long, hub long"))
    stage.drop(made, several, named, asked, asked_in, cuts, answering)
    stage.release()
    links = across
    for f in found:
        links = links.unionAll(f)
    comps = components(links.select(F.col("class").alias("a"), F.col("hub").alias("b")), stage)
    out = members.join(comps.withColumnsRenamed({"node": "class"}), "class", "left").select(
        "doc_id", "k1", "k2", "n_shingles", "class", F.coalesce("comp", "class").alias("component"))
    out = stage.write(out)
    stage.drop(members, shared, keyed, grouped, labels, across, *found)
    return out


def jaccard_join(docs: DataFrame, *, k: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (least id it is
    connected with by links of Jaccard similarity ``percent`` % or more).

    Null, empty or blank texts have no shingles and link with nothing, not with
    each other either: their component is their own id. Equal texts are linked.
    A row without id takes part and gets the least id of its component (null if
    there is none). An empty table gives an empty result; other columns don't matter.
    """
    stage = Stage(docs.sparkSession, "jaccard")
    rows = jaccard_classes(docs, stage, k=k, percent=percent, id_col=id_col, text_col=text_col)
    least = rows.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "component", "left").select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"),
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, *, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, but one only of each component:
    that with the least id (of rows with that id, the first by ``row_key``; of rows
    with that text too, the first by all columns). Rows without shingles all stay."""
    stage = Stage(docs.sparkSession, "jaccard")
    rows = jaccard_classes(docs, stage, k=k, percent=percent, id_col=id_col, text_col=text_col)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    first = rows.where("n_shingles > 0").groupBy("component").agg(F.min(order).alias("f")).select("f.k1", "f.k2")
    key1, key2, keep1, keep2, row = free_names(docs, "key1", "key2", "keep1", "keep2", "row")
    keep = stage.write(first.unionAll(rows.where("n_shingles = 0").select("k1", "k2").distinct())
                       .select(F.col("k1").alias(keep1), F.col("k2").alias(keep2)))
    k1, k2 = row_key(id_col, text_col)
    met = (docs.select("*", k1.alias(key1), k2.alias(key2))
           .join(keep.hint("shuffle_hash"), (F.col(key1) == F.col(keep1)) & (F.col(key2) == F.col(keep2)), "left_semi"))
    order = F.struct(*[F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name)
                       for f in docs.schema if f.name != text_col])     # maps have no order
    return (met.groupBy(key1, key2).agg(F.min_by(F.struct(*docs.columns), order).alias(row))
            .select(*[F.col(row)[c].alias(c) for c in docs.columns]))
