"""Repeated words and bytes, against brute force."""

import hashlib
import random
import re
from collections import Counter

from tidecopy.llm.substring_dedup import levels_of, substring_dedup
from tidecopy.llm.suffix_dedup import suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "k") for i, t in rows],
                                 "doc_id long, text string, first string, size int, k1 string")


def made_rows(seed=4):
    rnd = random.Random(seed)
    say = lambda n: " ".join(rnd.choice("the of und é la 世界 to go x yz".split()) + rnd.choice(["", str(rnd.randint(0, 400))])
                             for _ in range(n))
    shared = [say(60), say(35), say(34), say(200)]
    rows = []
    for i in range(120):
        t = say(rnd.randint(0, 120))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(shared).split(" ")
            a = rnd.randint(0, 20)
            t += rnd.choice([" ", "\n", "  "]) + " ".join(p[a:a + rnd.randint(20, 200)]) + " " + say(rnd.randint(0, 9))
        rows.append((i, t))
    copy = say(50)
    rows += [(200 + i, copy) for i in range(40)]                       # a group of copies
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "a b"), (303, "a b"), (304, "w " * 3000), (305, "z" * 4000),
             (306, shared[3]), (306, shared[3])]                       # a row twice, long repeats inside one text
    return rows


def words_expected(rows, length):
    count = Counter()
    split = [WORD.findall(t or "") for _, t in rows]
    for w in split:
        count.update(tuple(w[k:k + length]) for k in range(len(w) - length + 1))
    out = []
    for (i, _), w in zip(rows, split):
        gone = bytearray(len(w))
        for k in range(len(w) - length + 1):
            if count[tuple(w[k:k + length])] > 1:
                gone[k:k + length] = b"\1" * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def bytes_expected(rows, length):
    big = 2**64
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            least[s] = min(least.get(s, big), big if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if least[b[k:k + length]] < (big if i is None else i):
                gone[k:k + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return Counter(out)


def test_levels():
    assert levels_of(35) == [9, 18, 35] and levels_of(6) == [6] and levels_of(64) == [8, 16, 32, 64]


def test_substring_dedup_made(spark):
    rows = made_rows()
    got = Counter(tuple(r) for r in substring_dedup(table(spark, rows).repartition(5), 35).collect())
    assert got == words_expected(rows, 35)


def test_substring_dedup_whole_table(spark, sf_small):
    from tidecopy.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op2_substring_dedup"](spark, sf_small).collect())
    assert got == words_expected(rows, 35)


def test_suffix_dedup_made(spark):
    rows = made_rows(7) + [(None, made_rows(7)[0][1]), (None, "q" * 60), (None, "q" * 60)]
    got = Counter(tuple(r) for r in suffix_dedup(table(spark, rows).repartition(5), 50).collect())
    assert got == bytes_expected(rows, 50)


def test_suffix_dedup_whole_table(spark, sf_small):
    from tidecopy.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op9_suffix_dedup"](spark, sf_small).collect())
    assert got == bytes_expected(rows, 50)


def regions_of(rnd, n, passages):
    import numpy as np
    texts = [rnd.choice(passages)[rnd.randrange(40):][:rnd.randrange(60, 200)] for _ in range(n)]
    return texts, np.array([rnd.randrange(n // 3) for _ in texts], dtype=np.uint64)


def test_equal_strings_of_a_block_are_sent_for_the_least_document_only(monkeypatch):
    import numpy as np
    from tidecopy.llm import suffix_dedup as module
    rnd = random.Random(3)
    texts, doc = regions_of(rnd, 300, [bytes(rnd.choices(b"abcd", k=260)) for _ in range(12)])
    least = {}
    for t, d in zip(texts, doc.tolist()):
        for k in range(len(t) - 49):
            least[t[k:k + 50]] = min(least.get(t[k:k + 50], d), d)
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    data = np.frombuffer(b"".join(texts), np.uint8)
    expected = [least[t[k:k + 50]] == d for t, d in zip(texts, doc.tolist()) for k in range(len(t) - 49)]
    assert module.least_docs(data, off, doc, 50)[1].tolist() == expected
    wide = module.window_hashes      # different strings of one hash are told apart by their bytes
    monkeypatch.setattr(module, "window_hashes", lambda codes, n: (wide(codes, n) % np.uint64(97)) << np.uint64(50))
    assert module.least_docs(data, off, doc, 50)[1].tolist() == expected
    monkeypatch.undo()
    n = np.arange(len(texts))
    (k1, _, doc2, first, size, kept), gone = module._least_regions(
        [n, n, doc, np.zeros(len(n), "<i4"), np.diff(off).astype("<i4"), data], 50)
    assert len(kept) == size.sum() < len(data) / 2
    cut = np.concatenate([[0], np.cumsum(size)])
    for r, d, f, a, b in zip(k1, doc2, first, cut, cut[1:]):
        t = kept[a:b].tobytes()
        assert t == texts[r][f:f + b - a] and all(least[t[k:k + 50]] == d for k in range(len(t) - 49))
    masks = [bytearray(len(t)) for t in texts]
    for r, _, f, m in zip(*gone):
        masks[r][f:f + m] = b"\1" * m
    for t, d, m in zip(texts, doc.tolist(), masks):
        want = bytearray(len(t))
        for k in range(len(t) - 49):
            if least[t[k:k + 50]] < d:
                want[k:k + 50] = b"\1" * 50
        assert m == want


def test_blocks_and_names_of_suffix_dedup(monkeypatch):
    import numpy as np
    import pyarrow as pa
    from tidecopy.llm import suffix_dedup as module
    rnd = random.Random(5)
    texts, doc = regions_of(rnd, 400, [bytes(rnd.choices(b"abcd", k=260)) for _ in range(40)])
    monkeypatch.setattr(module, "BLOCK", 4096)      # several blocks, some filled in rounds
    n = list(range(len(texts)))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(n), pa.array(n), pa.array(doc.astype(np.int64)), pa.array([0] * len(n), pa.int32()), pa.array(n), pa.array(texts, pa.binary())],
        ["k1", "k2", "doc", "first", "family", "bytes"])
    rows = [r for b in module._region_blocks(50)([batch.slice(0, 150), batch.slice(150)]) for r in b.to_pylist()]
    assert len(rows) > 1 and sum(len(r["data"]) for r in rows) < sum(map(len, texts))
    plan = module.Plan(50, 1, "<u4", "<u8", 0)
    sent = [b for r in rows for b in module._send("char", plan)([pa.RecordBatch.from_pylist([r])])]
    table = pa.Table.from_batches(sent)
    back = module._answer("char", plan)((pa.scalar(0),), table).to_pylist()
    keys = [[x["x"][k:k + 8] + x["x"][len(x["x"]) // 2 + k:][:8] for k in range(0, len(x["x"]) // 2, 8)] for x in table.to_pylist()]
    blocks = Counter(k for x in keys for k in x)      # a block sends a key once
    names = {}
    for x, y in zip(keys, back):
        for k, name in zip(x, np.frombuffer(y["y"], "<u4").tolist()):
            assert (name == 0) == (blocks[k] == 1) and names.setdefault(k, name) == name
    some = [v for v in names.values() if v]
    assert some and len(set(some)) == len(some)


def test_names_are_looked_up_without_the_keys(monkeypatch):
    import numpy as np
    from tidecopy.llm import suffix_dedup as module
    rnd = random.Random(7)
    texts, doc = regions_of(rnd, 60, [bytes(rnd.choices(b"abcd", k=260)) for _ in range(9)])
    plan = module.Plan(50, 3, "<u4", "<u8", 0)
    row = {"blk": 1, "data": b"".join(texts), "size": np.array([len(t) for t in texts], "<i4").tobytes(), "doc": doc.astype("<u8").tobytes()}
    b = module.Block({**row, "a_char": None}, plan)
    (_, at, keys), = b.keys("char")
    k = module.Keyed(keys, plan.buckets)
    assert (k.keys.take(k.slot, axis=0) == keys).all() and len(np.unique(k.keys, axis=0)) == len(k.keys)
    low = np.array([rnd.randrange(100) for _ in at], dtype=np.uint64)
    assert k.least(low).tolist() == [low[k.slot == i].min() for i in range(len(k.keys))]
    names = np.arange(1, len(k.keys) + 1).astype("<u4")
    row["a_char"] = [{"bucket": i, "y": names[k.cut[i]:k.cut[i + 1]].tobytes()} for i in range(3)]
    want = np.zeros(len(row["data"]), np.uint64)
    want[at] = names[k.slot]

    def taken(self):
        raise AssertionError("rows of keys were moved")

    monkeypatch.setattr(module.Keyed, "keys", property(taken))
    assert (module.Block(row, plan).names("char") == want).all()


def test_equal_strings_and_spans_of_names():
    import numpy as np
    from tidecopy.llm import suffix_dedup as module
    from tidecopy.llm._text import grouped
    rng = np.random.default_rng(11)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[2000:2400] = data[500:900]
    for two in (np.arange(400, 700), np.array([500, 501, 502, 40, 41, 506])):
        one = np.arange(1900, 1900 + len(two))
        got = module._same_strings(data, one, two, 50)
        assert got.tolist() == [data[a:a + 50].tobytes() == data[b:b + 50].tobytes() for a, b in zip(one, two)]
    one = np.arange(2000, 2351)       # one run, all the same
    assert module._same_strings(data, one, one - 1500, 50).all()
    changed = data.copy()
    changed[2399] ^= 1                # the last byte of the last string
    assert module._same_strings(changed, one, one - 1500, 50).tolist() == [True] * 350 + [False]
    for n in (0, 5, 31, 200):
        mask = rng.random(n) < 0.9
        want = [all(i + k < n and mask[i + k] for k in range(0, 31, 3)) for i in range(n)]
        assert module._every_third(mask, 11).tolist() == want
    keys = rng.integers(0, 40, (3000, 2)).astype(np.uint64)
    # hashes that name the key, and such that differ in their lowest bits only
    for h in ((keys[:, 0] * np.uint64(64) + keys[:, 1]) << np.uint64(50), keys[:, 0] * np.uint64(64) + keys[:, 1]):
        order, head = grouped(h, keys)
        assert sorted(order) == list(range(3000)) and head.sum() == len(np.unique(keys, axis=0))
        assert (head[1:] == (keys[order][1:] != keys[order][:-1]).any(axis=1)).all()


def test_empty_and_unique_tables(spark):
    for f in (lambda d: substring_dedup(d, 35), lambda d: suffix_dedup(d, 50)):
        assert f(table(spark, [])).collect() == []
        assert [r.n_removed for r in f(table(spark, [(1, "only one text here " * 1), (2, None)])).collect()] == [0, 0]
