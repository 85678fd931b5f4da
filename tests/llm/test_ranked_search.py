"""Ranked search against scoring every document, on small fixtures and whole tables."""

import math
import random
import re
from collections import Counter

import numpy as np

from tidecopy.llm import ranked_search
from tidecopy.llm.ranked_search import Block, SearchIndex, build_block, build_index, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(i, Counter(found(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in set(found(text)) if df[t]}
        scores = []
        for (i, bag), size in zip(bags, sizes):
            m = 10 + (90 * size * n) // max(1, total)
            score = sum(x * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t, x in w.items() if t in bag)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(rnd, n, vocabulary, longest):
    words = [f"W{i}" if i % 3 else f"é{i}" for i in range(vocabulary)]
    return [(i, " ".join(words[min(int(rnd.paretovariate(0.6)) - 1, vocabulary - 1)] for _ in range(rnd.randint(0, longest)))) for i in range(n)]


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, rank int, score string, row int"),
            spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id int"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_blocks_keep_their_postings():
    rnd = np.random.default_rng(1)
    for n_docs, n_terms, n in ((1, 1, 1), (1, 300, 120), (200, 1, 150), (40, 700, 3000)):
        pair = np.unique(rnd.integers(0, n_docs * n_terms, n))
        doc, term = pair // n_terms, (pair % n_terms).astype(np.uint64) * np.uint64(2**57 + 13)
        impact = rnd.integers(1, 10**6, len(pair))
        stored, columns = build_block(doc, term, impact, n_docs)
        block = Block(stored)
        want = dict(zip(zip(doc.tolist(), term.tolist()), impact.tolist()))
        got = {}
        for t in np.unique(term).tolist():
            has, r = block.rows_of(np.array([t], dtype=np.uint64))
            for c, s in zip(*(x.tolist() for x in block.search(r, np.ones(len(r), np.int64), n_docs + 1, 1))):
                got[int(columns[c]), t] = s
        assert got == want


def test_small_corpora(spark, monkeypatch):
    rnd = random.Random(7)
    docs = corpus(rnd, 300, 400, 60)
    docs += [(1000 + i, docs[5][1]) for i in range(120)] + [(2, "W1 W2 é0 w1"), (2, "W1 W2 é0 w1"), (None, docs[5][1]), (None, None), (9, "")]
    items = [(i, " ".join(t.split()[:rnd.randint(0, 30)])) for i, t in docs[:40]] + [(None, "W1"), (3, "W1"), (3, "W1"), (77, "absent"), (78, None)]
    items += [(79, docs[5][1]), (80, " ".join(f"W{i}" for i in range(400)))]
    d, i = frames(spark, docs, items)
    for postings, terms_a_pass, k in ((1 << 20, 1 << 20, 10), (60, 100, 10), (500, 1 << 20, 1)):
        monkeypatch.setattr(ranked_search, "ITEM_TERMS", terms_a_pass)
        assert rows(search(build_index(d.repartition(4), block_postings=postings), i, k)) == brute(docs, items, k)


def test_empty_tables_and_reopening(spark, tmp_path):
    docs, items = [(1, "a b"), (2, "a"), (3, "c")], [(1, "A"), (2, "zz")]
    d, i = frames(spark, docs, items)
    index = build_index(d, str(tmp_path / "index"))
    again = SearchIndex(spark, str(tmp_path / "index"))
    assert (again.n_docs, again.n_terms) == (index.n_docs, index.n_terms) == (3, 4)
    assert rows(search(again, i)) == brute(docs, items, 10)
    assert rows(search(again, i.where("item_id > 5"))) == []
    assert rows(search(build_index(d.where("doc_id > 5")), i)) == []


def test_very_long_texts(spark):
    long = " ".join(f"t{i % 70_000}" for i in range(200_000))
    docs, items = [(1, long), (2, "t5 t6"), (3, "x" * 300_000 + " t7"), (4, long)], [(1, "t5 t7"), (2, long[:9000]), (3, "x" * 300_000)]
    d, i = frames(spark, docs, items)
    assert rows(search(build_index(d), i)) == brute(docs, items, 10)


def test_query_matches_its_sql_on_a_whole_table(spark, sf_mid):
    import duckdb

    from tidecopy.llm.queries import ORACLES, QUERIES
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_mid}/{t}.parquet'")
    got, want = QUERIES["op12_ranked_search"](spark, sf_mid), con.sql(ORACLES["op12_ranked_search"])
    order = [want.columns.index(c) for c in got.columns]
    assert rows(got) == sorted((tuple(r[j] for j in order) for r in want.fetchall()), key=str)
