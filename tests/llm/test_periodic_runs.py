"""Runs of words against a quadratic search, on texts made to be hard, and the query's digests."""

import hashlib
import random
import re
import zlib

import numpy as np

from tidecopy.llm._text import U64, mix
from tidecopy.llm.periodic_runs import find_runs, periodic_runs
from tidecopy.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t, least=12):
    out = []
    for p in range(1, len(t) // 2 + 1):
        i = 0
        while i + p < len(t):
            if t[i] != t[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(t) and t[j] == t[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p) and not any(
                    t[i:j + p - q] == t[i + q:j + p] for q in range(1, p) if p % q == 0):
                out.append((i, j + p - i, p))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def check(texts, least=12):
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    codes = mix(np.array([c for t in texts for c in t], dtype=np.int64).astype(U64) * U64(0x9E3779B97F4A7C15))
    want = [(s + o, s + n + o, p) for t, o in zip(texts, off.tolist()) for s, n, p in brute(t, least)]
    assert [tuple(r) for r in find_runs(codes, off, least).tolist()] == want


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    return [bin(i).count("1") & 1 for i in range(n)]


def test_words_of_theory():
    check([fibonacci(350)])
    check([thue_morse(1500), thue_morse(64) * 5, fibonacci(34) * 4, [0] * 500, [0] * 11, [0] * 12, [], [3]])


def random_text(rnd):
    kind, n, letters = rnd.random(), rnd.randint(0, 150), rnd.choice([1, 2, 3, 5, 50])
    if kind < 0.3:
        return [rnd.randrange(letters) for _ in range(n)]
    if kind < 0.6:      # repeats of roots, some of them themselves nearly periodic
        t = []
        while len(t) < n:
            root = [rnd.randrange(letters) for _ in range(rnd.randint(1, 40))]
            if rnd.random() < 0.5:
                m = rnd.randint(5, 40)
                root = ([rnd.randrange(2) for _ in range(rnd.randint(1, 4))] * m)[:m]
            t += (root * 6)[:int(len(root) * rnd.uniform(0.5, 5))]
        return t
    if kind < 0.8:      # two runs of one small period that touch
        u = [rnd.randrange(2) for _ in range(rnd.randint(1, 3))]
        a, b = (u * 60)[:rnd.randint(9, 60)], ((u[1:] + u[:1]) * 60)[:rnd.randint(9, 60)]
        return [0, 1][:rnd.randint(0, 2)] + a + b + (a if rnd.random() < 0.5 else [])
    t = fibonacci(rnd.randint(1, 200)) if rnd.random() < 0.5 else thue_morse(rnd.randint(1, 200))
    for _ in range(rnd.randint(0, 3)):
        t[rnd.randrange(len(t))] = rnd.randrange(3)
    return t


def test_random_texts():
    rnd = random.Random(11)
    for _ in range(60):
        check([[1], *(random_text(rnd) for _ in range(rnd.randint(1, 6)))], rnd.choice([12, 12, 4]))


def collapse(words, runs):
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def as_rows(df):
    return sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in df.collect()), key=str)


def test_odd_rows(spark):
    unit = "é 😀 c "
    texts = [None, "", " \n\t", "a " * 11, "a " * 12, unit * 5, "x y " * 30, "p q" * 1, ("a b " * 8 + "a ") * 3, "word"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, unit * 6)] + [(99, "z " * 40)] * 4
    want = []
    for i, t in rows:
        words = WORD.findall(t or "")
        want.append((i, len(words), brute(words), collapse(words, brute(words))))
    docs = spark.createDataFrame([(i, t, "clash", 5) for i, t in rows], "doc_id long, text string, runs string, n_words int")
    assert as_rows(periodic_runs(docs.repartition(3))) == sorted(want, key=str)
    assert periodic_runs(docs.where("doc_id = -5")).collect() == []


def test_very_long_texts(spark):
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(150_000)]
    root = words[:7000]
    text = words + ["|"] + root * 3 + root[:100] + ["|"] + ["a"] * 50_000
    # the period is found at the ninth scale; the runs before and after touch nothing
    (row,) = periodic_runs(spark.createDataFrame([(1, "\n".join(text))], "doc_id long, text string")).collect()
    assert [tuple(r) for r in row.runs] == [(150_001, 21_100, 7000), (171_102, 50_000, 1)]
    assert row.collapsed.split() == words + ["|"] + root + ["|", "a"]


def test_query_on_the_whole_table(spark, sf_mid):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{sf_mid}/documents.parquet").collect():
        words, h = WORD.findall(r.text or ""), zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n <= 1500 or h % 10 == 0:
            runs = brute(words)
        else:
            runs = None      # the quadratic search takes too long on these; they must still have a row
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None) if runs is not None else None
        want.append((r.doc_id, None if runs is None else (
            len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{k},{p}\n" for s, k, p in runs)), sha(collapse(words, runs)))))
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op13_periodic_runs"](spark, sf_mid).collect()}
    assert len(got) == len(want) and sum(v[0] > 0 for v in got.values()) > 50
    for i, w in want:
        assert w is None or got[i] == w
