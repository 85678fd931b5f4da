"""Mixing, sharding, quality, chat and decontamination on odd rows and whole tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tidecopy.llm.chat import chat_digests, chat_windows, read_windows
from tidecopy.llm.decontaminate import Budget, drop_leaking, leaks
from tidecopy.llm.mixing import mix_rows, mix_sources
from tidecopy.llm.quality import QualityLimits, keep_good, quality_rules
from tidecopy.llm.queries import QUERIES
from tidecopy.llm.sharding import kd_shards

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    """rows: (id, text, source); the other columns' names clash with results'."""
    return spark.createDataFrame([(i, t, s, "en", 1, 2.0, "x", 3) for i, t, s in rows],
                                 "doc_id long, text string, source string, lang string, size int, target double, shard string, n_words int")


# ------------------------------------------------------------- mixing

def water_fill(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = rest / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in open_}
        for s in over:
            target[s] = float(cap * sizes[s])
        rest -= sum(target[s] for s in over)
        open_ -= over
    return target


def check_mix(rows, got):
    size = lambda t: len(WORD.findall(t or ""))
    totals, largest = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        totals[s] += size(t)
        largest[s] = max(largest[s], size(t))
    target = water_fill(totals)
    by_id = {i: s for i, _, s in rows}
    taken = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        s = by_id[r.doc_id]
        assert r.source_size == totals[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    for s in totals:
        assert abs(taken[s] - target[s]) <= largest[s]
    return totals, target


def test_mix_whole_table(spark, sf_mid):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_mid}/documents.parquet").collect()]
    first = QUERIES["op1_mix_sources"](spark, sf_mid).collect()
    check_mix(rows, first)
    assert sorted(map(tuple, first)) == sorted(map(tuple, QUERIES["op1_mix_sources"](spark, sf_mid).collect()))


def test_mix_odd_rows(spark):
    rnd = random.Random(2)
    rows = [(i, "w " * rnd.randint(0, 30), rnd.choice(["a", "b", "b", "b", "é", "Z", None])) for i in range(400)]
    rows += [(1000, None, "only null"), (1001, "", "é"), (1002, "w " * 4000, "big"), (1003, "tiny", "t")]
    check_mix(rows, mix_sources(docs(spark, rows).repartition(4)).collect())
    assert mix_sources(docs(spark, [])).collect() == []
    assert [(r.target, r.taken) for r in mix_sources(docs(spark, [(1, None, None), (2, "", "a")])).collect()] == [(0.0, 0)] * 2
    # rows that agree in id and text are taken together
    same = [(5, "a b c", "s")] * 6 + [(i, "x y z", "s") for i in range(20, 40)] + [(i, "o p", "r") for i in range(40, 60)]
    taken = {r.taken for r in mix_sources(docs(spark, same)).where("doc_id = 5").collect()}
    assert len(taken) == 1


def test_mix_rows_repeats_what_mix_sources_takes(spark, sf_small):
    d = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = mix_rows(d)
    assert out.columns == d.columns
    times = Counter(r.doc_id for r in out.collect())
    for r in mix_sources(d).collect():
        assert times[r.doc_id] == r.copies


# ------------------------------------------------------------- sharding

def check_shards(rows, got, n):
    assert len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots, load = defaultdict(list), defaultdict(int)
    for r in got:
        assert 0 <= r.shard < n and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load


@pytest.mark.parametrize("n", [1, 5, 16])
def test_shards_odd_rows(spark, n):
    rnd = random.Random(n)
    rows = [(i, "x" * rnd.randint(0, 200), rnd.choice(["a", None, "", "é" * 20])) for i in range(3000)]
    rows += [(9000 + i, "copy of a page " * 5, rnd.choice(["a", "b"])) for i in range(2000)]      # a hot text
    rows += [(None, None, None), (None, None, None), (1, "", "a"), (1, "", "a")]
    load = check_shards(rows, kd_shards(docs(spark, rows).repartition(6), n).collect(), n)
    assert len(load) == n and max(load.values()) <= 1.1 * min(load.values())


def test_shards_whole_table(spark, sf_mid):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_mid}/documents.parquet").collect()]
    got = QUERIES["op7_kd_shards"](spark, sf_mid).collect()
    load = check_shards(rows, got, 16)
    assert max(load.values()) <= 1.1 * min(load.values())
    assert kd_shards(docs(spark, [])).collect() == []


def test_shards_tell_sources_with_a_long_common_prefix_apart(spark):
    names = [f"https://www.example.org/a/very/long/path/site{i:02d}" for i in range(50)]
    rows = [(i, f"{i:08d}", names[i % 50]) for i in range(4000)]          # texts of one size, one language
    got = kd_shards(docs(spark, rows).repartition(5), 8).collect()
    load = check_shards(rows, got, 8)
    assert max(load.values()) <= 1.1 * min(load.values())
    # cuts lie between sources, or inside one: 7 cuts divide at most 7 sources
    assert len({(names[r.doc_id % 50], r.shard) for r in got}) <= 50 + 7


def test_shards_repeated_rows(spark):
    """Rows that share id and text, a third of the bytes, are spread as other copies are."""
    rnd = random.Random(21)
    rows = [(i, "x" * rnd.randint(0, 200), rnd.choice("abc")) for i in range(3000)]
    rows += [(None, "copy of a page " * 5, rnd.choice("ab")) for _ in range(1200)] + [(7, "again " * 12, "a")] * 900
    d = docs(spark, rows)
    got = [kd_shards(d.repartition(n), 16).collect() for n in (6, 3)]
    load = check_shards(rows, got[0], 16)
    assert len(load) == 16 and max(load.values()) <= 1.1 * min(load.values())
    assert Counter((r.doc_id, r.text_crc32, r.shard) for r in got[0]) == Counter((r.doc_id, r.text_crc32, r.shard) for r in got[1])


# ------------------------------------------------------------- quality

def brute_quality(t, limits=QualityLimits()):
    t = t or ""
    w = WORD.findall(t)
    n = len(w)

    def spans(k):
        c = Counter(tuple(w[i:i + k]) for i in range(n - k + 1))
        return len({j for i in range(n - k + 1) if c[tuple(w[i:i + k])] > 1 for j in range(i, i + k)})

    best = 0
    for k in range(5, n):
        if len({tuple(w[i:i + k]) for i in range(n - k + 1)}) == n - k + 1:
            break
        best = k
    lines = [x for x in t.split("\n") if WORD.search(x)]
    base = n < limits.min_words or 100 * spans(5) > 20 * n
    long_words = spans(limits.long_repeat)
    kept = not (base or (100 * long_words > limits.max_long_percent * n and long_words > limits.long_floor)
                or (100 * best > limits.max_longest_percent * n and best > limits.longest_floor) or best > limits.max_longest)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), spans(5),
            spans(limits.long_repeat), best, base, kept)


def test_quality_odd_rows(spark):
    rnd = random.Random(3)
    parts = ["a ", "b ", "c d ", "é\n", "a b c d e f g ", "\n", "x#|", "世界 ", "  ", "a b\n", "\r\n", "\xa0", "\x0b", "Zz "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 80))) for _ in range(600)]
    unique = " ".join(f"w{i}" for i in range(900))
    long_ = " ".join(f"w{i}" for i in range(130))
    texts += [None, "", " \n", "same " * 50, unique, unique + " " + long_, "one " * 9, " ".join("abcdefghij")]
    got = quality_rules(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]).repartition(3)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: brute_quality(t) for i, t in enumerate(texts)}
    assert quality_rules(docs(spark, [])).collect() == []


def test_quality_limits_on_both_sides(spark):
    """Texts of k words twice in n words in all: every limit beyond the base rules, just below and above it."""
    def text(k, n, copies=2):
        again = " ".join(f"again{i}" for i in range(k))
        fill = iter(f"w{i}" for i in range(n - copies * k))
        return " ".join([" ".join([next(fill), again]) for _ in range(copies)] + list(fill))

    cases = {
        (20, 500): True, (21, 500): False,     # longest: over 4 % of the words and over 20
        (20, 300): True, (21, 526): True,      # 21 of 526 words is under 4 %
        (120, 3001): True, (121, 3100): False, # longest: over 120 words
        (12, 479, 4): False, (12, 481, 4): True,  # in repeats: 48 words, 10 % of them 479 or 481
        (10, 300, 4): True, (11, 300, 4): False,  # 40 words in repeats are the floor
        (9, 300, 4): True,                     # no repeat of 10 words
    }
    texts = [text(*c) for c in cases]
    got = quality_rules(docs(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()
    rows = {r.doc_id: tuple(r)[1:] for r in got}
    assert rows == {i: brute_quality(t) for i, t in enumerate(texts)}
    assert not any(r.base_failed for r in got)
    assert {c: rows[i][-1] for i, c in enumerate(cases)} == cases


def test_quality_whole_table(spark, sf_small):
    d = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op10_quality_rules"](spark, sf_small).collect()}
    assert got == {r.doc_id: brute_quality(r.text) for r in d.collect()}
    kept = keep_good(d)
    assert kept.schema == d.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, v in got.items() if v[-1]}


def test_quality_long_repeats_reject(spark):
    """Texts that pass the base rules and fail by each limit of long repeats alone."""
    def text(n, *passages):
        """n words; each passage, of so many words, stands twice."""
        said = [[f"p{k}x{i}" for i in range(m)] for k, m in enumerate(passages)] * 2
        fresh = iter(f"w{i}" for i in range(n))
        out = [w for p in said for w in [*p, next(fresh)]]
        return " ".join(out + [next(fresh) for _ in range(n - len(out))])

    cases = {"one passage of 95 words in 1,000": (text(1000, 95), False),
             "fraction alone": (text(600, 10, 10, 10, 10), False), "longest alone": (text(600, 26), False),
             "longest at all": (text(4000, 121), False), "longest allowed": (text(4000, 120), True),
             "at the fraction": (text(600, 10, 10, 10), True), "at the share": (text(600, 24), True),
             "a sentence twice": (text(110, 10), True), "two sentences twice": (text(210, 10, 10), True)}
    got = {r.doc_id: r for r in quality_rules(docs(spark, [(i, t, "s") for i, (t, _) in enumerate(cases.values())])).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {n: got[i].kept for i, n in enumerate(cases)} == {n: keep for n, (_, keep) in cases.items()}
    limits = QualityLimits()
    fraction, longest = got[1], got[2]
    assert 100 * fraction.longest_repeat <= limits.max_longest_percent * fraction.n_words
    assert 100 * longest.n_long_words <= limits.max_long_percent * longest.n_words


# ------------------------------------------------------------- chat

def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, window string, idx int")


def expected_chat(rows):
    import hashlib
    by = defaultdict(list)
    for c, n, r, t in rows:
        by[c].append((n if n is not None else -10**9, r or "", t or ""))
    out = {}
    for c, v in by.items():
        v.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in v)
        learnt = "".join(t for _, r, t in v if r == "assistant")
        out[c] = (len(v), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return out


def odd_conversations():
    rnd = random.Random(5)
    parts = ["</s>", "<s>[INST]", "[/INST]", "\\", "\\b", "\\l", "[", "<", "ok ", "word ", "é", "😀", "\n", "\\s[", "$1 ", ""]
    rows = []
    for c in range(60):
        if rnd.random() < 0.5:
            rows.append((c, 0, "system", "be kind " * rnd.randint(0, 9)))
        for k in range(rnd.randint(1, 25)):
            rows.append((c, k + 1, rnd.choice(["user", "assistant", "assistant", "tool", "ro[le</s>"]),
                         "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60)))))
    rows += [(100, 0, None, None), (100, 1, "assistant", None), (100, None, "user", "x"), (101, 0, "system", "alone"),
             (102, 1, "assistant", "w " * 5000), (102, 1, "assistant", "w " * 5000), (103, 5, "assistant", "tie"), (103, 5, "assistant", "a tie")]
    return rows


def test_chat_odd_rows(spark):
    rows = odd_conversations()
    got = {r.conv_id: tuple(r)[1:5] for r in chat_digests(turns(spark, rows), budget=64, history_turns=2, history_tokens=16).collect()}
    assert got == expected_chat(rows)
    assert chat_digests(turns(spark, [])).collect() == []


def test_chat_windows_keep_the_budget(spark):
    rows = odd_conversations()
    budget, history = 64, 16
    tokens = lambda t: len(WORD.findall(t)) + 4
    windows = chat_windows(turns(spark, rows), budget=budget, history_turns=2, history_tokens=history)
    firsts = {(r.conv_id): r for r in turns(spark, rows).where("turn = 0 AND role = 'system'").collect()}
    for r in read_windows(windows).collect():
        size = sum(map(tokens, r.texts))
        system = tokens(firsts[r.conv_id].text or "") if r.conv_id in firsts else 0
        body = size - (system if r.conv_id in firsts and r.window == 0 else 0)
        assert body <= max(1, budget - history - system) or sum(1 for x in r.roles if x != "system") == 1
    for r in windows.collect():
        if r.conv_id in firsts:
            assert r.text.startswith("<s>[INST]system[/INST]")


# ------------------------------------------------------------- decontamination

def edited(rnd, text, rate):
    p = list(text)
    for _ in range(int(len(p) * rate)):
        j, r = rnd.randrange(len(p)), rnd.random()
        p[j:j + 1] = [["x"], [], [p[j], "q"]][int(r * 3)]
    return "".join(p)


def test_leaks_planted(spark, sf_small):
    rnd = random.Random(6)
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    say = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(n))
    rows, want = [], set()
    for k in range(90):
        item, text = items[k % len(items)]
        t = say(rnd.randint(0, 200))
        if k % 3 == 0:
            t += " " + text + " " + say(5)
        elif k % 3 == 1:
            t += "\n" + edited(rnd, text, 0.03).translate({c: c - 32 for c in range(97, 123)}).replace(" ", " \n ") + say(100)
        if k % 3 < 2:
            want.add((k, item))
        rows.append((k, t, "s"))
    rows += [(500, None, "s"), (501, "", "s"), (502, items[0][1], "s"), (502, items[0][1], "s"), (503, items[1][1][:30], "s")]
    want.add((502, items[0][0]))
    d = docs(spark, rows).repartition(4)
    got = {(r.doc_id, r.item_id) for r in leaks(d, bench).collect()}
    assert want <= got
    assert {i for i, _ in got} == {i for i, _ in want}            # clean documents stay out
    kept = drop_leaking(d, bench)
    assert kept.columns == d.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _, _ in rows if i not in {w for w, _ in want})
    odd = spark.createDataFrame([(None, "x" * 90), (1, None), (2, ""), (3, "short")], "item_id long, text string")
    assert leaks(d, odd).collect() == [] and leaks(docs(spark, []), bench).collect() == [] and leaks(d, odd.limit(0)).collect() == []
    assert drop_leaking(d, odd.limit(0)).count() == len(rows)


def semi_global(p, t):
    """Least edits between p and any substring of t."""
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        new = [i]
        for j, b in enumerate(t, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks_against_plain_alignment(spark):
    """Every segment within its budget is found, no other."""
    from tidecopy.llm.decontaminate import Index, normalise, search
    import numpy as np
    rnd = random.Random(8)
    budget = Budget(q=5, segment=40, stride=20, rate=0.12, least=30)
    say = lambda n: " ".join(rnd.choice(["tion", "the", "of", "ening", "Er", "wh"]) for _ in range(n))
    items = [(i, say(14).encode()) for i in range(6)]
    ix = Index(items, budget)
    texts = [say(5) + " " + edited(rnd, rnd.choice(items)[1].decode(), rnd.choice([0, 0.05, 0.1, 0.15, 0.25])) + " " + say(8) for _ in range(60)]
    raw = [t.encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    doc, seg, edits = search(ix, data, off)
    got = {}
    for d, s, e in zip(doc.tolist(), seg.tolist(), edits.tolist()):
        got[d, s] = min(e, got.get((d, s), 99))
    want = {}
    for d, t in enumerate(raw):
        low = normalise(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0].tobytes()
        for s in range(len(ix.m)):
            e = semi_global(ix.letters[s, :ix.m[s]].tobytes(), low)
            if e <= ix.e[s]:
                want[d, s] = e
    assert got == want and len(want) > 30


def test_leaks_whole_table(spark, sf_mid):
    norm = lambda t: re.sub(r"[ \t-\r]+", " ", t.translate({c: c + 32 for c in range(65, 91)}))
    bench = {r.item_id: norm(r.text).strip() for r in spark.read.parquet(f"{sf_mid}/benchmark.parquet").collect()}
    exact = {(r.doc_id, i) for r in spark.read.parquet(f"{sf_mid}/documents.parquet").collect()
             for i, t in bench.items() if t in norm(r.text or "")}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op4_decontaminate"](spark, sf_mid).collect()}
    assert exact <= got and len(got - exact) <= len(exact) // 5


def test_leaks_in_blocks(spark, monkeypatch):
    """Blocks are bounded, an item over a block's size too, and one is broadcast at a time."""
    from tidecopy.llm import decontaminate as module
    rnd = random.Random(12)
    say = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(n))
    items = [(i, say(30)) for i in range(20)] + [(50, say(2000)), (1, say(40))]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    rows = [(i, say(20) + " " + t[-400:] + " " + say(20), "s") for i, (_, t) in enumerate(items)] + [(99, say(60), "s")]
    d = docs(spark, rows)
    want = sorted(tuple(r) for r in leaks(d, bench).collect())
    sizes, sent, blocks, broadcast = [], [], module._blocks, spark.sparkContext.broadcast

    def watched(*a):
        for ix in blocks(*a):
            sizes.append(int(ix.m.sum()))
            yield ix

    def one(value):
        assert not any(b._jbroadcast.isValid() for b in sent)
        sent.append(broadcast(value))
        return sent[-1]

    monkeypatch.setattr(module, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(module, "_blocks", watched)
    monkeypatch.setattr(spark.sparkContext, "broadcast", one)
    assert sorted(tuple(r) for r in leaks(d, bench).collect()) == want
    assert len({r[0] for r in want}) == len(items) and len(sizes) > 5 and max(sizes) <= 4000


def test_leaks_items_without_an_id(spark):
    rnd = random.Random(13)
    say = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(n))
    items = [(None, say(40)), (None, say(40)), (3, say(40)), (None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, say(20) + " " + (t or "") + " " + say(20), "s") for i, (_, t) in enumerate(items)]
    assert {(r.doc_id, r.item_id) for r in leaks(docs(spark, rows), bench).collect()} == {(0, None), (1, None), (2, 3)}
    assert [r.doc_id for r in drop_leaking(docs(spark, rows), bench).collect()] == [3]


def test_leaks_guaranteed_quote(spark):
    """A quote of segment + stride - 1 bytes is found wherever it begins."""
    from tidecopy.llm.decontaminate import Index, search
    import numpy as np
    rnd, budget = random.Random(14), Budget()
    item = "".join(rnd.choice("abcdefgh") for _ in range(700))
    n = budget.segment + budget.stride - 1
    texts = [("zz " + item[a:a + n] + " zz").encode() for a in range(len(item) - n + 1)]
    off = np.cumsum([0, *map(len, texts)])
    found = search(Index([(1, item.encode())], budget), np.frombuffer(b"".join(texts), np.uint8), off)[0]
    assert set(found.tolist()) == set(range(len(texts)))
