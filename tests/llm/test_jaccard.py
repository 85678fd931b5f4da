"""Near-duplicates against all pairs, and components."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tidecopy.llm._store import Stage
from tidecopy.llm.components import components
from tidecopy.llm.jaccard_join import jaccard_join, keep_one
from tidecopy.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(t, k):
    w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])


def brute(rows, k, percent):
    """Per row: n_shingles and the row numbers' component."""
    sets = [shingles(t, k) for _, t in rows]
    holds = defaultdict(list)
    links = []
    for i, s in enumerate(sets):
        both = Counter(j for g in s for j in holds[g])
        links += [(i, j) for j, c in both.items() if 100 * c >= percent * (len(s) + len(sets[j]) - c)]
        for g in s:
            holds[g].append(i)
    return sets, roots(range(len(rows)), links)


def expected(rows, k, percent):
    sets, comp = brute(rows, k, percent)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[comp[n]] = min(i, least.get(comp[n], i))
    return Counter((i, len(sets[n]), least.get(comp[n]) if sets[n] else i) for n, (i, _) in enumerate(rows))


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, 1, "k", "g") for i, t in rows],
                                 "doc_id long, text string, n int, k1 int, label string, component string")


def family_rows(seed=1):
    """Chains of edits, so many pairs lie close to the threshold; copies; short and empty texts."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(8):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(30, 120))]
        for _ in range(25):
            words = list(words)
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            rows.append(" ".join(words).upper() if rnd.random() < 0.2 else "\n".join(words))
    rows += [rows[0]] * 60 + ["of the and to"] * 3 + ["of the and", "Of The\tand", "", None, " \n", "a b c d e", "b c d e a"]
    boiler = " ".join(f"b{i}" for i in range(12))
    rows += [boiler + " " + " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 40))) for _ in range(80)]
    ids = list(range(len(rows)))
    rnd.shuffle(ids)
    out = list(zip(ids, rows))
    return out + [(None, rows[3]), (None, "no id at all"), (7, "of the and to"), (7, "of the and to"), (9, rows[30])]


@pytest.mark.parametrize("k,percent,seed", [(4, 85, 1)])
def test_families(spark, k, percent, seed):
    rows = family_rows(seed)
    got = Counter(tuple(r) for r in jaccard_join(table(spark, rows).repartition(7), k=k, percent=percent).collect())
    assert got == expected(rows, k, percent)


def test_small_groups_open_one_another(spark, monkeypatch):
    """Without the rounds of hubs every link comes through the matrix."""
    from tidecopy.llm import jaccard_join as module
    rows = family_rows(3)
    for rounds, group in ((0, 3),):
        monkeypatch.setattr(module, "ROUNDS", rounds)
        monkeypatch.setattr(module, "GROUP", group)
        got = Counter(tuple(r) for r in jaccard_join(table(spark, rows).repartition(3)).collect())
        assert got == expected(rows, 4, 85)


def test_whole_table(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op5_jaccard_join"](spark, sf_small).collect())
    assert got == expected(rows, 4, 85)


def test_empty_tables(spark):
    assert jaccard_join(table(spark, [])).collect() == []
    assert [tuple(r) for r in jaccard_join(table(spark, [(4, None)])).collect()] == [(4, 0, 4)]
    assert keep_one(table(spark, [])).collect() == []


def test_keep_one_of_each(spark):
    rows = [(i, t) for i, t in family_rows(4) if i is not None]
    d = table(spark, rows)
    kept = keep_one(d)
    assert kept.columns == d.columns
    sets, comp = brute(rows, 5, 80)
    least = {}
    for n, (i, _) in enumerate(rows):
        least[comp[n]] = min(i, least.get(comp[n], i))
    want = Counter(least[c] for c in {comp[n] for n in range(len(rows)) if sets[n]})
    want.update(i for n, (i, _) in enumerate(rows) if not sets[n])
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_repeated_rows_beside_a_near_copy(spark, monkeypatch):
    """Rows that share id and text (null ids too) are compared once, not once a copy."""
    rnd = random.Random(11)
    words = [f"w{rnd.randrange(900)}" for _ in range(90)]
    near = " ".join([*words[:-1], "other"])
    other = [f"v{rnd.randrange(900)}" for _ in range(70)]
    rows = [(None, " ".join(words))] * 300 + [(5, near)] * 200 + [(6, " ".join(other))] * 150 + [(7, " ".join(other[1:]))]
    rows += [(100 + i, t) for i, (_, t) in enumerate(family_rows(6)) if i < 100]
    made, write = [], Stage.write

    def watched(self, df, *a, **b):
        out = write(self, df, *a, **b)
        if out.columns == ["class", "hub"]:
            made.append(Counter(tuple(r) for r in out.collect()))
        return out

    monkeypatch.setattr(Stage, "write", watched)
    got = Counter(tuple(r) for r in jaccard_join(table(spark, rows).repartition(5)).collect())
    assert got == expected(rows, 4, 85)
    assert any(made) and max(max(m.values()) for m in made if m) == 1


def test_queries_of_a_group_are_cut(spark, monkeypatch):
    """A task gets about GROUP of the classes that ask a group, and finds the same links."""
    from tidecopy.llm import jaccard_join as module
    rnd = random.Random(5)
    frame = [f"w{i}" for i in range(60)]
    # many texts near one another, all about one frame: pairs on both sides of the threshold
    rows = [(i, " ".join(f"x{rnd.randrange(10 ** 6)}" if rnd.random() < 0.02 else w for w in frame)) for i in range(250)]
    open_, most = module._open, 40

    def watched(percent):
        run = open_(percent)

        def checked(key, members, queries):
            if members.num_rows > most or queries.num_rows > most:
                raise ValueError(f"{members.num_rows} members and {queries.num_rows} queries in one task")
            return run(key, members, queries)

        return checked

    monkeypatch.setattr(module, "ROUNDS", 0)
    monkeypatch.setattr(module, "GROUP", 16)
    monkeypatch.setattr(module, "_open", watched)
    got = Counter(tuple(r) for r in jaccard_join(table(spark, rows).repartition(3)).collect())
    assert got == expected(rows, 4, 85)


def test_keep_one_among_equal_rows(spark):
    """Of rows with one id and text the first by the other columns stays, however they are dealt."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, f"s{i}", {"k": i}) for i in range(9, 0, -1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, extra map<string,int>")
    for dealt in (d.coalesce(1), d.repartition(5, "source")):
        kept = keep_one(dealt)
        assert kept.columns == d.columns
        assert sorted((r.doc_id, r.source, tuple(r.extra.items())) for r in kept.collect()) == [(1, "s1", (("k", 1),))]


def test_families_at_the_pipelines_parameters(spark):
    rows = family_rows(2)
    got = Counter(tuple(r) for r in jaccard_join(table(spark, rows).repartition(7), k=5, percent=80).collect())
    assert got == expected(rows, 5, 80)


def test_labelled_groups_in_parts(spark, monkeypatch):
    """Rounds of hubs make labels of more classes than a group holds; their parts are asked across labels."""
    from tidecopy.llm import jaccard_join as module
    rows = family_rows(3)
    monkeypatch.setattr(module, "ROUNDS", 2)
    monkeypatch.setattr(module, "GROUP", 3)
    got = Counter(tuple(r) for r in jaccard_join(table(spark, rows).repartition(3)).collect())
    assert got == expected(rows, 4, 85)


def test_whole_larger_table(spark, sf_mid):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_mid}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op5_jaccard_join"](spark, sf_mid).collect())
    assert got == expected(rows, 4, 85)


def test_components(spark):
    rnd = random.Random(9)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [
        (rnd.randint(2000, 2200), rnd.randint(2000, 2200)) for _ in range(150)] + [(5, 5), (-3, 2100), (7, 7)]
    links = [(a, b) for a, b in links if a != b] + [(1, 0), (0, 1)]
    stage = Stage(spark, "components")
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a long, b long"), stage).collect()}
    assert got == roots({n for x in links for n in x}, links)
    assert components(spark.createDataFrame([], "a long, b long"), stage).collect() == []
