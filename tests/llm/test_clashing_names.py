"""Operators that return the columns of their input, on inputs that have their helper names."""

from tidecopy.llm.decontaminate import drop_leaking
from tidecopy.llm.jaccard_join import keep_one
from tidecopy.llm.mixing import mix_rows
from tidecopy.llm.quality import keep_good

HELPERS = ["key1", "KEY2", "keep1", "keep2", "row", "leak1", "leak2", "k1", "k2", "mix_source", "mix_whole", "mix_upto", "mix_copy", "kept", "p_source"]
QUOTE = "a quotation of many words that a benchmark item holds and that no document should repeat " * 3


def documents(spark):
    texts = [" ".join(f"w{j}x{i}" for j in range(30)) for i in range(6)] + [None, "", QUOTE, "few words"]
    texts += [texts[0]]
    rows = [(i, t, "en", f"s{i % 2}", *[7 * i + j for j in range(len(HELPERS))]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{h} long" for h in HELPERS))


def test_rows_keep_their_columns(spark):
    docs = documents(spark)
    whole = {r.doc_id: tuple(r) for r in docs.collect()}
    bench = spark.createDataFrame([(1, QUOTE)], "item_id long, text string")
    results = {"good": keep_good(docs), "one": keep_one(docs), "clean": drop_leaking(docs, bench),
               "mix": mix_rows(docs, weights=(1, 1), share=1.0, cap=3)}
    got = {name: df.collect() for name, df in results.items()}
    for name, df in results.items():
        assert df.columns == docs.columns
        assert all(tuple(r) == whole[r.doc_id] for r in got[name])
    ids = lambda name: sorted(r.doc_id for r in got[name])
    assert ids("one") == list(range(10)) and ids("clean") == [0, 1, 2, 3, 4, 5, 6, 7, 9, 10]
    assert ids("good") == [0, 1, 2, 3, 4, 5, 10] and set(ids("mix")) <= set(whole)
