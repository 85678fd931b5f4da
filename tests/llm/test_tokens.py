"""Token counts, token output and their parts against the library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidecopy.llm._pretoken import Codec
from tidecopy.llm._text import buffer_of
from tidecopy.llm.token_counts import token_counts
from tidecopy.llm.token_output import DacReader, dac_encode, token_output

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "s", "t", "re", "ll", "ve", "m", "d", "'", " ", " ", "  ", "\n", "\t", "1", "2", "é", "ñ", "ß", ".", ",", "-",
         "世", "界", " ", "　", "😀", "<|endoftext|>", "\x1c", "́", "'s", "I'm", "٣", "S", "\r\n"]


def odd_texts(n=3000):
    rnd = random.Random(1)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))) for _ in range(n)] + [
        "", "'", "'s", " 's", "  's", "''s", "a'", "a'l", "a'll", "a'llo", "x're", "a" * 5000, " " * 300 + "x"]


def test_codec_gives_the_librarys_ids():
    with open(PATH, "rb") as f:
        codec = Codec(f.read(), entries=500)        # small: it starts afresh many times
    texts = odd_texts()
    expected = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    data, off = buffer_of(pa.array([t.encode() for t in texts]))
    ids, n = codec.encode(data, off)
    assert [list(x) for x in np.split(ids, np.cumsum(n)[:-1])] == expected
    assert codec.count(data, off).tolist() == [len(e) for e in expected]


@pytest.mark.parametrize("top", [1, 200, 256, 70_000, 2**32 - 1])
def test_dac_round_trip(top):
    rnd = np.random.default_rng(top)
    for n in (0, 1, 7, 513, 5000):
        ids = rnd.integers(0, top + 1, n).astype(np.uint32)
        r = DacReader(dac_encode(ids))
        assert len(r) == n and np.array_equal(r.all(), ids)
        for i in rnd.integers(0, n, 50) if n else []:
            assert r[int(i)] == ids[i]


def table(spark, texts, ids=None):
    ids = ids if ids is not None else list(range(len(texts)))
    # columns whose names clash with those of results
    return spark.createDataFrame([(i, t, "x", 1.5, "y") for i, t in zip(ids, texts)],
                                 "doc_id long, text string, n_tokens string, size double, part string")


def test_token_counts_odd_rows(spark):
    texts = [None, *odd_texts(300), "same", "same"]
    got = token_counts(table(spark, texts, [None, *range(len(texts) - 1)]).repartition(3), PATH, limit=3).collect()
    lib = Tokenizer.from_file(PATH)
    expected = sorted((len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for t in texts)
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == expected
    assert all(r.over_limit == (r.n_tokens > 3) for r in got)
    assert token_counts(table(spark, []), PATH).collect() == []


def test_token_counts_sentencepiece(spark):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", None, "A few words, </s> and more.", "étrange 世界"]
    got = {r.doc_id: r.n_tokens for r in token_counts(table(spark, texts), path).collect()}
    assert got == {i: len(lib.encode(t or "")) for i, t in enumerate(texts)}


def test_token_counts_whole_table(spark, sf_small):
    from tidecopy.llm.queries import QUERIES
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    lib = Tokenizer.from_file(PATH)
    n = [len(e.ids) for e in lib.encode_batch([d.text or "" for d in docs], add_special_tokens=False)]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op8_token_counts"](spark, sf_small).collect()}
    assert got == {d.doc_id: (len((d.text or "").encode()), k, k > 1024) for d, k in zip(docs, n)}


def expected_output(pairs):
    lib, start, out = Tokenizer.from_file(PATH), 0, []
    for i, t in pairs:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_output_whole_table(spark, sf_small):
    from tidecopy.llm.queries import QUERIES
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").orderBy("doc_id").collect()
    got = sorted(tuple(r) for r in QUERIES["op3_token_output"](spark, sf_small).collect())
    assert got == expected_output([(d.doc_id, d.text) for d in docs])


def test_token_output_odd_rows(spark):
    texts = [None, "", "long " * 20_000, "b", "b", "<|endoftext|> x"]
    got = sorted(tuple(r)[:4] for r in token_output(table(spark, texts, [5, 1, -3, 7, 7, 9]).repartition(4), PATH).collect())
    assert got == expected_output([(-3, texts[2]), (1, ""), (5, None), (7, "b"), (7, "b"), (9, texts[5])])
    nulls = token_output(table(spark, ["a", "b"], [None, 3]), PATH).orderBy("start").collect()
    assert [(r.doc_id, r.start) for r in nulls] == [(None, 0), (3, 2)]
    assert token_output(table(spark, []), PATH).collect() == []
