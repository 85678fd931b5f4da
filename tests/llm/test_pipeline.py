"""The pipeline's stages, each against its operator's own result on the stage's input."""

import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_jaccard import brute
from tidecopy.llm.decontaminate import leaks
from tidecopy.llm.mixing import mix_sources
from tidecopy.llm.quality import quality_rules


def test_stages(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "benchmark decontamination", "mixing sources", "token output"]
    outs = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, outs[-1], sf_small).write.parquet(f"{tmp_path}/{k}")
        outs.append(spark.read.parquet(f"{tmp_path}/{k}"))
        if k < 4:
            assert outs[-1].columns == docs.columns
    ids = [Counter(r.doc_id for r in o.select("doc_id").collect()) for o in outs]
    # 1: what the rules keep
    assert set(ids[1]) == {r.doc_id for r in quality_rules(docs).where("kept").collect()}
    # 2: the least id of each component
    rows = [(r.doc_id, r.text) for r in outs[1].collect()]
    _, comp = brute(rows, 5, 80)
    least = {}
    for n, (i, _) in enumerate(rows):
        least[comp[n]] = min(i, least.get(comp[n], i))
    assert set(ids[2]) == set(least.values()) and max(ids[2].values()) == 1
    # 3: none that holds a benchmark passage
    bad = {r.doc_id for r in leaks(outs[2], spark.read.parquet(f"{sf_small}/benchmark.parquet")).collect()}
    assert bad and set(ids[3]) == set(ids[2]) - bad
    # 4: as often as the mix takes them
    assert ids[4] == Counter({r.doc_id: r.copies for r in mix_sources(outs[3]).where("copies > 0").collect()})
    # 5: tokens of all of them, in order of id
    lib, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for r in outs[4].orderBy("doc_id").collect():
        t = lib.encode(r.text, add_special_tokens=False).ids + [2]
        want.append((r.doc_id, start, len(t), zlib.crc32(np.array(t, "<u4").tobytes())))
        start += len(t)
    assert sorted(tuple(r) for r in outs[5].collect()) == want
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_small).collect()) == want


def test_run_writes_each_stage(spark, sf_small, monkeypatch):
    from tidecopy.session import checkpoint_dir
    read = []

    def stage(spark, docs, sf_dir):
        read.append(docs.inputFiles())
        return docs.where("doc_id % 2 = 0" if len(read) == 1 else "doc_id % 3 = 0")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", stage), ("b", stage), ("c", stage)])
    out = corpus_pipeline.run(spark, sf_small)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in docs.where("doc_id % 6 = 0").collect())
    shared = checkpoint_dir(spark).removeprefix("file:")
    assert [all(shared in f for f in files) for files in [*read, out.inputFiles()]] == [False, True, True, True]
    assert not set(read[1]) & set(read[2])


WORKER = """
import ctypes, numpy as np, pyarrow as pa
from tidecopy.llm import jaccard_join, quality, _text


def held():
    with open("/proc/self/status") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("VmRSS")) / 1024


rng = np.random.default_rng(1)
texts = [b" ".join(b"%x" % x for x in rng.integers(0, 1 << 20, rng.integers(20, 1200))) for _ in range(4000)]
ids = pa.array(range(len(texts)))
batch = pa.RecordBatch.from_arrays([ids, ids, ids, pa.array(texts, pa.binary())], ["doc_id", "k1", "k2", "text"])
del texts
bitmap = type("Bitmap", (), {"value": np.zeros(1 << 21, np.uint8)})
ctypes.CDLL(None).malloc_trim(0)
before = held()
quality.measure(*_text.buffer_of(batch.column(3)), quality.QualityLimits())
for _ in range(2):
    for part in jaccard_join._frequent(5)([batch.select(["text"])]):
        del part
    for part in jaccard_join._blocks(5, 80, bitmap, 102)([batch]):
        del part
print(held() - before)
"""


def test_a_worker_gives_memory_back():
    done = subprocess.run([sys.executable, "-c", WORKER], capture_output=True, text=True, check=True, timeout=120)
    assert float(done.stdout) < 15       # MB
