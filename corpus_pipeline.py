"""The training-data pipeline: documents through five operators of ``tidecopy.llm``.

Each stage takes what its predecessor kept and, but for the last, returns the
columns of documents: texts that fail the quality rules go; of each group of
near-duplicates (five-word shingles, Jaccard similarity 0.8) the one with the
least id stays; documents that hold a benchmark passage go; sources are mixed
to weights 1, 2, 3, so a document may come up to three times; and what is left
is encoded and written, one row per document with its place in the output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidecopy.llm._store import Stage
from tidecopy.llm.decontaminate import drop_leaking
from tidecopy.llm.jaccard_join import keep_one
from tidecopy.llm.mixing import mix_rows
from tidecopy.llm.quality import keep_good
from tidecopy.llm.queries import read_table
from tidecopy.llm.token_output import token_output


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, k=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaking(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_rows(docs, weights=(1, 2, 3), share=1.0, cap=3)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("token output", token_stage),
]
# suffix arrays, alignments, byte-pair encoding and components are beyond one SQL query
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's result is written to the shared checkpoint folder and read again;
    that of the stage before goes then."""
    docs, store, last = read_table(spark, sf_dir, "documents"), Stage(spark, "pipeline"), []
    for _, stage in STAGES:
        docs = store.write(stage(spark, docs, sf_dir))
        store.drop(*last)
        last = [docs]
    return docs
