"""Token counts by a map-side two-tier lookup.

Tier one is a table of the corpus's most frequent pre-tokens and their lengths
in tokens: each task counts its own pre-tokens and hands on a bounded list, the
lists are summed, and the ``frequent`` best (bounded, about 13 bytes each) are
broadcast. Tier two is each worker's own cache, which encodes a pre-token the
first time it meets it. No pre-token goes through a shuffle; the table only
saves work, every text is counted whole and exactly.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecopy.llm._pretoken import PIECE_BYTES, Pieces, worker_codec
from tidecopy.llm._store import text_bytes
from tidecopy.llm._text import buffer_of, pieces

FREQUENT = 1 << 16      # entries of the broadcast table
PER_TASK = 1 << 13      # entries that one task hands on
_HELD = 1 << 18         # entries that one task holds while counting


def _frequent_of_task(spec):
    def run(batches):
        codec = worker_codec(spec.value)
        held: dict[int, list] = {}
        for batch in batches:
            data, off = buffer_of(batch.column(0))
            for _, _, part, po in pieces(data, off, PIECE_BYTES):
                p = Pieces(part, po, codec.added)
                keys, first, n = np.unique(p.hash, return_index=True, return_counts=True)
                often = n >= 4
                for k, i, c in zip(keys[often].tolist(), first[often].tolist(), n[often].tolist()):
                    if k in held:
                        held[k][0] += c
                    else:
                        held[k] = [c, p.text[p.start[i]:p.end[i]]]
                if len(held) > _HELD:
                    held = dict(sorted(held.items(), key=lambda x: -x[1][0])[:_HELD // 2])
        best = sorted(held.items(), key=lambda x: (-x[1][0], x[0]))[:PER_TASK]
        texts = [t.encode("utf-8", "replace") for _, (_, t) in best]
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        lens = codec.count(np.frombuffer(b"".join(texts), dtype=np.uint8), off) if best else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array([k for k, _ in best], dtype=np.uint64).view(np.int64)),
             pa.array([c for _, (c, _) in best], pa.int64()), pa.array(lens, pa.int32())], ["key", "n", "len"])

    return run


def frequent_pieces(docs: DataFrame, spec, frequent: int = FREQUENT, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Hashes and lengths of the most frequent pre-tokens: at most ``frequent``."""
    own = docs.select(text_bytes(text_col).alias("text")).mapInArrow(_frequent_of_task(spec), "key long, n long, len int")
    rows = (own.groupBy("key").agg(F.sum("n").alias("n"), F.max("len").alias("len"))
            .orderBy(F.desc("n"), "key").limit(frequent).select("key", "len").toArrow())
    return rows["key"].to_numpy().view(np.uint64), rows["len"].to_numpy().astype(np.int64)


def token_counts(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes`` (UTF-8), ``n_tokens`` as the
    library of ``model`` (.json: tokenizers, .model: sentencepiece) gives it
    without begin, end or added special tokens, and ``over_limit``.

    A null text counts as empty (0 bytes, 0 tokens, for a .model as the library
    counts an empty text); a null id stays null; equal rows each give a row; an
    empty table gives an empty result. Other columns of ``docs`` don't matter.
    The model file is read once, on the driver, and broadcast (a vocabulary, a
    few MB whatever the corpus).
    """
    sc = docs.sparkSession.sparkContext
    with open(model, "rb") as f:
        spec = sc.broadcast(f.read())
    tag = uuid.uuid4().hex
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    if model.endswith(".model"):
        count, table = _sentencepiece, None
    else:
        keys, lens = frequent_pieces(docs, spec, frequent, text_col)
        count, table = _byte_bpe, sc.broadcast((keys, lens))
    out = source.mapInArrow(_counting(count, spec, table, tag), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


def _byte_bpe(spec, table, tag):
    codec = worker_codec(spec.value, tag)
    if not codec.known and codec.fast:
        codec.seed(*table.value)
    return codec.count


_PROCESSORS: dict = {}


def _sentencepiece(spec, table, tag):
    def run(data, off):
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:])]
        return np.array([len(x) for x in _PROCESSORS[tag].encode(texts, num_threads=1)], np.int64)

    if tag not in _PROCESSORS:
        import sentencepiece
        _PROCESSORS[tag] = sentencepiece.SentencePieceProcessor(model_proto=spec.value)
    return run


def _counting(count, spec, table, tag: str):
    def run(batches):
        f = count(spec, table, tag)
        for batch in batches:
            data, off = buffer_of(batch.column(1))
            n = np.concatenate([f(part, po) for _, _, part, po in pieces(data, off, 8 << 20)] or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(off)), pa.array(n.astype(np.int64))], ["doc_id", "n_bytes", "n_tokens"])

    return run
