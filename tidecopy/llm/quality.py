"""Quality rules from word suffix arrays.

Every text gets the suffix array of its words (prefix doubling over the batch,
with the text's number in the first ranks, so no suffix is compared across
texts; only suffixes that still have an equal go into the next round). The
ranks of the rounds give the longest common prefix of neighbours in the array;
a suffix's longest repeat is the larger of the two with its neighbours. The
intervals of common prefixes of ``window`` words or more are the maximal
repeated word strings, and the union of their spans is the repeated part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecopy.llm._store import text_bytes
from tidecopy.llm._text import buffer_of, byte_prefix, covered, give_back, pieces, span_hash, words

# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_PIECE = 1 << 19


@dataclass(frozen=True)
class QualityLimits:
    """``window``: words of the shortest repeat that counts. A text fails the base
    rules with fewer than ``min_words`` words or more than ``max_repeat_percent``
    % of them in repeats. Of the others, the suffix array rejects those whose
    repeats of ``long_repeat`` words or more cover over ``max_long_percent`` % (and
    over ``long_floor`` words), or whose longest repeat has over
    ``max_longest_percent`` % of the text's words (and over ``longest_floor``), or
    over ``max_longest``. The floors keep texts that say one sentence twice. Repeats
    of ``long_repeat`` words are repeats of ``window`` words too, and a passage that
    stands twice is covered twice, so a percentage at or over ``max_repeat_percent``
    (half of it for the longest) would reject nothing that the base rules keep."""

    window: int = 5
    min_words: int = 10
    max_repeat_percent: int = 20
    long_repeat: int = 10
    max_long_percent: int = 10
    long_floor: int = 40
    max_longest_percent: int = 4
    longest_floor: int = 20
    max_longest: int = 120


def longest_repeats(codes: np.ndarray, doc: np.ndarray, doc_end: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest repeat in its own text that starts there.

    ``codes``: a number per word, equal for equal words; ``doc``: its text;
    ``doc_end``: first word after its text."""
    n = len(codes)
    out = np.zeros(n, dtype=np.int64)
    if n == 0:
        return out
    _, ids = np.unique(codes, return_inverse=True)
    key = doc.astype(np.int64) * (int(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    active, levels, k = order, [], 1
    head = np.empty(n, dtype=bool)
    head[0] = True
    head[1:] = key[order][1:] != key[order][:-1]
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    while True:
        levels.append(rank.copy())
        # keep the suffixes that have an equal for the first k words
        same = np.zeros(len(active), dtype=bool)
        r = rank[active]
        eq = r[1:] == r[:-1]
        same[1:] |= eq
        same[:-1] |= eq
        active = active[same]
        if len(active) == 0:
            break
        r = rank[active]
        nxt = active + k
        second = np.where(nxt < doc_end[active], rank[np.minimum(nxt, n - 1)] + 1, 0)
        order = np.lexsort((second, r))
        active, r, second = active[order], r[order], second[order]
        first = np.empty(len(r), dtype=bool)
        first[0] = True
        first[1:] = r[1:] != r[:-1]
        head = first.copy()
        head[1:] |= second[1:] != second[:-1]
        at = np.arange(len(r))
        group = np.maximum.accumulate(np.where(first, at, 0))
        sub = np.maximum.accumulate(np.where(head, at, 0))
        rank[active] = r + sub - group
        k *= 2
    if len(levels) < 2:
        return out
    # common prefixes of neighbours among the suffixes that share a word with another
    some = np.flatnonzero(np.bincount(levels[0], minlength=n)[levels[0]] > 1)
    sa = some[np.argsort(rank[some], kind="stable")]
    a, b = sa[:-1].copy(), sa[1:].copy()
    lcp = np.zeros(len(a), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        ra = np.append(levels[level], -1)
        rb = np.append(levels[level], -2)
        hit = ra[np.minimum(a, n)] == rb[np.minimum(b, n)]
        step = hit * (1 << level)
        lcp += step
        a += step
        b += step
    best = np.zeros(len(sa), dtype=np.int64)
    best[1:] = lcp
    best[:-1] = np.maximum(best[:-1], lcp)
    out[sa] = best
    return out


def _per_text(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[off])


def _spans(longest: np.ndarray, least: int) -> np.ndarray:
    """Words covered by repeats of at least ``least`` words."""
    return covered(longest >= least, least)


def measure(data: np.ndarray, off: np.ndarray, limits: QualityLimits) -> dict[str, np.ndarray]:
    """The figures and verdicts of the texts in a buffer."""
    found = []
    for _, _, part, po in pieces(data, off, _PIECE):
        starts, ends, by = words(part, po)
        prefix = byte_prefix(part)
        codes = span_hash(prefix, starts, ends)
        n_words = np.diff(by)
        doc = np.repeat(np.arange(len(n_words)), n_words)
        longest = longest_repeats(codes, doc, by[1:][doc])
        inside = np.zeros(len(part) + 1, dtype=np.int8)
        inside[starts] = 1
        np.add.at(inside, ends, -1)
        letters = (np.cumsum(inside[:-1]) > 0) & ((part & 0xC0) != 0x80)
        # lines that have a word
        cut = np.flatnonzero(part == 10)
        ls = np.unique(np.concatenate([po[:-1], cut + 1]))
        ld = np.searchsorted(po, ls, side="right") - 1
        nl = np.searchsorted(cut, ls)
        le = np.minimum(np.append(cut, len(part))[nl], po[1:][np.minimum(ld, len(po) - 2)])
        ok = (ld < len(po) - 1) & (le > ls)
        ls, le, ld = ls[ok], le[ok], ld[ok]
        ok = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
        ls, le, ld = ls[ok], le[ok], ld[ok]
        h = span_hash(prefix, ls, le)
        order = np.lexsort((h, ld))
        again = np.zeros(len(ls), dtype=bool)
        again[1:] = (h[order][1:] == h[order][:-1]) & (ld[order][1:] == ld[order][:-1])
        most = np.zeros(len(n_words), dtype=np.int64)
        np.maximum.at(most, doc, longest)
        found.append({
            "n_words": n_words,
            "word_chars": _per_text(letters, po),
            "n_symbols": _per_text(_SYMBOL[part], po),
            "n_dup_lines": np.bincount(ld[order][again], minlength=len(n_words)),
            "n_repeat_words": _per_text(_spans(longest, limits.window), by),
            "n_long_words": _per_text(_spans(longest, limits.long_repeat), by),
            "longest_repeat": np.where(most >= limits.window, most, 0),
        })
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_long_words", "longest_repeat")
    out = {k: np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]).astype(np.int64) for k in names}
    out["base_failed"] = (out["n_words"] < limits.min_words) | (
        100 * out["n_repeat_words"] > limits.max_repeat_percent * out["n_words"])
    n, long_words, longest = out["n_words"], out["n_long_words"], out["longest_repeat"]
    out["kept"] = ~(out["base_failed"]
                    | ((100 * long_words > limits.max_long_percent * n) & (long_words > limits.long_floor))
                    | ((100 * longest > limits.max_longest_percent * n) & (longest > limits.longest_floor))
                    | (longest > limits.max_longest))
    return out


def quality_rules(docs: DataFrame, limits: QualityLimits = QualityLimits(), *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, figures, ``base_failed`` and ``kept``.

    A null or empty text has no words: it fails the base rules. A null id stays
    null, equal rows each give a row, an empty table an empty result; other
    columns don't matter. No shuffle: a text is judged by itself.
    """
    def run(batches):
        for batch in batches:
            m = measure(*buffer_of(batch.column(1)), limits)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in m.values())], ["doc_id", *m])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                  "n_repeat_words long, n_long_words long, longest_repeat long, "
                                  "base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, limits: QualityLimits = QualityLimits(), *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns. Only texts go
    to Python and only verdicts come back."""
    @F.arrow_udf("boolean")
    def kept(texts: pa.Array) -> pa.Array:
        out = pa.array(measure(*buffer_of(texts), limits)["kept"])
        give_back()
        return out

    return docs.where(kept(text_bytes(text_col)))
