"""Runs (maximal repetitions) of the words of every text, by string synchronising sets.

Every window of 1, 2, 4, ... words gets a name, the first place in its text where
the same words stand; only windows that occur again go into the next round. Names
compare exactly, so no run rests on a rolling hash.

At each scale t = 2, 4, 8, ... the synchronising set holds the places i where the
least hash of the t-word windows starting at i to i + t is that at i or that at
i + t. Whether a place belongs follows from the 2t words at it, so a run of period
p, 3t <= p < 6t, that has a place of the set among its first p - 2t + 1 has the same
2t words, and so a place of the set, p further on: places at that distance with
equal contexts propose p. Windows with a period of t / 3 or less don't count in the
set (they would crowd it). A run without any place is one whose first p words have
such a period q, broken where they start again; its two parts lie in runs of period
q that touch, found at an earlier scale, and their phases propose p. Periods under
6 are read off directly. A proposal is extended both ways as far as the words agree,
and kept if it spans two periods and no smaller period does.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecopy.llm._store import text_bytes
from tidecopy.llm._text import MAX64, U64, buffer_of, expand, mix, pieces, runs, sliding, word_hashes, words

MIN_LENGTH = 12
_PIECE = 1 << 19
_DIRECT = 6            # periods below it are read off; the first scale is 2
_NONE = np.zeros(0, dtype=np.int64)


@lru_cache(maxsize=1 << 16)
def _primes(n: int) -> tuple[int, ...]:
    out, d = [], 2
    while d * d <= n:
        if n % d == 0:
            out.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return (*out, n) if n > 1 else tuple(out)


def _name(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Each place's name: the first place with its key; its own number where none is given."""
    names = np.arange(n + 1, dtype=np.int32)
    if len(at):
        order = np.argsort(keys, kind="stable")
        s = keys[order]
        head = np.ones(len(s), dtype=bool)
        head[1:] = s[1:] != s[:-1]
        first = at[order[head]]
        names[at[order]] = np.repeat(first, np.diff(np.append(np.flatnonzero(head), len(s))))
    return names


def _shared(names: np.ndarray) -> np.ndarray:
    """Places whose name another place has too."""
    other = np.flatnonzero(names != np.arange(len(names)))
    if not len(other):
        return other
    mask = np.zeros(len(names), dtype=bool)
    mask[other] = True
    mask[names[other]] = True
    return np.flatnonzero(mask)


class Words:
    """The words of some texts, by code, and the names of their windows."""

    def __init__(self, codes: np.ndarray, off: np.ndarray):
        self.n, self.off = len(codes), off
        self.doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
        self.lo, self.hi = off[:-1][self.doc], off[1:][self.doc]
        salt = self.doc.astype(U64) * U64(0xA0761D6478BD642F)      # equal words of different texts differ
        names = _name(mix(mix(codes) + salt), np.arange(self.n), self.n)
        self.names, k = [names], 0
        while len(at := _shared(names)):
            at = at[at + (2 << k) <= self.hi[at]]
            again = np.zeros(self.n + 1, dtype=bool)
            again[_shared(names)] = True
            at = at[again[at + (1 << k)]]
            names = _name(names[at].astype(np.int64) * (self.n + 1) + names[at + (1 << k)], at, self.n)
            if not len(_shared(names)):
                break
            self.names.append(names)
            k += 1

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree from a and from b on (a < b, in one text)."""
        a, b, first = a.copy(), b.copy(), a
        for k in range(len(self.names) - 1, -1, -1):
            step = (self.names[k][a] == self.names[k][b]).astype(np.int64) << k
            a, b = a + step, b + step
        return a - first

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree before a and before b."""
        last, lo = a, self.lo[a]
        for k in range(len(self.names) - 1, -1, -1):
            x, y = a - (1 << k), b - (1 << k)
            step = ((x >= lo) & (self.names[k][np.maximum(x, 0)] == self.names[k][np.maximum(y, 0)])).astype(np.int64) << k
            a, b = a - step, b - step
        return last - a


def _smallest(w: Words, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of these repetitions have no smaller period (such a one divides theirs)."""
    ok = np.ones(len(start), dtype=bool)
    divisors = {p: _primes(p) for p in np.unique(period).tolist()}
    count = np.array([len(divisors[p]) for p in period.tolist()], dtype=np.int64)
    which = np.repeat(np.arange(len(start)), count)
    d = period[which] // np.array([r for p in period.tolist() for r in divisors[p]], dtype=np.int64)
    smaller = w.ahead(start[which], start[which] + d) >= end[which] - start[which] - d
    ok[which[smaller]] = False
    return ok


def _extended(w: Words, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The runs (start, end, period) that proposals lie in."""
    if not len(at):
        return np.zeros((0, 3), dtype=np.int64)
    start = at - w.behind(at, at + period)
    end = at + period + w.ahead(at, at + period)
    found = np.unique(np.stack([start, end, period], axis=1)[end - start >= 2 * period], axis=0)
    return found[_smallest(w, *found.T)]


def _direct(w: Words) -> list[np.ndarray]:
    """Runs of the periods under ``_DIRECT``."""
    out, place = [], np.arange(w.n)
    for p in range(1, _DIRECT):
        same = np.zeros(w.n, dtype=bool)
        inside = place + p < w.hi
        same[inside] = w.names[0][place[inside]] == w.names[0][place[inside] + p]
        s, e = runs(same)
        s, e = s[e - s >= p], e[e - s >= p] + p
        found = np.stack([s, e, np.full(len(s), p)], axis=1).astype(np.int64)
        out.append(found[_smallest(w, *found.T)])
    return out


def _synchronising(w: Words, scale: int, k: int, periodic: np.ndarray) -> np.ndarray:
    """The places of the set at ``scale`` (2**k) whose 2 * scale words stand elsewhere in their text."""
    again = _shared(w.names[k + 1])
    again = again[again < w.n]
    texts = np.unique(w.doc[again])
    texts = texts[np.diff(w.off)[texts] >= 6 * scale]
    at = expand(w.off[texts], np.diff(w.off)[texts])
    if not len(at):
        return _NONE
    crowd = np.zeros(w.n + 1, dtype=np.int32)
    np.add.at(crowd, periodic[:, 0], 1)
    np.add.at(crowd, periodic[:, 1] - scale + 1, -1)
    out_of_it = (np.cumsum(crowd)[at] > 0) | (at + scale > w.hi[at])
    h = np.where(out_of_it, MAX64, mix(w.names[k][at].astype(U64) + U64(0xD6E8FEB86659FD93)))
    least = sliding(h, scale + 1)
    later = np.full(len(h), MAX64)
    later[:max(0, len(h) - scale)] = h[scale:]
    chosen = (least < MAX64) & ((h == least) | (later == least)) & (at + 2 * scale <= w.hi[at])
    mask = np.zeros(w.n, dtype=bool)
    mask[again] = True
    at = at[chosen]
    return at[mask[at]]


def _pairs(w: Words, at: np.ndarray, scale: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places 3 to 6 times the scale apart with equal contexts: place, distance."""
    context, places, gaps, d = w.names[k + 1][at], [_NONE], [_NONE], 1
    while d < len(at):
        gap = at[d:] - at[:-d]
        near = gap < 6 * scale
        if not near.any():
            break
        hit = near & (gap >= 3 * scale) & (context[d:] == context[:-d])
        places.append(at[:-d][hit])
        gaps.append(gap[hit])
        d += 1
    return np.concatenate(places), np.concatenate(gaps)


def _broken(w: Words, periodic: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Proposals of periods 3 to 6 times the scale from touching runs of one smaller period."""
    long = periodic[periodic[:, 1] - periodic[:, 0] >= 3 * scale]
    long = long[np.lexsort((long[:, 0], long[:, 2]))]
    a, b = long[:-1], long[1:]
    near = (a[:, 2] == b[:, 2]) & (b[:, 0] <= a[:, 1])
    a, b = a[near], b[near]
    near = w.doc[a[:, 0]] == w.doc[b[:, 0]]
    a, b = a[near], b[near]
    if not len(a):
        return _NONE, _NONE
    q = a[:, 2]
    which = np.repeat(np.arange(len(a)), q)
    shift = expand(np.zeros(len(a), np.int64), q)
    level = np.floor(np.log2(q)).astype(np.int64)[which]
    x, y, rest = (a[:, 1] - q)[which], b[which, 0] + shift, q[which] - (1 << level)
    same = np.zeros(len(which), dtype=bool)
    for f in np.unique(level).tolist():
        m, names = level == f, w.names[f]
        same[m] = (names[x[m]] == names[y[m]]) & (names[x[m] + rest[m]] == names[y[m] + rest[m]])
    which, x, y = which[same], x[same], y[same]
    a, b, q = a[which], b[which], q[which]
    first = 3 * scale + (y - x - 3 * scale) % q
    top = np.minimum(6 * scale - 1, np.minimum(a[:, 1] - a[:, 0], b[:, 1] - b[:, 0]))
    count = np.maximum(0, (top - first) // q + 1)
    period = np.repeat(first, count) + expand(np.zeros(len(a), np.int64), count) * np.repeat(q, count)
    return np.maximum(np.repeat(a[:, 0], count), np.repeat(b[:, 0], count) - period), period


def find_runs(codes: np.ndarray, off: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """All runs of the texts' words, as (start, end, period) rows in order of start and period.

    ``codes``: a number per word, equal for equal words; ``off``: each text's first word, and the total."""
    if not len(codes):
        return np.zeros((0, 3), dtype=np.int64)
    w = Words(codes, off)
    found, k = _direct(w), 1
    while k + 1 < len(w.names):
        scale, known = 1 << k, np.concatenate(found)
        periodic = known[(3 * known[:, 2] <= scale) & (known[:, 1] - known[:, 0] >= scale)]
        one = _pairs(w, _synchronising(w, scale, k, periodic), scale, k)
        two = _broken(w, periodic, scale)
        found.append(_extended(w, np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])))
        k += 1
    every = np.concatenate(found)
    every = every[every[:, 1] - every[:, 0] >= np.maximum(min_length, 2 * every[:, 2])]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> pa.Array:
    """Texts of words joined by one space; ``first``: each text's first word, and the total."""
    size = ends - starts + 1
    at = expand(starts, size)
    out = np.append(data, np.uint8(32))[np.minimum(at, len(data))]
    edge = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=edge[1:])
    out[edge[1:] - 1] = 32
    keep = np.ones(len(out), dtype=bool)
    some = first[1:] > first[:-1]
    keep[edge[first[1:][some]] - 1] = False       # no space after a text's last word
    off = edge[first] - np.concatenate([[0], np.cumsum(some)])
    return pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(out[keep].tobytes()))


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _texts(data: np.ndarray, off: np.ndarray, min_length: int):
    """n_words, runs and collapsed texts of the texts in a buffer."""
    starts, ends, by = words(data, off)
    found = find_runs(word_hashes(data, starts, ends), by, min_length)
    dropped = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(dropped, found[:, 0] + found[:, 2], 1)
    np.add.at(dropped, found[:, 1], -1)
    kept = np.cumsum(dropped[:-1]) == 0
    at = np.concatenate([[0], np.cumsum(kept)])
    text = _joined(data, starts[kept], ends[kept], at[by])
    doc = np.searchsorted(by, found[:, 0], side="right") - 1
    values = pa.StructArray.from_arrays([pa.array(found[:, 0] - by[doc]), pa.array(found[:, 1] - found[:, 0]),
                                         pa.array(found[:, 2])], fields=list(_RUN))
    lists = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(by)))), values)
    return pa.array(np.diff(by)), lists, text


def periodic_runs(docs: DataFrame, *, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (array of start, length, period,
    in words, by start and period), collapsed (the words but those that a run holds
    after its first period, joined by one space).

    A run is a stretch of words with smallest period p, of at least ``min_length`` and
    2p words, that no neighbouring word extends. A null or empty text has no words and
    no runs; a null id stays null; repeated rows each give a row; an empty table gives
    an empty result; other columns don't matter. A text is worked on whole, however
    long, in memory of about 60 bytes a word and level of repetition; no shuffle.
    """
    def run(batches):
        for batch in batches:
            data, off = buffer_of(batch.column(1))
            for i, j, part, po in pieces(data, off, _PIECE):
                n, lists, text = _texts(part, po, min_length)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), n, lists.cast(pa.list_(_RUN)), text.cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
                                  "collapsed string")
