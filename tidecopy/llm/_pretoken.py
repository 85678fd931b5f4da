"""Byte-level BPE pre-tokens found with array operations, and a worker's cache of
their ids.

The pre-token rule is that of the public byte-level BPE files: contractions,
runs of letters, digits or other characters with one space before them, and
white space. Texts that the rule can't be applied to with certainty (characters
whose class differs between Unicode versions, added tokens inside the text) go
to the library whole.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from itertools import chain, repeat

import numpy as np

from tidecopy.llm._text import U64, mix, pieces, prefix_hash, span_hash

OTHER, LETTER, DIGIT, WHITE, UNSURE = 0, 1, 2, 3, 5
PIECE_BYTES = 1 << 20          # text worked on at a time; arrays of 8 bytes a character
CACHE_ENTRIES = 1 << 20        # pre-tokens that a worker keeps; then it starts afresh
_SLOTS = 21                    # bits of the direct-mapped table in front of it


def _classes() -> np.ndarray:
    """Class of each code point of the basic plane; UNSURE above and where Unicode
    3.2 and today's version differ."""
    def kind(db, ch):
        c = db.category(ch)
        return UNSURE if c in ("Cn", "Cs") else {"L": LETTER, "N": DIGIT, "Z": WHITE}.get(c[0], OTHER)

    old = unicodedata.ucd_3_2_0
    out = np.full(0x10001, UNSURE, dtype=np.uint8)
    for cp in range(0x10000):
        a = kind(unicodedata, chr(cp))
        if a == kind(old, chr(cp)):
            out[cp] = a
    out[[9, 10, 11, 12, 13]] = WHITE
    out[[0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0x180E, 0x200B, 0xFEFF]] = UNSURE
    return out


_CLASS: np.ndarray | None = None
_CODE = mix(np.arange(1, 0x10002, dtype=U64) * U64(0x9FB21C651E98DF25))


def classes() -> np.ndarray:
    global _CLASS
    if _CLASS is None:
        _CLASS = _classes()
    return _CLASS


def decode(data: np.ndarray, off: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts as one string, its code points, and each text's first character."""
    raw = data.tobytes()
    try:
        text = raw.decode("utf-8")
        lead = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
        first = lead[off]
    except UnicodeDecodeError:  # as Spark shows such bytes: U+FFFD
        parts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:])]
        text, first = "".join(parts), np.cumsum([0, *map(len, parts)])
    return text, np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32), first


def boundaries(cp: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of each pre-token; which characters are of unsure class."""
    n = len(cp)
    low = np.minimum(cp, 0x10000).astype(np.int32)
    cls = classes()[low]
    begin = np.empty(n, dtype=bool)
    begin[1:] = cls[1:] != cls[:-1]
    doc = np.zeros(n + 1, dtype=bool)
    doc[first] = True
    begin |= doc[:n]
    if n == 0:
        return np.zeros(0, np.int64), cls == UNSURE
    # the last white character before something else stands alone, or, if it is a
    # space, goes with what follows
    after = np.flatnonzero(begin[1:] & ~doc[1:n] & (cls[1:] != WHITE) & (cls[:-1] == WHITE)) + 1
    begin[after - 1] = True
    begin[after[cp[after - 1] == 32]] = False
    # contractions
    p = np.flatnonzero((cp == 39) & begin)
    p = p[p + 1 < n]
    p = p[(cls[p + 1] == LETTER) & ~doc[p + 1]]
    if len(p):
        wide = np.append(cp, [0, 0, 0]).astype(np.uint32)
        wide_cls = np.append(cls, [OTHER] * 3)
        wide_doc = np.append(doc, [True] * 3)
        a, b = wide[p + 1], np.where(wide_doc[p + 2], 0, wide[p + 2])
        one = np.isin(a, [ord(x) for x in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        for hit, size in ((one, 2), (two & ~one, 3)):
            q = p[hit]
            begin[q + 1] = False
            end = q + size
            end = end[~wide_doc[end] & (wide_cls[end] == LETTER)]
            begin[end] = True
    return np.flatnonzero(begin), cls == UNSURE


class Pieces:
    """The pre-tokens of some texts: hash of each, and per text the index of its first one."""

    def __init__(self, data: np.ndarray, off: np.ndarray, added: list[bytes]):
        self.text, cp, self.first = decode(data, off)
        self.start, unsure = boundaries(cp, self.first)
        self.end = np.append(self.start[1:], len(cp))
        self.by_text = np.searchsorted(self.start, self.first)
        codes = _CODE[np.minimum(cp, 0x10000)]
        self.hash = span_hash(prefix_hash(codes), self.start, self.end)
        self.hash |= U64(1)
        bad = np.zeros(len(off) - 1, dtype=bool)
        if unsure.any():
            at = np.flatnonzero(unsure)
            bad[np.searchsorted(self.first, at, side="right") - 1] = True
        raw = data.tobytes() if added else b""
        for token in added:
            at = raw.find(token)
            while at >= 0:
                bad[np.searchsorted(off, at, side="right") - 1] = True
                at = raw.find(token, at + 1)
        self.whole = np.flatnonzero(bad)   # texts for the library

    def text_of(self, i: int) -> str:
        return self.text[self.first[i]:self.first[i + 1]]


def byte_letters() -> dict[int, str]:
    """Byte -> printable letter, the public byte-level alphabet: printable Latin-1
    bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    out.update({b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in out)})
    return out


class Codec:
    """Ids of texts as the tokenizers library gives them for a .json file, by way of
    a cache of pre-tokens where the file's rules allow it."""

    def __init__(self, spec: bytes, entries: int = CACHE_ENTRIES):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_str(spec.decode())
        self.lib.no_truncation()
        self.lib.no_padding()
        spec = json.loads(spec)
        pre = spec.get("pre_tokenizer") or {}
        self.fast = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                     and pre.get("use_regex", True) and spec["model"]["type"] == "BPE"
                     and not spec["model"].get("ignore_merges"))
        tokens = spec.get("added_tokens", [])
        self.fast &= not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens)
        self.added = [t["content"].encode() for t in tokens]
        self.letters = {chr(b): c for b, c in byte_letters().items()}
        self.letters = str.maketrans(self.letters)
        self.entries = entries
        self.reset()

    def reset(self) -> None:
        self.keys = np.zeros(1 << _SLOTS, dtype=U64)
        self.vals = np.zeros(1 << _SLOTS, dtype=np.int32)
        self.known: dict[int, int] = {}
        self.n = np.zeros(1 << 12, dtype=np.int32)        # ids of each entry
        self.at = np.zeros(1 << 12, dtype=np.int64)       # where they begin in the pool
        self.pool = np.zeros(1 << 14, dtype=np.uint32)
        self.used = 0

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.lib.encode_batch(texts, add_special_tokens=False)]

    def _add(self, keys: list[int], lens: np.ndarray, ids: np.ndarray) -> None:
        """New entries, in order, whose ids stand back to back."""
        v, k = len(self.known), len(keys)
        while v + k > len(self.n):
            self.n, self.at = np.append(self.n, np.zeros_like(self.n)), np.append(self.at, np.zeros_like(self.at))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros_like(self.pool))
        self.n[v:v + k] = lens
        self.at[v:v + k] = self.used + np.cumsum(lens) - lens
        self.pool[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.known.update(zip(keys, range(v, v + k)))

    def lookup(self, p: Pieces) -> np.ndarray:
        """Entry of each pre-token; unknown ones are encoded and kept."""
        slot = (p.hash >> U64(64 - _SLOTS)).astype(np.int64)
        miss = np.flatnonzero(self.keys[slot] != p.hash)
        out = self.vals[slot]  # before new entries take slots over
        if len(miss):
            keys, where = np.unique(p.hash[miss], return_index=True)
            if len(self.known) + len(keys) > self.entries and len(self.known) > 0:
                self.reset()
                miss = np.arange(len(p.hash))
                out = np.empty(len(miss), dtype=np.int32)
                keys, where = np.unique(p.hash, return_index=True)
            first = miss[where]
            vals = np.array(list(map(self.known.get, keys.tolist(), repeat(-1))), dtype=np.int32)
            new = np.flatnonzero(vals < 0)
            if len(new):
                raw = [p.text[a:b] for a, b in zip(p.start[first[new]].tolist(), p.end[first[new]].tolist())]
                tokenize = self.lib.model.tokenize
                raw = "\n".join(raw).encode().decode("latin-1").translate(self.letters).split("\u010a") \
                    if not any("\n" in x for x in raw) else [x.encode().decode("latin-1").translate(self.letters) for x in raw]
                found = [[t.id for t in tokenize(x)] for x in raw]
                lens = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
                vals[new] = len(self.known) + np.arange(len(new))
                self._add(keys[new].tolist(), lens, np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(lens.sum())))
            own = (keys >> U64(64 - _SLOTS)).astype(np.int64)
            self.keys[own], self.vals[own] = keys, vals
            out[miss] = vals[np.searchsorted(keys, p.hash[miss])]
        return out

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts back to back, and the number of each text's ids."""
        if not self.fast:
            raw = data.tobytes()
            found = self.whole([raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:])])
            return (np.concatenate(found) if found else np.zeros(0, np.uint32)), np.array([len(x) for x in found], np.int64)
        ids, counts = [], []
        for _, _, part, po in pieces(data, off, PIECE_BYTES):
            p = Pieces(part, po, self.added)
            entry = self.lookup(p)
            n = self.n[entry].astype(np.int64)
            flat = self.pool[_ranges(self.at[entry], n)]
            ends = np.concatenate([[0], np.cumsum(n)])[p.by_text]
            if len(p.whole):
                split = np.split(flat, ends[1:-1])
                for i, x in zip(p.whole, self.whole([p.text_of(i) for i in p.whole])):
                    split[i] = x
                ids += split
                counts.append(np.array([len(x) for x in split], np.int64))
            else:
                ids.append(flat)
                counts.append(np.diff(ends))
        return (np.concatenate(ids) if ids else np.zeros(0, np.uint32)), (np.concatenate(counts) if counts else np.zeros(0, np.int64))

    def count(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Number of ids of each text."""
        if not self.fast:
            return self.encode(data, off)[1]
        counts = []
        for _, _, part, po in pieces(data, off, PIECE_BYTES):
            p = Pieces(part, po, self.added)
            entry = self.lookup(p)
            total = np.concatenate([[0], np.cumsum(self.n[entry], dtype=np.int64)])[p.by_text]
            c = np.diff(total)
            if len(p.whole):
                c[p.whole] = [len(x) for x in self.whole([p.text_of(i) for i in p.whole])]
            counts.append(c)
        return np.concatenate(counts) if counts else np.zeros(0, np.int64)

    def seed(self, keys: np.ndarray, lens: np.ndarray) -> None:
        """Fill the cache with known lengths (``count`` only: the ids aren't known)."""
        self._add(keys.tolist(), lens, np.zeros(int(lens.sum()), np.uint32))
        own = (keys >> U64(64 - _SLOTS)).astype(np.int64)
        self.keys[own], self.vals[own] = keys, np.arange(len(keys), dtype=np.int32)


_CODECS: dict[tuple, Codec] = {}


def worker_codec(spec: bytes, role: str = "ids") -> Codec:
    """This worker's codec for a tokenizer file; it outlives a task."""
    key = (role, hashlib.sha256(spec).digest())
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(spec)
    return _CODECS[key]


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    total = int(lens.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    return np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(total)
