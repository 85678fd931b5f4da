"""Vectorised text work on Arrow batches: words, span hashes, rolling windows.

All positions are relative to one buffer that holds the batch's texts back to
back; ``off`` has one more entry than there are texts.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
MAX64 = U64(0xFFFFFFFFFFFFFFFF)
# Word separators: 0x20 and 0x09 to 0x0D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def give_back() -> None:
    """Return memory that was freed, but that this worker's allocators still hold, to the system.
    Workers are used again and again, and the executor's JVM may need the memory meanwhile."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of the GNU C library only
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """A function of batches that gives back its memory when its batches are done."""
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply): spreads every bit over the word."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def unlike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row of ``a``: does it differ from that of ``b``?"""
    out = a[:, 0] != b[:, 0]
    for k in range(1, a.shape[1]):      # many times as fast as any() along a short axis
        out |= a[:, k] != b[:, k]
    return out


def grouped(h: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal rows of ``keys`` are neighbours, by their hashes ``h``; and
    the first of each group. Sorts numbers that hold a hash's upper bits and its place."""
    n = len(h)
    bits = U64(max(1, int(n).bit_length()))
    low = (U64(1) << bits) - U64(1)
    packed = (h & ~low) | np.arange(n, dtype=U64)
    packed.sort()
    order = (packed & low).astype(np.int64)
    top = packed >> bits
    head = np.ones(n, dtype=bool)
    near = np.flatnonzero(top[1:] == top[:-1]) + 1      # only these can be equal
    head[near] = apart = unlike(keys.take(order[near], axis=0), keys.take(order[near - 1], axis=0))
    mixed = near[apart]
    for t in np.unique(top[mixed]).tolist():      # rare: different keys that agree in the upper bits
        a, b = np.searchsorted(top, np.array([t, t + 1], dtype=U64))
        order[a:b] = order[a:b][np.lexsort((*keys[order[a:b]].T, h[order[a:b]]))]
        head[a + 1:b] = unlike(keys[order[a + 1:b]], keys[order[a:b - 1]])
    return order, head


#: a random-looking 64-bit code for each byte value
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


class _Powers:
    """r**i and r**-i modulo 2**64 for an odd r, grown on demand."""

    def __init__(self, r: int):
        self.r, self.inv = r, pow(r, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.full(size, b, dtype=U64) for b in (self.r, self.inv))
            for a in (self.up, self.down):
                a[0] = 1
                np.multiply.accumulate(a, out=a)
        return self.up[:n], self.down[:n]


_POWERS = {0: _Powers(0x9E3779B97F4A7C15), 1: _Powers(0xD6E8FEB86659FD93)}


def buffer_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary or string Arrow column; a null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    wide = pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type)
    _, offs, data = col.buffers()
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(data: np.ndarray, off: np.ndarray, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of at most ``most`` bytes (one text at least): first text, last + 1, bytes, offsets."""
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and per text the index of its first word (plus the total)."""
    inside = ~_SPACE[data]
    n = len(data)
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    cut = off[(off > 0) & (off < n)]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[cut - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def prefix_hash(codes: np.ndarray, which: int = 0) -> np.ndarray:
    """Running polynomial hash of 64-bit codes; ``span_hash`` takes spans from it."""
    up, _ = _POWERS[which].get(len(codes) + 1)
    out = np.zeros(len(codes) + 1, dtype=U64)
    np.cumsum(codes * up[:len(codes)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of each span: equal spans have equal hashes wherever they stand."""
    _, down = _POWERS[which].get(len(prefix))
    h = (prefix[end] - prefix[start]) * down[start]
    return mix(h ^ ((end - start).astype(U64) * U64(0xA0761D6478BD642F)))


def byte_prefix(data: np.ndarray) -> np.ndarray:
    return prefix_hash(_BYTE[data])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(byte_prefix(data), starts, ends)


def window_hashes(codes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of codes[i:i+length] for each i; the last ones, which don't fit, are 0."""
    out = np.zeros(len(codes), dtype=U64)
    n = len(codes) - length + 1
    if n > 0:
        prefix = prefix_hash(codes, which)
        _, down = _POWERS[which].get(n)
        out[:n] = mix((prefix[length:] - prefix[:n]) * down)
    return out


def fits(off: np.ndarray, length: int) -> np.ndarray:
    """For each item: does a window of ``length`` items starting there end in its own text?"""
    ends = np.repeat(off[1:], np.diff(off))
    return np.arange(len(ends)) + length <= ends


def sliding(a: np.ndarray, width: int, least: bool = True) -> np.ndarray:
    """Least (or greatest) of a[i:i+width], cut off at the end."""
    f = np.minimum if least else np.maximum
    out, span, n = a.copy(), 1, len(a)
    while span * 2 <= width and span < n:
        out[:n - span] = f(out[:n - span], out[span:])
        span *= 2
    if span < width and width - span < n:
        d = width - span
        out[:n - d] = f(out[:n - d], out[d:])
    return out


def anchors(h: np.ndarray, valid: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the least hash of some valid run of ``width`` positions."""
    least = np.where(valid, sliding(h, width), U64(0))
    reach = sliding(least[::-1], width, least=False)[::-1]
    return np.flatnonzero((reach == h) & (reach > 0))


def covered(starts_mask: np.ndarray, length: int) -> np.ndarray:
    """Mask of items covered by windows of ``length`` that start where the mask is set."""
    n = len(starts_mask)
    d = np.zeros(n + length + 1, dtype=np.int32)
    at = np.flatnonzero(starts_mask)
    d[at] += 1
    d[at + length] -= 1
    return np.cumsum(d[:n]) > 0


def runs(mask: np.ndarray, off: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of set positions; runs don't cross ``off``."""
    n = len(mask)
    before = np.zeros(n, dtype=bool)
    before[1:] = mask[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = mask[1:]
    if off is not None:
        cut = off[(off > 0) & (off < n)]
        before[cut] = False
        after[cut - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def expand(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenated ranges start .. start+len."""
    lens = lens.astype(np.int64)
    total = int(lens.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    first = np.repeat(starts.astype(np.int64) - (np.cumsum(lens) - lens), lens)
    return first + np.arange(total)
