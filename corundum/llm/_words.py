"""Words and shingles of whole text columns as numpy arrays, straight from Arrow buffers.

Texts are handled in blocks of about BLOCK bytes, so the temporary arrays stay small
however many rows a batch has; one text longer than that is hashed piece by piece."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_BASE = 0x9E3779B97F4A7C15 | 1


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at


def runs(at: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes together, one row at least."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def pieces(b: np.ndarray, word: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of one long text that are cut before a byte which is no part of a word."""
    lo = 0
    while len(b) - lo > most:
        gap = np.flatnonzero(~word[b[lo + most : lo + 2 * most]])
        hi = lo + most + (int(gap[0]) if len(gap) else most)
        if not len(gap):  # a word longer than a block stays whole
            rest = np.flatnonzero(~word[b[hi:]])
            hi = hi + int(rest[0]) if len(rest) else len(b)
        yield lo, hi
        lo = hi
    if lo < len(b) or not lo:
        yield lo, len(b)


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.random.default_rng(20_01).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64 bits that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bounds(b: np.ndarray, starts: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; `starts`: where texts begin in b, over which no word goes on."""
    inside = word[b]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    first = starts[(starts > 0) & (starts < len(b))]
    fresh[first] = inside[first]
    last[first - 1] = inside[first - 1]
    return np.flatnonzero(fresh), np.flatnonzero(last) + 1


def word_hashes(b: np.ndarray, starts: np.ndarray, word: np.ndarray = ~SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words (A-Z lower-cased), their first bytes and ends."""
    if not len(b):
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z
    s, e = bounds(b, starts, word)
    up, down = _powers(1 << max(20, int(len(b) - 1).bit_length()))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_letters()[LOWER[b]] * up[: len(b)], out=total[1:])
    return mix((total[e] - total[s]) * down[s]), s, e


def hashed_blocks(column: pa.Array, word: np.ndarray = ~SPACE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The word hashes of about a block of successive rows, and the n + 1 offsets of the rows in them."""
    b, at = text_bytes(column)
    for lo, hi in runs(at):
        part, starts = b[at[lo] : at[hi]], at[lo:hi] - at[lo]
        if len(part) <= 2 * BLOCK:
            h, s, _ = word_hashes(part, starts, word)
            yield h, np.searchsorted(s, np.append(starts, len(part)))
        else:
            h = np.concatenate([word_hashes(part[x:y], np.zeros(1, np.int64), word)[0] for x, y in pieces(part, word)])
            yield h, np.array([0, len(h)])


def hashed_rows(column: pa.Array, word: np.ndarray = ~SPACE) -> Iterator[np.ndarray]:
    """The word hashes of each row in turn."""
    for h, cuts in hashed_blocks(column, word):
        for k in range(len(cuts) - 1):
            yield h[cuts[k] : cuts[k + 1]]


def windows(h: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hashes of all runs of `width` words of a word sequence that has as many."""
    n = len(h) - width + 1
    total = np.full(n, np.uint64(seed))
    for k in range(width):
        total = mix(total ^ h[k : k + n]) + np.uint64(k)
    return total


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `width` words; of a shorter text the whole sequence is one."""
    width = min(width, len(h))
    return np.unique(windows(h, width, width)) if len(h) else h


def shingle_sets(h: np.ndarray, cuts: np.ndarray, width: int) -> list[np.ndarray]:
    """shingles() of each row of a block, hashed for all rows at once."""
    total, out = windows(h, width, width) if len(h) >= width else h[:0], []
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if hi - lo < width:
            out.append(shingles(h[lo:hi], width))
            continue
        own = np.sort(total[lo : hi - width + 1])
        fresh = own[1:] != own[:-1]
        out.append(own if fresh.all() else own[np.concatenate([[True], fresh])])
    return out
