"""Vectorised words and word shingles over Arrow string batches.

Texts are read straight from Arrow's buffers; words are maximal runs of
non-white-space bytes after lower-casing A-Z, each hashed to 64 bits with one
running sum per segment, so no Python string is made per word.  Segments are
cut at word ends, so memory stays bounded for texts of any length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20  # bytes hashed at a time
_STEP = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(20)
_BYTES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]  # A-Z hash as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and odd multiplications)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER = _powers(SEGMENT + 1)
_BACK = np.full(SEGMENT + 1, np.uint64(pow(int(_STEP), -1, 2**64)), dtype=np.uint64)
_BACK[0] = 1
_BACK = np.cumprod(_BACK, dtype=np.uint64)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if column.offset:
        column = pa.concat_arrays([column])
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def _segment(raw: np.ndarray, base: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of one segment; ``first`` marks the
    first byte of each text.  Segments longer than the power table (one giant
    word) are hashed in table-sized pieces that are then combined."""
    word = ~_SPACE[raw]
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:]
    begins = np.flatnonzero(start)
    if not len(begins):
        return begins, np.zeros(0, np.uint64)
    n = len(raw)
    if n <= SEGMENT:
        terms = _BYTES[raw] * _POWER[:n]
        terms[~word] = 0
        hashes = np.add.reduceat(terms, begins) * _BACK[begins]
    else:
        hashes = np.zeros(len(begins), np.uint64)
        for i, (a, b) in enumerate(zip(begins, np.append(begins[1:], n))):
            piece, total = raw[a:b], np.uint64(0)
            for j in range(0, len(piece), SEGMENT):
                part = piece[j:j + SEGMENT]
                terms = _BYTES[part] * _POWER[:len(part)]
                terms[_SPACE[part]] = 0
                with np.errstate(over="ignore"):
                    total = total * np.uint64(0xD6E8FEB86659FD93) + terms.sum(dtype=np.uint64)
            hashes[i] = total
    return begins + base, mix(hashes)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the index of its first
    word (one entry more than texts)."""
    n = len(raw)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    starts, hashes, a = [], [], 0
    while a < n:
        b = min(n, a + SEGMENT)
        if b < n:  # back to the last place where a word cannot go on
            cut = np.flatnonzero(_SPACE[raw[a + 1:b]] | first[a + 1:b])
            if len(cut):
                b = a + 1 + int(cut[-1])
            else:  # one word fills the segment: go on to its end
                while b < n and not (_SPACE[raw[b]] or first[b]):
                    rest = np.flatnonzero(_SPACE[raw[b:b + SEGMENT]] | first[b:b + SEGMENT])
                    b = b + int(rest[0]) if len(rest) else min(n, b + SEGMENT)
        at, h = _segment(raw[a:b], a, first[a:b])
        starts.append(at)
        hashes.append(h)
        a = b
    at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return h, np.searchsorted(at, offsets, side="left")


def shingles(h: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of ``size`` words; a
    shorter text gives one shingle of all its words, an empty one none."""
    n = len(h)
    if n == 0:
        return np.zeros(0, np.uint64)
    k = min(size, n)
    total = np.full(n - k + 1, np.uint64(k), dtype=np.uint64)
    for j in range(k):
        total = total + mix(h[j:n - k + 1 + j] * _PLACE[j])
    return np.unique(mix(total))
