"""Vectorised words of UTF-8 text inside Arrow batches.

A text column arrives as one byte buffer plus offsets; words are found and
hashed with numpy over the buffer, never character by character in Python.
All hashes are 64-bit and the same on every executor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)

# Words for shingles: anything but blank, tab, line feed, VT, FF, CR.
SPACE_WORDS = np.ones(256, dtype=bool)
SPACE_WORDS[[0x20, 9, 10, 11, 12, 13]] = False
# Words for contamination: ASCII digits and letters, and every non-ASCII character.
ALNUM_WORDS = np.zeros(256, dtype=bool)
ALNUM_WORDS[0x30:0x3A] = ALNUM_WORDS[0x41:0x5B] = ALNUM_WORDS[0x61:0x7B] = ALNUM_WORDS[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_lower = np.arange(256, dtype=np.uint64)
_lower[0x41:0x5B] += np.uint64(32)
_BYTE_VALUE = mix((_lower + np.uint64(1)) * _GOLD)  # lower-cases A-Z on the way
_pow = np.ones(1, dtype=np.uint64)
_inv = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    while len(_pow) < n:
        k = len(_pow)
        _pow = np.concatenate([_pow, _pow * np.uint64(pow(_BASE, k, 1 << 64))])
        _inv = np.concatenate([_inv, _inv * np.uint64(pow(_BASE_INV, k, 1 << 64))])
    return _pow, _inv


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    off = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    off = off.astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``most`` bytes (one longer text is a run of its own)."""
    n, a = len(off) - 1, 0
    while a < n:
        b = int(np.searchsorted(off, off[a] + most, side="right")) - 1
        b = max(a + 1, min(b, n))
        yield a, b
        a = b


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of each word in the buffer and first_word: the words of
    row i are those from first_word[i] to first_word[i + 1]."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    inside = is_word[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[off] = True
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return start, end, np.searchsorted(start, off)


#: Bytes whose prefix sums are held at once (or one longer word).
_SUM_BYTES = 1 << 18


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the (ASCII lower-cased) words, which are in order."""
    out = np.zeros(len(start), np.uint64)
    a = 0
    while a < len(start):
        lo = int(start[a])
        b = max(a + 1, int(np.searchsorted(end, lo + _SUM_BYTES, side="right")))
        hi = int(end[b - 1])
        power, inverse = _powers(hi - lo + 1)
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[data[lo:hi]] * power[:hi - lo], out=total[1:])
        first, last = start[a:b] - lo, end[a:b] - lo
        out[a:b] = mix((total[last] - total[first]) * inverse[first] + (last - first).astype(np.uint64) * _GOLD)
        a = b
    return out


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles, row by row, and their n + 1 offsets.
    A row with fewer words (but not none) has its whole sequence as one."""
    count = np.diff(first)
    n = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    off = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(int(off[-1]), np.uint64)
    if len(words) >= k:
        h = np.zeros(len(words) - k + 1, np.uint64)
        for j in range(k):
            h = h * _M2 + words[j:len(words) - k + 1 + j]
            h ^= h >> np.uint64(29)
        long = count >= k
        # position of every shingle in the word array
        at = np.arange(int(off[-1])) - np.repeat(off[:-1], n) + np.repeat(first[:-1], n)
        keep = np.repeat(long, n)
        out[keep] = mix(h[at[keep]] + np.uint64(k))
    for i in np.flatnonzero((count > 0) & (count < k)):
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for w in words[first[i]:first[i + 1]]:
                h = h * _M2 + w
                h ^= h >> np.uint64(29)
            out[off[i]] = mix(np.array([h + np.uint64(count[i])]))[0]
    return out, off


def sorted_sets(values: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row in ascending order, and their offsets."""
    rows = [np.unique(values[off[i]:off[i + 1]]) for i in range(len(off) - 1)]
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return flat.astype(np.uint64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def list_array(values: np.ndarray, off: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, kind))
