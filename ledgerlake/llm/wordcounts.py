"""Exact counts of words: hashes by seed, word strings, and a count per run.

A word is lower-cased in A-Z only.  Hashes have 64 bits and are the same on
every executor; the table of counts carries the words themselves, so that two
words with one hash can be told apart (and another seed taken).
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from ledgerlake.llm import vectext as vt

RUN_BYTES = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@functools.lru_cache(maxsize=8)
def _values(seed: int) -> np.ndarray:
    return vt.mix((LOWER.astype(np.uint64) + np.uint64(1 + 1000 * seed)) * vt._GOLD)


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of the lower-cased words."""
    if not len(start):
        return np.zeros(0, np.uint64)
    power, inverse = vt._powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_values(seed)[data] * power[:len(data)], out=total[1:])
    return vt.mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * vt._GOLD)


def word_strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The lower-cased words as an Arrow string column."""
    size = end - start
    off = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - off[:-1], size) + np.arange(int(off[-1]))
    return pa.Array.from_buffers(pa.large_string(), len(start),
                                 [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(LOWER[data[at]])]).cast(pa.string())


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the first place of each, and how often each occurs."""
    return np.unique(keys, return_index=True, return_counts=True)
