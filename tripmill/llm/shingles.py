"""Sets of hashed word shingles, computed for whole texts with array operations."""

from __future__ import annotations

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Odd, so every power has an inverse modulo 2 ** 64.
BASE = np.uint64(0x9E3779B97F4A7C15)
SEED = np.uint64(0xD6E8FEB86659FD93)
BLOCK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Mixed values of the bytes at each of the first places of a word, so that a word's hash is a sum
# without the algebra of a plain polynomial.
PLACES = 32
TABLE = mix(np.arange(PLACES * 256, dtype=np.uint64) * BASE + SEED).reshape(PLACES, 256)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words, in order; A-Z count as a-z."""
    data = LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    if not len(data):
        return np.empty(0, dtype=np.uint64)
    space = IS_SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    inside = np.flatnonzero(~space)
    place = inside - np.repeat(starts, lengths)
    values = TABLE[place % PLACES, data[inside]]
    far = place >= PLACES
    if far.any():
        values[far] = mix(values[far] + (place[far] // PLACES).astype(np.uint64) * BASE)
    firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64) * SEED)


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; fewer words count as one shingle of them all."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    if len(words) < n:
        width = len(words)
    else:
        width = n
    rows = len(words) - width + 1
    total = np.full(rows, np.uint64(width), dtype=np.uint64)
    for k in range(width):
        total = mix(total * BASE + words[k : k + rows])
    return np.unique(total)
