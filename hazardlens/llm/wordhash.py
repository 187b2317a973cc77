"""Words and word shingles of many texts at once as 64-bit hashes (numpy)."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: A random number for each byte at each of 64 places in a word, and one per place in a shingle.
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 64 * 256, dtype=np.uint64)
_PLACES = np.random.default_rng(6).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words end to end, and where each text's words begin (one more than texts).

    Words are runs of anything but space and ASCII control blanks."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    inside = ~blank
    first = inside.copy()
    first[1:] &= blank[:-1]
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    begins = np.concatenate([[0], np.cumsum(first)[text_ends - 1]]) if texts else np.zeros(1, np.int64)
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, np.uint64), begins
    starts = np.flatnonzero(first)
    place = at - starts[np.cumsum(first)[at] - 1]
    value = _BYTES[(place & 63) * 256 + data[at]]
    if place.max() > 63:
        value = value * ((place >> 6) * 2 + 1).astype(np.uint64)
    return mixed(np.add.reduceat(value, np.flatnonzero(first[at]))), begins


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles of one text's word hashes, sorted. A text of fewer words has one shingle of all."""
    n = min(size, len(hashes))
    if not n:
        return np.empty(0, np.uint64)
    total = np.full(len(hashes) - n + 1, np.uint64(n * int(_MIX) % (1 << 64)))
    for i in range(n):
        total += hashes[i:len(hashes) - n + 1 + i] * _PLACES[i]
    return np.unique(mixed(total))
