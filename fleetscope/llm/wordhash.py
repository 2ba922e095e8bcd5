r"""Hashes of words and word shingles of many texts at once, in numpy.

Words are runs of bytes outside \x20 and \x09-\x0D with A-Z in lower case. A
word's hash is the sum of a number for each of its bytes at its place, drawn by
mixing byte and place (no polynomial: words that are built to meet under one, as a
Thue-Morse word and its complement, stay apart), mixed with its length; a shingle's
hash combines its words' hashes in order. Shingles are told apart by 56 bits.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SHINGLE_BITS = 56


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _drawn(letter: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A number for a byte at a place of a word."""
    return mix(mix(place.astype(np.uint64) * _BASE + np.uint64(1)) + letter.astype(np.uint64) * _M1)


#: Places whose numbers are kept in a table.
_SHORT = 64


@functools.cache
def _table() -> np.ndarray:
    return _drawn(np.tile(np.arange(256), _SHORT), np.repeat(np.arange(_SHORT), 256))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words per text)."""
    inside = ~_SPACE[data]
    if not inside.any():
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = offsets[:-1][offsets[:-1] < len(data)]
    begins[starts] = inside[starts]
    at = np.flatnonzero(begins)
    per = np.diff(np.searchsorted(at, offsets))
    letters = _LOWER[data[inside]]
    first = np.cumsum(inside)[at] - 1  # place of each word among the letters
    sizes = np.diff(np.append(first, len(letters)))
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    near = np.minimum(place, _SHORT - 1)
    drawn = _table()[near * 256 + letters]
    far = np.flatnonzero(place >= _SHORT)
    drawn[far] = _drawn(letters[far], place[far])
    h = np.add.reduceat(drawn, first)
    return mix(h + sizes.astype(np.uint64) * _M2), per


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct shingles of each text in ascending order, one text after the other; their number per text).

    A text with fewer than ``k`` words, but one, has its whole sequence as one shingle."""
    words, per = word_hashes(data, offsets)
    sizes = np.where(per >= k, per - k + 1, np.minimum(per, 1))
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.uint64), sizes
    word_at, at = np.cumsum(per) - per, np.cumsum(sizes) - sizes
    begin = np.arange(total) + np.repeat(word_at - at, sizes)
    length = np.repeat(np.minimum(per, k), sizes)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    h = np.zeros(total, np.uint64)
    for i in range(k):
        h = mix(h * _BASE + np.where(i < length, padded[begin + i], np.uint64(0)) + np.uint64(i + 1))
    h >>= np.uint64(64 - SHINGLE_BITS)
    for a, n in zip(at.tolist(), sizes.tolist(), strict=True):
        h[a:a + n].sort()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    new = np.ones(total, bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(sizes))


def digest64(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)
