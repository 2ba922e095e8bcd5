r"""Byte-level pre-tokens of many texts at once, in numpy.

The split is the one of byte-level BPE vocabularies, whose pattern is
``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+``.
All alternatives but the contractions depend on the classes of neighbouring
characters alone, so token starts come from comparing a class array with itself
shifted by one. The class of a character that may differ between Unicode versions is
asked of the tokenizer's own pre-tokenizer, once per worker. Texts that hold the
vocabulary's special strings are reported as odd; the callers give those whole to the
tokenizers library.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from dataclasses import dataclass

import numpy as np

OTHER, LETTER, NUMBER, SPACE, UNSURE = range(5)
#: White_Space of Unicode.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point; UNSURE where Unicode 3.2 and today's do not agree."""
    out = np.full(0x110000, UNSURE, np.uint8)
    old = unicodedata.ucd_3_2_0.category
    kinds = {"L": LETTER, "N": NUMBER, "M": OTHER, "P": OTHER, "S": OTHER, "C": OTHER, "Z": OTHER}
    for c in range(0x30000):
        if 0xD800 <= c < 0xE000:
            continue
        a, b = old(chr(c)), unicodedata.category(chr(c))
        if a != "Cn" and a[0] == b[0]:
            out[c] = kinds[a[0]]
    out[WHITE] = SPACE
    out[0x180E] = UNSURE
    return out


@functools.cache
def classes_of(path: str) -> np.ndarray:
    """The classes as a tokenizer sees them; ``asked`` fills in what is UNSURE when a text holds it."""
    return classes().copy()


def asked(path: str, cps: np.ndarray) -> np.ndarray:
    """The classes of code points by the tokenizer's pre-tokenizer: a character goes on with a letter, a digit or a sign
    before it if it is one itself, and white space with none of them."""
    probe = "".join(f"a{c}\n1{c}\n!{c}\n" for c in map(chr, cps.tolist()))
    begins = np.zeros(len(probe), bool)
    begins[[a for _, (a, _) in library(path).pre_tokenizer.pre_tokenize_str(probe)]] = True
    joined = ~begins.reshape(-1, 9)[:, [1, 4, 7]]
    return np.where(joined.any(axis=1), np.array([LETTER, NUMBER, OTHER], np.uint8)[joined.argmax(axis=1)], SPACE).astype(np.uint8)


@functools.cache
def special_strings(path: str) -> tuple[bytes, ...]:
    with open(path, encoding="utf-8") as f:
        return tuple(t["content"].encode() for t in json.load(f).get("added_tokens", []))


@functools.cache
def library(path: str):
    """The tokenizers library's encoder, one per Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@dataclass
class Pieces:
    """Tokens of a chunk: byte ``start`` and ``end``, index ``doc`` of their text."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    odd: np.ndarray  # indexes of the texts that are to go to the library; they have no tokens here


def split(data: np.ndarray, offsets: np.ndarray, specials: tuple[bytes, ...] = (), tokenizer: str | None = None) -> Pieces:
    """Tokens of a chunk of texts. Without a ``tokenizer`` to ask, texts with characters of unsure class are odd too."""
    n_docs = len(offsets) - 1
    odd = np.zeros(n_docs, bool)
    raw = data.tobytes()
    for s in specials:
        at = raw.find(s)
        while at >= 0:
            odd[np.searchsorted(offsets, at, side="right") - 1] = True
            at = raw.find(s, at + 1)
    if raw.isascii():
        cps, where, marks = data, None, offsets
    else:
        cps = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        where = np.flatnonzero((data & 0xC0) != 0x80)
        marks = np.searchsorted(where, offsets)
        where = np.append(where, len(data))
    n = len(cps)
    if n == 0:
        e = np.zeros(0, np.int64)
        return Pieces(e, e, e, np.flatnonzero(odd))
    cls = (classes() if tokenizer is None else classes_of(tokenizer))[cps]
    if tokenizer is not None and (cls == UNSURE).any():
        new = np.unique(cps[cls == UNSURE])
        classes_of(tokenizer)[new] = asked(tokenizer, new)
        cls = classes_of(tokenizer)[cps]
    if (cls == UNSURE).any():
        odd[np.unique(np.searchsorted(marks, np.flatnonzero(cls == UNSURE), side="right") - 1)] = True
    first = np.zeros(n + 1, bool)
    first[marks] = True
    begins = np.ones(n + 1, bool)
    begins[1:n] = cls[1:] != cls[:-1]
    begins |= first
    # the last character of a white-space run stands alone, or goes with what follows if it is a blank
    after = np.flatnonzero(begins[1:n] & ~first[1:n] & (cls[1:] != SPACE) & (cls[:-1] == SPACE)) + 1
    begins[after - 1] = True
    begins[after[cps[after - 1] == 0x20]] = False
    # contractions: an apostrophe that begins a token, before certain letters
    apostrophe = np.flatnonzero((cps == 0x27) & begins[:n])
    if len(apostrophe):
        padded = np.concatenate([cps, np.zeros(3, cps.dtype)])
        inside = np.concatenate([~first[:n], np.zeros(3, bool)])
        a, b = padded[apostrophe + 1], padded[apostrophe + 2]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8)) & inside[apostrophe + 1]
        pairs = ((a == 0x72) & (b == 0x65)) | ((a == 0x76) & (b == 0x65)) | ((a == 0x6C) & (b == 0x6C))
        two = pairs & inside[apostrophe + 1] & inside[apostrophe + 2]
        begins[apostrophe[one] + 1] = False
        begins[apostrophe[one] + 2] = True
        begins[apostrophe[two] + 1] = False
        begins[apostrophe[two] + 3] = True
    starts = np.flatnonzero(begins[:n])
    ends = np.append(starts[1:], n)
    docs = np.searchsorted(marks, starts, side="right") - 1
    if where is not None:
        starts, ends = where[starts], where[ends]
    if odd.any():
        keep = ~odd[docs]
        starts, ends, docs = starts[keep], ends[keep], docs[keep]
    return Pieces(starts, ends, docs, np.flatnonzero(odd))


_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
SHORT = 16


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[s:s + n]`` of all (s, n), one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int64)
    at += np.repeat(starts - (ends - sizes), sizes)
    return values[at]


def texts_of(data: np.ndarray, p: Pieces, which: np.ndarray) -> list[bytes]:
    """The bytes of the given tokens."""
    raw = data.tobytes()
    return [raw[s:e] for s, e in zip(p.start[which].tolist(), p.end[which].tolist(), strict=True)]


def distinct(data: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """One token index for each distinct token of a chunk, and for each token the number of its own.

    Tokens up to 16 bytes are compared as two whole words of 64 bits, longer
    ones (and those with a NUL) as Python bytes: no two tokens are ever taken
    for one because of a hash."""
    size = p.end - p.start
    padded = np.concatenate([data, np.zeros(SHORT, np.uint8)])
    grid = np.lib.stride_tricks.sliding_window_view(padded, SHORT)[p.start]
    short = size <= SHORT
    grid = np.where(np.arange(SHORT) < size[:, None], grid, 0).astype(np.uint8)
    if (data == 0).any():
        short &= ((grid == 0).sum(axis=1) == SHORT - size)
    words = np.ascontiguousarray(grid).view(np.uint64)
    lo, hi = words[:, 0], words[:, 1]
    h = lo * _MIX[0]
    h ^= h >> np.uint64(29)
    h += hi * _MIX[1]
    h ^= h >> np.uint64(32)
    code = np.zeros(len(size), np.int64)
    at = np.flatnonzero(short)
    _, one, inv = np.unique(h[at], return_index=True, return_inverse=True)
    rep = at[one]
    same = (lo[rep[inv]] == lo[at]) & (hi[rep[inv]] == hi[at])
    code[at] = inv
    rest = np.concatenate([np.flatnonzero(~short), at[~same]])
    if len(rest):
        known: dict[bytes, int] = {}
        more = []
        for i, t in zip(rest.tolist(), texts_of(data, p, rest), strict=True):
            if t not in known:
                known[t] = len(rep) + len(more)
                more.append(i)
            code[i] = known[t]
        rep = np.concatenate([rep, np.array(more, np.int64)])
    return rep, code
