"""Noisy-channel restoration of disguised words under a character language model.

A writer hides a word by look-alike signs (1d10t), by separators (i.d.i.o.t, i d
i o t) or by repeating letters (idiooot). Each token that shows such a sign
becomes a lattice: every character may stand for some letters or for nothing, at
a cost. Viterbi search finds the cheapest letters under channel and language
model together. Plain words stay as they are.

The model is an interpolated character trigram model; its counts are gathered
from all texts of the corpus.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_chunks

#: Letters of the model; place 0 is the word border, the last one any other letter.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
SIZE = len(LETTERS) + 2
#: Look-alikes; fixed values of common usage.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i",
              "|": "il", "+": "t", "€": "e", "(": "c", "¡": "i", "£": "l", "¢": "c", "§": "s"}
LOOKALIKE_COST, REPEAT_COST, SINGLE_COST, SKIP_COST, MASK_COST = 0.5, 0.3, 8.0, 12.0, 3.0
MASKS = "*#?"
SEPARATORS = ".-_·'~ "
#: Characters on each side of a border in a spaced run, and what a border may cost.
NEAR, BORDER_COST = 12, 4.0
_INDEX = {c: i + 1 for i, c in enumerate(LETTERS)}


@functools.cache
def letter_table() -> np.ndarray:
    """Model place of every code point, case folded; 0 for what is not a letter."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x3000):
        if (ch := chr(c)).isalpha():
            out[c] = _INDEX.get(ch.lower()[:1], SIZE - 1)
    for c in range(0x3000, 0x30000):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            out[c] = SIZE - 1
    return out


def char_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(trigram, n): counts of letter triples over all whole texts; SIZE ** 3 rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for b in batches:
            for _, _, data, offsets in text_chunks(b.column(0)):
                raw = data.tobytes()
                cps = data if raw.isascii() else np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                c = np.concatenate([[0, 0], letter_table()[cps], [0]]).astype(np.int64)
                c = c[np.append(True, (c[1:] != 0) | (c[:-1] != 0))]  # one border between words
                c = np.append(0, c)
                total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["trigram", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n"))


def costs(counts: DataFrame) -> np.ndarray:
    """Negative log probabilities [before, last, next] of the interpolated model, from the counted triples."""
    tri = np.zeros(SIZE**3)
    for r in counts.collect():
        tri[r["trigram"]] = r["n"]
    tri = tri.reshape(SIZE, SIZE, SIZE)
    bi = tri.sum(axis=0)
    uni = bi.sum(axis=0) + 1.0
    share = lambda x: x / np.maximum(x.sum(axis=-1, keepdims=True), 1.0)
    p = 0.75 * share(tri) + 0.2 * share(bi)[None] + 0.05 * share(uni)[None, None]
    return -np.log(p).astype(np.float32)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each character or run of one letter: what it may stand for, and at what cost."""
    out: list[list[tuple[str, float]]] = []
    for m in re.finditer(r"(.)\1*", token, re.S):
        c, n = m[1], len(m[0])
        if c.isalpha():
            out.append([(c, 0.0)] if n == 1 else [(c * 2, 0.0), (c, SINGLE_COST)] if n == 2 else [(c, REPEAT_COST), (c * 2, 2 * REPEAT_COST)])
        elif c in LOOKALIKES:
            # look-alikes often repeat a letter: 00 is oo
            out.append([(x * k, LOOKALIKE_COST * k) for x in LOOKALIKES[c] for k in ((1,) if n == 1 else (1, 2))] + [("", SKIP_COST * n)])
        elif c in MASKS and n <= 2:
            out.extend([[("", SKIP_COST), *((x, MASK_COST) for x in LETTERS[:26])]] * n)
        else:
            out.append([("", 0.0 if c in SEPARATORS else SKIP_COST)])
    return out


@dataclass
class Decoder:
    """Restores tokens; remembers what it has restored."""

    cost: np.ndarray
    known: dict[str, str] = field(default_factory=dict)

    def decode(self, token: str) -> str:
        """The cheapest letters for a lower-case token, by Viterbi search over (last two letters)."""
        return self._remembered(token, lambda: self._search(lattice(token))[1])

    def undoubled(self, token: str) -> str:
        """A token of letters, read as written or as by a writer who doubles letters, whichever is cheaper.

        Doubling as a habit costs ``SINGLE_COST`` once, each doubled letter then ``REPEAT_COST``."""

        def best() -> str:
            plain = [[(c, 0.0)] for c in token]
            habit = [[(o[0][0], 0.0), (o[0][0][0], REPEAT_COST)] if len(o[0][0]) == 2 else o for o in lattice(token)]
            written, restored = self._search(plain), self._search(habit)
            return restored[1] if restored[0] + SINGLE_COST < written[0] else token

        return self._remembered("=" + token, best)

    def decode_run(self, run: list[str]) -> set[str]:
        """Words of a run of single characters, where a word may end after any of them.

        A border is taken where the reading with it costs at most ``BORDER_COST`` more than the one without it,
        by the ``NEAR`` characters on each side; every stretch of up to ``NEAR`` between borders is a word."""

        def read(a: int, b: int) -> tuple[float, str]:
            token = "".join(run[a:b])
            if token not in seen:
                seen[token] = self._search(lattice(token), self.any_word)
            return seen[token]

        n, seen = len(run), {}
        cuts = [0, *(i for i in range(1, n) if read(max(0, i - NEAR), i)[0] + read(i, min(n, i + NEAR))[0]
                     <= read(max(0, i - NEAR), min(n, i + NEAR))[0] + BORDER_COST), n]
        out = set()
        for k, i in enumerate(cuts[:-1]):
            out.update(read(i, j)[1] for j in cuts[k + 1:k + 1 + NEAR] if j <= i + NEAR)
            out.add(read(i, min(n, i + NEAR))[1])  # for its beginnings
        return out

    @functools.cached_property
    def any_word(self) -> np.ndarray:
        """The costs, with a word's first letter priced whatever the word before ends in."""
        first = np.exp(-self.cost[:, 0, :]).mean(axis=0)
        out = self.cost.copy()
        out[0, 0] = -np.log(first / first.sum())
        return out

    def _remembered(self, key: str, make: Callable[[], str]) -> str:
        if (got := self.known.get(key)) is None:
            if len(self.known) > 200_000:
                self.known.clear()
            got = self.known[key] = make()
        return got

    def _search(self, places: list[list[tuple[str, float]]], cost: np.ndarray | None = None) -> tuple[float, str]:
        """(cost, letters) of the cheapest path: of all that end in the same two letters the cheapest goes on, and no other
        is lost, as nothing behind depends on more than those two."""
        cost = self.cost if cost is None else cost
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for options in places:
            new: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (c, path) in states.items():
                for letters, price in options:
                    x, y, total = a, b, c + price
                    for ch in letters:
                        z = 0 if ch == " " else _INDEX.get(ch, SIZE - 1)
                        total += float(cost[x, y, z])
                        x, y = (y, z) if z else (0, 0)
                    if (x, y) not in new or total < new[x, y][0]:
                        new[x, y] = (total, (path, letters) if letters else path)
            states = new
        total, path = min(((c + float(cost[a, b, 0]), p) for (a, b), (c, p) in states.items()), key=lambda x: x[0])
        parts = []
        while path:
            path, letters = path
            parts.append(letters)
        return total, "".join(reversed(parts))


_ENDS = ".,;:!?\"'()[]{}<>%&#*-_=/\\~^`|+…»«“”„’"
_PARTS = re.compile(r"[^\W\d_]+")
_REPEAT = re.compile(r"([^\W\d_])\1\1")
_DOUBLE = re.compile(r"([^\W\d_])\1")


def token_words(token: str, decoder: Decoder) -> list[str]:
    """Words of one lower-case token: as written, and restored where it looks disguised."""
    if token.isalpha() and not _REPEAT.search(token):
        return _written(token, decoder)
    core = token.strip(_ENDS)
    if core.isalpha() and not _REPEAT.search(core):
        return [*_written(core, decoder), *([] if core == token.rstrip(_ENDS) else _edge(token, decoder))]
    core = re.sub(r"[$@€£¢§]{3,}$", "", core).rstrip(_ENDS)
    words = _PARTS.findall(core)
    if not words:
        return []
    plain = core.isalpha()
    if plain and not _REPEAT.search(core):
        return words
    return [*words, decoder.decode(core), *_edge(token, decoder)]


def _written(word: str, decoder: Decoder) -> list[str]:
    """A word of letters, and what it may be with doubled letters taken back."""
    if _DOUBLE.search(word) and (single := decoder.undoubled(word)) != word:
        return [word, single]
    return [word]


def _edge(token: str, decoder: Decoder) -> list[str]:
    """A look-alike that begins the token, as in |diot, is cut off with the punctuation; try it as a letter."""
    return [decoder.decode(token.rstrip(_ENDS))] if token[0] in LOOKALIKES and len(token) > 1 and token[1].isalnum() else []


def spaced_words(tokens: list[str], decoder: Decoder) -> list[str]:
    """Words written as single characters between blanks (three or more in a row)."""
    out, run = [], []
    for t in [*tokens, "  "]:
        c = t if len(t) == 1 else t.strip(_ENDS)
        if len(c) == 1 and (c.isalnum() or c in LOOKALIKES):
            run.append(c)
            continue
        if len(run) >= 3 and any(c.isalpha() for c in run):
            # a one-letter word may stand before or after
            out.extend(decoder.decode("".join(x)) for x in (run, run[1:], run[:-1]))
            out.extend(decoder.decode_run(run))  # or several words
        run = []
    return out


def words_of(text: str, decoder: Decoder) -> set[str]:
    """All distinct words of a whole text, restored ones included."""
    tokens = text.lower().split()
    found: set[str] = set()
    for t in set(tokens):
        found.update(token_words(t, decoder))
    if sum(len(t) == 1 for t in tokens) >= 3:
        found.update(spaced_words(tokens, decoder))
    found.discard("")
    return found
