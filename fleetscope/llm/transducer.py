"""A minimal acyclic transducer over byte strings: shared prefixes and suffixes, a number per word.

Words are added in sorted order; a state whose word ends are all known is
replaced by an equal one seen before (same finality, same arcs), so common
suffixes share states. Every arc carries the number of words that sort before
those behind it; the sum along a path is the word's number, which indexes the
table of outputs. The automaton is two dense arrays (states x byte classes) in
one file that workers memory-map.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

import numpy as np

_NAMES = ("next", "add", "final", "classes", "starts", "sizes", "ids")


class _State:
    __slots__ = ("arcs", "final", "number", "words")

    def __init__(self) -> None:
        self.arcs: dict[int, _State] = {}
        self.final, self.number, self.words = False, -1, 0

    def key(self) -> tuple:
        return (self.final, *((c, s.number) for c, s in self.arcs.items()))


def compile_words(words: Sequence[bytes], ids: Sequence[Sequence[int]], path: str) -> dict[str, int]:
    """Write the automaton of ``words`` with their id lists to ``path`` (.npy); give its sizes."""
    order = sorted(range(len(words)), key=lambda i: words[i])
    register: dict[tuple, _State] = {}
    states: list[_State] = []

    def settle(s: _State) -> _State:
        """``s``, or the equal state made before; its own arcs are settled already."""
        found = register.get(k := s.key())
        if found:
            return found
        s.number = len(states)
        states.append(s)
        register[k] = s
        s.words = s.final + sum(t.words for t in s.arcs.values())
        return s

    root = _State()
    trail: list[tuple[_State, int]] = []
    last, node = b"", root
    for i in order:
        w = words[i]
        if w == last and i != order[0]:
            raise ValueError("words must differ")
        common = len(os.path.commonprefix([w, last]))
        while len(trail) > common:
            parent, c = trail.pop()
            parent.arcs[c] = settle(parent.arcs[c])
        node = trail[-1][0].arcs[trail[-1][1]] if trail else root
        for c in w[common:]:
            node.arcs[c] = _State()
            trail.append((node, c))
            node = node.arcs[c]
        node.final = True
        last = w
    while trail:
        parent, c = trail.pop()
        parent.arcs[c] = settle(parent.arcs[c])
    root = settle(root)

    used = sorted({c for s in states for c in s.arcs})
    classes = np.zeros(256, np.int32)
    classes[used] = np.arange(1, len(used) + 1)
    width = len(used) + 1
    # state 0 is dead, the root is 1, others follow
    place = {s.number: k for k, s in enumerate([root, *(s for s in states if s is not root)], 1)}
    nxt = np.zeros((len(states) + 1, width), np.int32)
    add = np.zeros((len(states) + 1, width), np.int32)
    final = np.zeros(len(states) + 1, bool)
    for s in states:
        k, before = place[s.number], int(s.final)
        final[k] = s.final
        for c, t in s.arcs.items():
            nxt[k, classes[c]], add[k, classes[c]] = place[t.number], before
            before += t.words
    sizes = np.array([len(ids[i]) for i in order], np.int64)
    parts = dict(zip(_NAMES, (nxt, add, final, classes, np.cumsum(sizes) - sizes, sizes,
                              np.array([x for i in order for x in ids[i]], np.int32)), strict=True))
    head, at = [], 0
    for name in _NAMES:
        a = parts[name]
        head.append((name, a.dtype.str, a.shape, at))
        at += -(-a.nbytes // 64) * 64
    blob = np.zeros(at, np.uint8)
    for name, _, _, o in head:
        a = parts[name]
        blob[o:o + a.nbytes] = np.ascontiguousarray(a).view(np.uint8).ravel()
    np.save(path, blob)
    return {"states": len(states), "words": len(words), "layout": head}


class Transducer:
    """The automaton in a file of ``compile_words``, memory-mapped."""

    def __init__(self, path: str, layout: Sequence[tuple]) -> None:
        blob = np.load(path, mmap_mode="r")
        for name, kind, shape, at in layout:
            n = int(np.prod(shape)) * np.dtype(kind).itemsize
            setattr(self, name, blob[at:at + n].view(kind).reshape(shape))

    def numbers(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Number of each byte string ``data[s:s + n]``, or -1; all strings take a step at once."""
        classes = np.asarray(self.classes)
        width = self.next.shape[1]
        nxt, add = self.next.reshape(-1), self.add.reshape(-1)
        state, number = np.ones(len(starts), np.int64), np.zeros(len(starts), np.int64)
        alive, k = np.flatnonzero(sizes > 0), 0
        while len(alive):
            at = state[alive] * width + classes[data[starts[alive] + k]]
            number[alive] += add[at]
            state[alive] = nxt[at]
            k += 1
            alive = alive[(state[alive] > 0) & (sizes[alive] > k)]
        return np.where(np.asarray(self.final)[state] & (sizes > 0), number, -1)
