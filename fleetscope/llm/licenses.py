"""License scans by patience alignment of texts with license templates.

Words that occur once in the template and once in a stretch of text are anchors;
the longest increasing run of anchors is kept, and the gaps between them are
aligned in the same way (equal words at a gap's ends are matched first).
Coverage is the share of the template's words that the alignment matches.

A text is cut into overlapping windows of three times the template's length, one
length apart, so that every stretch of up to twice the length lies whole in one
of them. A window is aligned only if the words it has in common with the
template, counted with repeats, could reach the coverage; that bound skips no
window that would. Whole texts are scanned, each in one pass.

Names: with ``named`` (as the query has it) a hit counts only if the words that
tell its license from its neighbours (``IDENTITY``) are all matched, side by side and
without a foreign word before, among or after them up to the next matched words; other
hits are kept as not identified. A hit whose place meets that of a better one (an
identified one first, then the longer template) gives way to it.

Defined results: null and empty texts have no license; rows that repeat a doc_id
are scanned each; of equal coverages the longer template wins, then the smaller
name, then the earlier place.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COVERAGE = 0.8
#: Texts of public licenses and of the notices that name them.
TEMPLATES: dict[str, str] = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution."),
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "mit-notice": "Released under the MIT License.",
}
_CC_KINDS = {"by-sa": "ShareAlike", "by-nc": "NonCommercial", "by-nd": "NoDerivatives", "by-nc-sa": "NonCommercial-ShareAlike", "by-nc-nd": "NonCommercial-NoDerivatives"}
_GNU = {"gpl": "GNU General", "lgpl": "GNU Lesser General", "agpl": "GNU Affero General"}
_GNU_KNOWN = [("gpl", "2", "2.0"), ("gpl", "3", "3.0"), ("lgpl", "2.1", "2.1"), ("lgpl", "3", "3.0"), ("agpl", "3", "3.0")]
_BSD_3 = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
          "software without specific prior written permission.")
#: Neighbours of the templates, whose texts would otherwise pass for them.
RELATED: dict[str, str] = {
    **{f"{k}-{n}-notice": f"This work is licensed under the {_GNU[k]} Public License, version {v}." for k, v, n in _GNU_KNOWN},
    **{f"{k}-{n}-header": TEMPLATES["gpl-3.0-header"].replace("GNU General", _GNU[k]).replace("version 3", f"version {v}") for k, v, n in _GNU_KNOWN},
    **{f"cc-{k}-{v}-notice": f"Licensed under CC {k.upper()} {v}." for k in ("by-nc", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd") for v in ("3.0", "4.0")},
    **{f"cc-by-{v}-short-notice": f"Licensed under CC BY {v}." for v in ("3.0", "4.0")},
    **{f"cc-{k}-4.0-long-notice": f"This work is licensed under a Creative Commons Attribution-{x} 4.0 International License." for k, x in _CC_KINDS.items()},
    **{f"cc-{k}-3.0-long-notice": f"This work is licensed under a Creative Commons Attribution-{x} 3.0 Unported License." for k, x in _CC_KINDS.items()},
    "cc-by-3.0-long-notice": "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "bsd-3-clause": TEMPLATES["bsd-2-clause"] + " 3. " + _BSD_3,
    "bsd-4-clause": (
        TEMPLATES["bsd-2-clause"] + " 3. All advertising materials mentioning features or use of this software must display the following "
        "acknowledgement: This product includes software developed by the organization. 4. " + _BSD_3),
    "bsd-notice": "Released under the BSD License.",
    "isc-notice": "Released under the ISC License.",
}
RELATED = {n: t for n, t in RELATED.items() if n not in TEMPLATES}
#: Words, in order, that tell a template's license from others; templates without them need none.
IDENTITY: dict[str, list[str]] = {
    **{n: ["apache license version 2 0"] for n in ("apache-2.0-notice", "apache-2.0-header")},
    **{f"{k}-{n}-notice": [f"{_GNU[k]} Public License version {v}"] for k, v, n in _GNU_KNOWN},
    **{f"{k}-{n}-header": [f"{_GNU[k]} Public License", f"version {v} of the License"] for k, v, n in _GNU_KNOWN},
    **{n: [t.split("under ")[1].removeprefix("a ").removesuffix(" License.")] for n, t in (TEMPLATES | RELATED).items() if n.startswith("cc-")},
    **{f"{n}-notice": [f"{n} License"] for n in ("mit", "bsd", "isc")},
    "bsd-3-clause": ["neither the name"],
    "bsd-4-clause": ["all advertising materials"],
    "mit": ["this permission notice shall be included in all copies"],
}
_WORD = re.compile(r"[^\W_]+")


def scan_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs (ordered by the first) with increasing seconds."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(tops, y)
        back.append(at[k - 1] if k else -1)
        tops[k:k + 1], at[k:k + 1] = [y], [i]
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places (in a, in b), ascending, by patience alignment."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        place = {w: k for k, w in enumerate(b[j:n], j) if in_b[w] == 1}
        anchors = _increasing([(k, place[w]) for k, w in enumerate(a[i:m], i) if in_a[w] == 1 and w in place])
        if anchors:
            for (p, q), (r, s) in zip([(i - 1, j - 1), *anchors], [*anchors, (m, n)], strict=True):
                todo.append((p + 1, r, q + 1, s))
            out.extend(anchors)
    return sorted(out)


@dataclass
class Template:
    name: str
    words: list[str]
    counts: Counter
    identity: list[list[str]]

    def places(self, words: list[str], least: int) -> list[tuple[int, int, int, list[tuple[int, int]]]]:
        """(matched, first word, last word, alignment) of all places with at least ``least`` matches that do not overlap.

        Of overlapping places the one with the most matches less foreign words stays. Within each window, shorter
        ones are aligned too: copies that follow each other closely have no word that occurs once in the longer."""
        m = len(self.words)
        mine = [k for k, w in enumerate(words) if w in self.counts]
        if len(mine) < least:
            return []
        found, done, tried = [], -1, set()
        for k in mine:
            start = max(0, (k // m - 1) * m)  # windows that begin up to one length before the word
            for s in (start, start + m):
                if s <= done or s >= len(words):
                    continue
                done = s
                if not self._could(words[s:s + 3 * m], least):
                    continue
                step = max(1, m // 4)
                for a, b in [(s, s + 3 * m), *((x, x + m + step) for x in range(s, min(s + 2 * m, len(words)), step))]:
                    if (a, b) in tried or not self._could(words[a:b], least):
                        continue
                    tried.add((a, b))
                    got = [(i, a + j) for i, j in align(self.words, words[a:b])]
                    if len(got) >= least:
                        found.append((len(got), got[0][1], got[-1][1], got))
        out: list[tuple[int, int, int, list[tuple[int, int]]]] = []
        ends: list[tuple[int, int]] = []
        for x in sorted(found, key=lambda x: (x[2] - x[1] - 2 * x[0], x[1])):
            at = bisect_left(ends, (x[1], x[2]))
            if (at == 0 or ends[at - 1][1] < x[1]) and (at == len(ends) or x[2] < ends[at][0]):
                ends.insert(at, (x[1], x[2]))
                out.append(x)
        return sorted(out, key=lambda x: x[1])

    def _could(self, window: list[str], least: int) -> bool:
        have = Counter(w for w in window if w in self.counts)
        return sum(min(c, self.counts[w]) for w, c in have.items()) >= least

    def identified(self, got: list[tuple[int, int]]) -> bool:
        """Whether each phrase of the license's identity is matched, with no foreign word in its gaps."""
        place = dict(got)
        inner = {i: k for k, (i, _) in enumerate(got)}
        for phrase in self.identity:
            n = len(phrase)
            p = next(i for i in range(len(self.words)) if self.words[i:i + n] == phrase)
            if any(i not in place for i in range(p, p + n)):
                return False
            k = inner[p]
            run = got[max(0, k - 1):k + n + 1]
            if any(y[1] != x[1] + 1 for x, y in zip(run, run[1:])):
                return False
        return True


Hit = tuple[float, int, str, int, int, bool]  # coverage, template's words, name, first word, last word, identified


def settle(hits: list[Hit]) -> list[Hit]:
    """Hits that stay where places meet: an identified one first, then the longer template, the better covered, the smaller name."""
    out: list[Hit] = []
    for h in sorted(hits, key=lambda h: (not h[5], -h[1], -h[0], h[2], h[3])):
        if all(h[4] < o[3] or o[4] < h[3] for o in out):
            out.append(h)
    return out


def templates(texts: Mapping[str, str]) -> list[Template]:
    return [Template(n, w, Counter(w), [scan_words(x) for x in IDENTITY.get(n, [])]) for n, t in sorted(texts.items()) if (w := scan_words(t))]


def scan_licenses(docs: DataFrame, texts: Mapping[str, str] | None = None, coverage: float = COVERAGE, doc_id: str = "doc_id", text: str = "text", named: bool = False) -> DataFrame:
    """doc_id, license, coverage, first_word, last_word, n_found, hits: one row per row of ``docs``.

    The best covered template of at least ``coverage``, with its place among the
    text's words, and the number of templates that reach it; nulls where none does.
    ``hits`` has every place of every template that reaches it, by place, and whether its
    license is identified. With ``named``, the neighbouring licenses are templates too, hits
    are settled by ``settle``, and the other columns take identified ones only."""
    texts = dict((TEMPLATES | RELATED if named else TEMPLATES) if texts is None else texts)

    place = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("identified", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [(t, -int(-coverage * len(t.words) // 1)) for t in templates(texts)]
        vocabulary = {w for t, _ in known for w in t.counts}
        # so many different words any covering stretch has: the commonest words of the template count most
        distinct = []
        for t, least in known:
            got, k = 0, 0
            for k, c in enumerate(sorted(t.counts.values(), reverse=True), 1):
                got += c
                if got >= least:
                    break
            distinct.append(k)
        for b in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for x in b.column(1).to_pylist():
                words = scan_words(x or "")
                here = vocabulary.intersection(words)
                hits = []
                for (t, least), k in zip(known, distinct, strict=True):
                    if len(here) >= k and len(here & t.counts.keys()) >= k:
                        hits.extend((n / len(t.words), len(t.words), t.name, first, last, t.identified(got)) for n, first, last, got in t.places(words, least))
                if named:
                    hits = settle(hits)
                best = min((h for h in hits if h[5] or not named), key=lambda h: (-h[0], -h[1], h[2], h[3]), default=None)
                row = (None, None, None, None) if best is None else (best[2], best[0], best[3], best[4])
                every = [{"license": h[2], "coverage": h[0], "first_word": h[3], "last_word": h[4], "identified": h[5]} for h in sorted(hits, key=lambda h: (h[3], h[4], h[2]))]
                for c, v in zip(cols, (*row, len({h[2] for h in hits if h[5] or not named}), every), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int32(), place), strict=True))],
                                             names=["doc_id", "license", "coverage", "first_word", "last_word", "n_found", "hits"])

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(run, "doc_id long, license string, coverage double, first_word long, last_word long, n_found int, "
                               "hits array<struct<license string, coverage double, first_word long, last_word long, identified boolean>>")
