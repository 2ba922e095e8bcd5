"""op12 against a plain scoring of every document, for blocks of items, classes, ties, nulls and repeats."""

import math
import random
import re
from collections import Counter

import pytest

from fleetscope.llm import ranking
from fleetscope.llm.ranking import TERM_PATTERN, rank_documents

from .conftest import LONG, documents


def terms(text):
    return re.findall(TERM_PATTERN, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    bag = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, total = sum(n > 0 for _, _, n in bag), sum(n for _, _, n in bag)
    df = Counter(t for _, c, _ in bag for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c, n in bag:
            if n:
                m = 50 + 50 * n * n_docs // total
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
                if s > 0:
                    found.append((-s, math.inf if doc is None else doc, doc))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: x[:2])[:k], 1)]
    return out


def items(spark, rows):
    return spark.createDataFrame([(i, t, 1, "d") for i, t in rows], "item_id long, text string, doc_id int, terms string")


WORDS = ["alpha", "Beta", "gamma", "naïve", "日本", "x1", "delta", "the", "of", "zeta"]


def given(seed, n):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(0, 8))) for _ in range(n)]
    return texts + texts[:30] + ["beta, the-of_x1"] * 40 + [None, "", "...", LONG]


@pytest.mark.parametrize(("k", "block", "cells"), [(5, 1 << 19, 1 << 21), (50, 6, 7), (3, 1, 40)])
def test_ranks_are_exact(shipped, monkeypatch, k, block, cells):
    monkeypatch.setattr(ranking, "CELLS", cells)
    texts = given(3, 150)
    asked = [(1, "Alpha beta beta!"), (2, "the 日本 NAÏVE"), (3, "x1"), (3, "x1"), (4, None), (5, "unknown words"), (None, "zeta of word")]
    got = rank_documents(documents(shipped, texts).repartition(3), items(shipped, asked), k=k, block_terms=block).collect()
    want = plain(list(enumerate(texts, 1)), asked, k)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_copies_cross_the_shuffle_as_k_rows(shipped):
    docs = documents(shipped, ["same text here"] * 500 + ["same", "other"])
    bag = ranking.bags(docs, [b"here", b"same", b"text"]).filter("size(terms) > 0").selectExpr("doc_id", "50 + n AS m", "terms", "counts")
    classes = ranking.bag_classes(bag, 7).collect()
    assert sorted((list(c.terms), list(c.counts), c.members) for c in classes) == [([0, 1, 2], [1, 1, 1], list(range(1, 8))), ([1], [1], [501])]


def test_null_and_repeated_ids_and_empty_tables(shipped):
    docs = documents(shipped, ["a b", "a b", "a"]).selectExpr("nullif(doc_id, 1) AS doc_id", "text", "n", "score")
    docs = docs.union(docs.filter("doc_id = 2"))
    asked = items(shipped, [(7, "a b")])
    got = rank_documents(docs, asked).orderBy("rank").collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in got] == [(7, 1, 2), (7, 2, 2), (7, 3, None), (7, 4, 3)]
    assert rank_documents(docs.limit(0), asked).collect() == []
    assert rank_documents(docs, asked.limit(0)).collect() == []
