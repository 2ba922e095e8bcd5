import random

import pytest
from pyspark.sql import functions as F

from fleetscope.llm import jaccard, linededup
from fleetscope.llm.components import components

from .conftest import LONG, documents


def near(rng, line, changes):
    w = line.split(" ")
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(4, 40))) for _ in range(12)]
    hot = " ".join(rng.choice(vocab) for _ in range(30))
    texts = ["\n".join(near(rng, rng.choice(base), rng.randint(0, 3)) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    texts += [near(rng, hot, rng.randint(0, 4)) for _ in range(80)] + [hot] * 20
    return [*texts, None, "", "  \n\t", "One", "one", "a\n\nA\n\n", LONG, LONG + " x", *texts[:3]]


def lines_brute(texts, percent):
    sets = [(d, i, frozenset(w for w in line.lower().split() if w)) for d, t in enumerate(texts, 1) if t is not None for i, line in enumerate(t.split("\n"))]
    gone = set()
    for k, (d, i, s) in enumerate(sets):
        if s and any(o and 100 * len(s & o) >= percent * len(s | o) for _, _, o in sets[:k]):
            gone.add((d, i))
    return gone


@pytest.mark.parametrize("hot", [64, 3])
def test_line_dedup_against_brute_force(spark, corpus, monkeypatch, hot):
    monkeypatch.setattr(linededup, "HOT", hot)
    monkeypatch.setattr(linededup, "LEADERS", 1)
    docs = documents(spark, corpus)
    want = lines_brute(corpus, 80)
    got = {(r.doc_id, int(x)) for r in linededup.line_report(docs).collect() for x in r.removed.split(",") if x}
    assert got == want
    out = {r.doc.doc_id: r.doc for r in linededup.dedup_lines(docs).collect()}
    for d, t in enumerate(corpus, 1):
        left = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in want)
        assert out[d].text == left and out[d].score == 3.0 and out[d].line == "y"


def test_lines_of_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "d e")], "doc_id long, text string")
    out = sorted((r.doc.doc_id or 0, r.doc.text) for r in linededup.dedup_lines(docs).collect())
    assert out == [(0, "a b c"), (1, ""), (1, ""), (2, "d e")]
    report = sorted((r.doc_id or 0, r.n_lines, r.n_removed, r.removed) for r in linededup.line_report(docs).collect())
    assert report == [(0, 1, 0, ""), (1, 1, 1, "0"), (1, 1, 1, "0"), (2, 1, 0, "")]
    twice = spark.createDataFrame([(1, "a b c"), (1, "a b c\nx y\nx y")], "doc_id long, text string")
    assert sorted((r.n_lines, r.n_removed, r.removed) for r in linededup.line_report(twice).collect()) == [(1, 0, ""), (3, 2, "0,2")]
    assert linededup.line_report(docs.limit(0)).collect() == []


def test_signatures_tell_long_lines_apart(spark, monkeypatch):
    """Lines of 150 words that share half of them are no candidates; their texts are not moved."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    docs = documents(spark, ["\n".join(" ".join(rng.sample(vocab, 150)) for _ in range(5)) for _ in range(8)])
    rows, held = {}, linededup.held

    def counted(df, name, *a):
        out = held(df, name, *a)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(linededup, "held", counted)
    assert {r.n_removed for r in linededup.line_report(docs).collect()} == {0}
    assert rows["lines-classes"] == 40 and rows["lines-pairs"] <= 3


def shingles(text, k):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in lower.encode().split()]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components_brute(texts, k, percent):
    sets = [shingles(t, k) for t in texts]
    label = list(range(len(texts)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return {i + 1: (len(s), find(i) + 1) for i, s in enumerate(sets)}


@pytest.mark.parametrize(("hot", "block", "k", "percent"), [(32, 2048, 3, 90), (2, 5, 3, 90), (2, 7, 5, 80)])
def test_jaccard_against_brute_force(shipped, corpus, monkeypatch, hot, block, k, percent):
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(9)
    long = " ".join(f"v{i}" for i in range(120))
    texts = [*corpus, *(near(rng, long, rng.randint(0, 3)) for _ in range(60))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(documents(shipped, texts), k, percent).collect()}
    assert got == components_brute(texts, k, percent)


def test_words_that_meet_under_a_polynomial_stay_apart(shipped):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    docs = documents(shipped, [word, word.translate(str.maketrans("ab", "ba")), "x" * 70 + "y", "x" * 71, word])
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_scratch_tables_are_emptied_also_after_a_failure(spark):
    import os

    from fleetscope.llm.common import held, scratch_tables, settled

    def fails():
        held(spark.range(5).toDF("x"), "fails")
        raise ValueError

    with scratch_tables() as outer:
        kept = settled(lambda: held(spark.range(5).toDF("x"), "step").filter("x > 1"), "kept")
        with scratch_tables() as inner, pytest.raises(ValueError):
            settled(fails, "never")
    assert len(outer) == 1 and inner == [] and kept.count() == 3
    left = os.path.dirname(outer[0].removeprefix("file:"))
    assert all(spark.read.parquet(f"file:{left}/{n}").count() == 0 for n in os.listdir(left) if n.startswith(("fails-", "step-")))


def test_jaccard_of_repeated_null_and_no_rows(shipped):
    docs = shipped.createDataFrame([(1, "a b c d"), (1, "x y z"), (None, "x y z"), (2, "a b c d"), (3, None), (None, "")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()), key=repr)
    assert got == sorted([(1, 2, 1), (1, 1, None), (None, 1, None), (2, 2, 1), (3, 0, 3), (None, 0, None)], key=repr)
    assert jaccard.jaccard_components(docs.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    chain = [17, 11, 19, 13, 12, 18, 14, 16, 15]
    links = [*zip(chain, chain[1:]), *((5, x) for x in range(200, 230)), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 11 for i in chain}, 5: 5, **{x: 5 for x in range(200, 230)}}
