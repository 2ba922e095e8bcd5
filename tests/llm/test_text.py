import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetscope.llm.deobfuscate import Decoder, char_counts, costs, words_of
from fleetscope.llm.licenses import TEMPLATES, align, scan_licenses, scan_words
from fleetscope.llm.toxicity import fit, fold, score, toxicity

from .conftest import LONG, documents


@pytest.fixture(scope="module")
def labelled(shipped):
    rng = random.Random(1)
    plain = ["the", "house", "green", "walked", "river", "stone", "evening", "quiet", "letter", "window"]
    bad = ["moron", "idiot", "scumbag"]
    texts, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 40))]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad)
        texts.append(" ".join(words))
        labels.append((i + 1, int(toxic)))
    docs = documents(shipped, texts)
    return docs, shipped.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy_and_disguises(shipped, labelled):
    docs, labels = labelled
    out = toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(out) == 600 and len(held) > 60
    assert sum(r.predicted == r.toxic for r in held) / len(held) >= 0.97
    model = fit(docs.select("doc_id", "text"), labels)
    asked = ["a m0r0n", "an 1d10t!", "m o r o n", "i.d.i.o.t", "moroooon", "the quiet river", "", None, LONG, "the 1st of 20 windows, 3 stones"]
    got = [r.score for r in score(shipped.createDataFrame([(t,) for t in asked], "text string").coalesce(1), model).collect()]
    assert all(s >= 0.5 for s in got[:5]) and all(s < 0.5 for s in got[5:]), got
    assert got[6] == got[7]


def test_without_labels_everything_scores_zero(shipped, labelled):
    docs, labels = labelled
    some = docs.limit(5)
    assert all(r.score < 1e-9 for r in toxicity(some, labels.limit(0)).collect())
    assert toxicity(docs.limit(0), labels).collect() == []
    odd = docs.limit(20).selectExpr("nullif(doc_id, 1) AS doc_id", "text").union(docs.limit(2).select("doc_id", "text"))
    out = toxicity(odd, labels).collect()
    assert len(out) == 22 and all(r.held_out in (True, False) for r in out) and [r.held_out for r in out if r.doc_id is None] == [False]


def test_fold_is_the_checksum_of_the_decimal_id(shipped):
    import zlib
    got = shipped.range(50).select("id", fold(F.col("id")).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_plain_words_stay_and_restored_ones_are_added(shipped, labelled):
    decoder = Decoder(costs(char_counts(labelled[0])))
    assert words_of("The (green) house, 1994.", decoder) == {"the", "green", "house"}
    assert "idiot" in words_of("you id!ot", decoder) and "river" in words_of("r-i-v-e-r", decoder)


def lcs(a, b):
    best = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + (x == y))
    return int(best[-1, -1])


def test_alignments_are_increasing_matches_close_to_the_longest():
    rng = random.Random(4)
    base = scan_words(TEMPLATES["mit"])
    for _ in range(30):
        other = [w for w in base if rng.random() > 0.1]
        for _ in range(rng.randint(0, 8)):
            other.insert(rng.randrange(len(other)), rng.choice([*base, "zzz"]))
        got = align(base, other)
        assert all(base[i] == other[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
        assert lcs(base, other) * 0.9 <= len(got) <= lcs(base, other)
    assert align([], ["a"]) == [] and align(["a"] * 5, ["a"] * 3) == [(0, 0), (1, 1), (2, 2)]


def brute(text):
    """Best coverage by the longest common subsequence of every window, for short texts."""
    words, found = scan_words(text or ""), {}
    for name, t in TEMPLATES.items():
        ref = scan_words(t)
        span = [words[s:s + 3 * len(ref)] for s in range(0, max(1, len(words)), len(ref))]
        found[name] = max((lcs(ref, w) / len(ref) for w in span if sum((Counter(ref) & Counter(w)).values()) >= 0.8 * len(ref)), default=0)
    return {n for n, c in found.items() if c >= 0.8}


def test_scan_against_brute_force(shipped):
    noise = "of the and under this a license software work"
    rng = random.Random(8)
    texts = [None, "", "nothing here", LONG + " " + TEMPLATES["mit-notice"] + " " + "tail " * 50]
    for t in TEMPLATES.values():
        w = t.split()
        texts += [t, f"Intro. {t} Outro.", " ".join(x for x in w if rng.random() > 0.05), t + "\n" + t, " ".join(w[:len(w) // 2])]
    texts += [" ".join(rng.choice(noise.split()) for _ in range(200)) for _ in range(5)]
    rows = {r.doc_id: r for r in scan_licenses(documents(shipped, texts)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts, 1):
        want = brute(t) if i != 4 else {"mit-notice"}
        assert (rows[i].license in want) if want else rows[i].license is None, (t, rows[i], want)
        assert rows[i].n_found == len(want)
    assert rows[4].first_word == 50_001 and rows[4].last_word == 50_005 and rows[4].coverage == 1.0
    assert scan_licenses(documents(shipped, texts).limit(0)).collect() == []


def test_the_cheapest_reading_is_found(shipped, labelled):
    """Viterbi search against every path through the lattice."""
    import itertools
    import random

    from fleetscope.llm.deobfuscate import _INDEX, SIZE, lattice

    decoder = Decoder(costs(char_counts(labelled[0])))
    rng = random.Random(4)
    signs = [*"aeioustnr", *"01345@$!", "*", "oo", "tt", "."]
    for _ in range(60):
        token = "".join(rng.choices(signs, k=rng.randint(1, 6)))
        if token.count("*") > 2:
            continue
        places = lattice(token)
        least = np.inf
        for path in itertools.product(*places):
            total, x, y = sum(p for _, p in path), 0, 0
            for ch in "".join(letters for letters, _ in path):
                z = _INDEX.get(ch, SIZE - 1)
                total, x, y = total + float(decoder.cost[x, y, z]), y, z
            least = min(least, total + float(decoder.cost[x, y, 0]))
        assert decoder._search(places)[0] == pytest.approx(least, rel=1e-6), token
