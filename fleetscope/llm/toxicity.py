"""Toxicity of whole texts, scored on their restored words.

A text's words (see ``deobfuscate``) give features: the word itself and its
beginnings of 4 to 6 letters. Features that are much commoner in labelled toxic
texts are kept, at most ``FEATURES``; a logistic regression on their presence
gives the score.

The classifier is fitted on at most ``FIT_ROWS`` labelled rows whose
crc32(doc_id as text) mod 5 is not 0, the smallest hashes of their ids: of toxic rows all,
up to half the sample, of clean rows as many as are left. Where a class has more rows, its
sample counts for all of them. The character model behind the restoration is counted over
all texts.

Defined results: null and empty texts are scored like a text without any known
feature; rows that repeat a doc_id are scored each; labels that contradict each
other count as several rows; without a toxic or without a clean label every
score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held
from .deobfuscate import Decoder, char_counts, costs, token_words, spaced_words, words_of

FIT_ROWS = 20_000
FEATURES = 4096
#: Toxic texts of the fit that a feature must occur in, at least: one in a hundred, and 6 where there are so many.
LEAST, LEAST_SHARE = 6, 100
FOLDS = 5
#: Tokens whose features a worker remembers; beyond, it starts anew.
MEMORY = 400_000


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def features(word: str) -> list[str]:
    return ["=" + word, *("^" + word[:n] for n in (4, 5, 6) if len(word) >= n)]


@dataclass
class Model:
    cost: np.ndarray
    index: dict[str, int]
    weights: np.ndarray
    bias: float


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.decoder, self.memory = model, Decoder(model.cost), {}

    def _of(self, words: list[str]) -> tuple[int, ...]:
        index = self.model.index
        return tuple({index[f] for w in words for f in features(w) if f in index})

    def found(self, text: str | None) -> set[int]:
        """The model's features in a text."""
        tokens = (text or "").lower().split()
        memory, out = self.memory, set()
        if len(memory) > MEMORY:
            memory.clear()
        for t in set(tokens):
            got = memory.get(t)
            if got is None:
                got = memory[t] = self._of(token_words(t, self.decoder))
            if got:
                out.update(got)
        if sum(len(t) == 1 for t in tokens) >= 3:
            out.update(self._of(spaced_words(tokens, self.decoder)))
        return out

    def score(self, text: str | None) -> float:
        x = self.model.bias + sum(self.model.weights[i] for i in sorted(self.found(text)))
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def logistic(rows: list[list[int]], y: np.ndarray, size: int, l2: float | np.ndarray = 0.5, rounds: int = 600, counts: np.ndarray | float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the log loss plus ``l2 / 2`` times the squared weights (Adam on all rows).

    A row counts as ``counts`` rows. The rarer a class, the further the weights must carry a text from the bias:
    beyond one in eight, ``l2`` falls as the square of the log odds."""
    counts = np.broadcast_to(counts, len(y))
    odds = np.log(((counts * y).sum() + 1) / ((counts * (1 - y)).sum() + 1))
    l2 = l2 * min(1.0, (np.log(7) / max(abs(odds), 1e-9)) ** 2)
    lens = np.array([len(r) for r in rows], np.int64)
    at = np.repeat(np.arange(len(rows)), lens)
    col = np.array([i for r in rows for i in r], np.int64)
    w = np.zeros(size + 1)
    w[size] = odds
    m, s = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(at, weights=w[col], minlength=len(rows)) + w[size], -30, 30)))
        d = counts * (p - y)
        g = np.append(np.bincount(col, weights=d[at], minlength=size) + l2 * w[:size], d.sum())
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8) * min(1.0, 2 * (1 - t / (rounds + 1)))
    return w[:size], float(w[size])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: int = FIT_ROWS) -> Model:
    spark = docs.sparkSession
    cost = costs(char_counts(docs, text))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    known = known.filter(fold(F.col("doc_id")) != 0)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = held(known.join(own.select("doc_id").distinct(), "doc_id", "left_semi"), "toxic-known")
    total = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    toxic = min(total.get(1, 0), max(fit_rows // 2, fit_rows - total.get(0, 0)))
    sample = [known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(k) for y, k in ((1, toxic), (0, fit_rows - toxic))]
    picked = held(sample[0].unionByName(sample[1]), "toxic-labels")  # the bounded sample
    train = held(own.join(picked, "doc_id").select("text", "y"), "toxic-train")
    sums = train.agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n")).first()
    pos, n = sums["pos"] or 0, sums["n"]
    if pos == 0 or pos == n:
        return Model(cost, {}, np.zeros(0), -30.0)
    shared = spark.sparkContext.broadcast(cost)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, seen = Decoder(shared.value), {}
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for f in {f for w in words_of(t or "", decoder) for f in features(w)}:
                    c = seen.setdefault(f, [0, 0])
                    c[y] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([c[1] for c in seen.values()], pa.int64()),
                                          pa.array([c[0] for c in seen.values()], pa.int64())], names=["f", "pos", "neg"])

    counts = train.mapInArrow(count, "f string, pos long, neg long").groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    rate = (F.col("pos") + 0.5) / (pos + 1)
    other = (F.col("neg") + 0.5) / (n - pos + 1)
    useful = counts.filter((F.col("pos") >= max(1, min(LEAST, pos // LEAST_SHARE))) & (rate > 20 * other)).orderBy(F.desc(F.col("pos") * F.log(rate / other)), "f").limit(FEATURES)
    kept = useful.select("f", "pos").collect()
    names = [r["f"] for r in kept]
    # what occurs in a few toxic texts only may do so by chance: it is weighted the less
    enough = min(LEAST, -(-pos // 4))
    doubt = np.array([(enough / min(enough, r["pos"])) ** 2 for r in kept])
    model = Model(cost, {f: i for i, f in enumerate(names)}, np.zeros(len(names)), 0.0)
    sent = spark.sparkContext.broadcast(model)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sorted(scorer.found(t)) for t in b.column(0).to_pylist()], pa.list_(pa.int32())), b.column(1)], names=["x", "y"])

    rows = train.mapInArrow(present, "x array<int>, y int").collect()  # as many as the sample has
    y = np.array([r["y"] for r in rows], float)
    stands_for = {1: total[1] / toxic, 0: total[0] / min(total[0], fit_rows - toxic)}  # labelled rows for each of the sample
    weights, bias = logistic([r["x"] for r in rows], y, len(names), l2=0.5 * doubt, counts=np.where(y == 1, stands_for[1], stands_for[0]))
    return Model(cost, model.index, weights, bias)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a column ``score`` (0 to 1) added, which may not be there before."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([scorer.score(t) for t in b.column(at).to_pylist()], pa.float64())],
                                             names=[*(f"c{i}" for i in range(b.num_columns)), "score"])

    schema = ", ".join([*(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)), "score double"])
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))).mapInArrow(run, schema).toDF(*docs.columns, "score")


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``. A row without a doc_id is not held out."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = score(own, fit(own, labels), "text")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
