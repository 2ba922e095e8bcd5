"""Approximate nearest neighbours with learned partitions.

Fit, on at most ``SAMPLE`` vectors (the smallest hashes of their ids): the exact
neighbour graph of the sample is cut into parts of nearly equal size (labels move
to where most of a vertex's neighbours are, while the part has room); a small
network learns a vertex's part from its vector, and from its neighbours' parts.

Index: every vector of the table goes to its most probable part. Parts are
stored in shards of fixed size, so a part that holds a third of all rows is
many tiles. Search: the network gives a query's most probable parts; ``probes``
of them are searched whole, in double precision, and the top lists merged.
``probes`` is the least number that finds ``RECALL`` of the sample's own
neighbours; a query whose parts hold too few rows goes on to the next most
probable ones until they hold k and itself.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite
component take no part, nor do those of another length than the most frequent
one (of equal counts the smaller); rows that repeat a vec_id count each; a query
returns k rows, or all candidates if the table has fewer. A table that fills fewer than
two parts of ``PART_ROWS`` is one part, searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held
from .vectors import QUERY_ROWS, SHARD_ROWS, clean, matrix, merge_top, tile_top

SAMPLE = 4096
#: Vectors of the sample for each part, and rows of the table, at least.
PART_SAMPLE, PART_ROWS = 128, 128
NEIGHBOURS = 10
RECALL = 0.97


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row."""
    norm = (x * x).sum(axis=1)
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 512):
        d = norm[a:a + 512, None] + norm - 2 * x[a:a + 512] @ x.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        out[a:a + 512] = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1)
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, seed: int = 7, rounds: int = 12) -> np.ndarray:
    """A part for each vertex; no part holds more than 1.1 times its share."""
    rng = np.random.default_rng(seed)
    n, room = len(x), int(np.ceil(1.1 * len(x) / parts))
    # grow from seeds: each vertex, by distance to its nearest seed, takes the nearest part with room
    seeds = x[rng.choice(n, parts, replace=False)]
    d = (x * x).sum(1)[:, None] + (seeds * seeds).sum(1) - 2 * x @ seeds.T
    prefer = np.argsort(d, axis=1, kind="stable")
    label, size = np.full(n, -1), np.zeros(parts, np.int64)
    for v in np.argsort(d.min(axis=1), kind="stable").tolist():
        for p in prefer[v].tolist():
            if size[p] < room:
                label[v], size[p] = p, size[p] + 1
                break
    both = [list(r) for r in near.tolist()]
    for v, r in enumerate(near.tolist()):
        for u in r:
            both[u].append(v)
    for _ in range(rounds):
        moved = 0
        for v in rng.permutation(n).tolist():
            votes = np.bincount(label[both[v]], minlength=parts)
            votes[size >= room] = 0
            p, old = int(votes.argmax()), label[v]
            if p != old and votes[p] > np.count_nonzero(label[both[v]] == old):
                label[v], moved = p, moved + 1
                size[p], size[old] = size[p] + 1, size[old] - 1
        if not moved:
            break
    return label


@dataclass
class Router:
    """A network of one hidden layer; gives the logarithms of part probabilities up to a constant."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train_router(x: np.ndarray, near: np.ndarray, label: np.ndarray, parts: int, hidden: int = 96, epochs: int = 40, seed: int = 11) -> Router:
    """Adam on the cross-entropy against the parts of a vertex (half) and its neighbours (half)."""
    rng = np.random.default_rng(seed)
    n, dim = x.shape
    mean, scale = x.mean(axis=0), float(x.std()) or 1.0
    z = (x - mean) / scale
    goal = np.eye(parts)[label] * 0.5 + np.eye(parts)[label[near]].mean(axis=1) * 0.5
    p = [rng.normal(0, np.sqrt(2 / dim), (dim, hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    m, s, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(n), max(1, n // 128)):
            h = np.maximum(z[at] @ p[0] + p[1], 0)
            o = h @ p[2] + p[3]
            e = np.exp(o - o.max(axis=1, keepdims=True))
            d = (e / e.sum(axis=1, keepdims=True) - goal[at]) / len(at)
            back = (d @ p[2].T) * (h > 0)
            t += 1
            for i, g in enumerate((z[at].T @ back, back.sum(0), h.T @ d, d.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.999 * s[i] + 0.001 * g * g
                p[i] -= 0.003 * (m[i] / (1 - 0.9**t)) / (np.sqrt(s[i] / (1 - 0.999**t)) + 1e-8)
    return Router(mean, scale, *p)


def fit(x: np.ndarray, parts: int, recall: float = RECALL) -> tuple[Router, int]:
    """(router, probes) for the sample ``x``."""
    near = neighbour_graph(x, min(NEIGHBOURS, len(x) - 1))
    router = train_router(x, near, balanced_parts(x, near, parts), parts)
    scores = router.scores(x)
    home = scores.argmax(axis=1)
    # place of each neighbour's part in the vertex's order of parts
    place = np.argsort(np.argsort(-scores, axis=1, kind="stable"), axis=1, kind="stable")
    at = np.sort(place[np.arange(len(x))[:, None], home[near]].ravel())
    return router, int(at[min(len(at) - 1, int(np.ceil(recall * len(at))) - 1)]) + 1


def _top(k: int):
    def run(q: np.ndarray, x: np.ndarray, quid: np.ndarray, uid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        qi, ri, score = [], [], []
        for i in range(len(q)):
            diff = x - q[i]
            d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            d[uid == quid[i]] = np.inf
            near = np.flatnonzero(d <= np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1]) if len(d) else np.zeros(0, int)
            near = near[np.argsort(d[near], kind="stable")][:k]  # rows are in order of vec_id
            near = near[uid[near] != quid[i]]
            qi.append(np.full(len(near), i))
            ri.append(near)
            score.append(d[near])
        return np.concatenate(qi), np.concatenate(ri), np.concatenate(score)

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", recall: float = RECALL,
            sample: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance): the k nearest found of each query."""
    v = clean(vectors.withColumnRenamed(vec_id, "vec_id"), "vec_id", vector, zero=False)
    dims = v.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = dims[0]["dim"] if dims else 1
    n = dims[0]["count"] if dims else 0
    v = v.filter(F.col("dim") == dim)
    parts = max(1, min(sample // PART_SAMPLE, n // PART_ROWS))
    if parts > 1:
        picked = v.orderBy(F.xxhash64("vec_id", F.lit("sample")), "uid").limit(sample).select("v").collect()
        router, probes = fit(np.array([r["v"] for r in picked]), parts, recall)
    else:
        router, probes = None, 1

    def route(places: int, counts: np.ndarray | None = None):
        """Each vector's ``places`` most probable parts, and more until they hold k + 1 of the ``counts``."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                if router is None:
                    best = np.zeros((b.num_rows, 1), np.int32)
                else:
                    best = np.argsort(-router.scores(matrix(b.column(2), dim)), axis=1, kind="stable").astype(np.int32)
                wanted = np.full(b.num_rows, places)
                if counts is not None:
                    wanted = np.maximum(wanted, (np.cumsum(counts[best], axis=1) < k + 1).sum(axis=1) + 1)
                taken = np.arange(best.shape[1]) < wanted[:, None]
                ends = np.append(0, np.cumsum(taken.sum(axis=1)))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(best[taken]))
                yield pa.RecordBatch.from_arrays([*b.columns, lists], names=["uid", "vec_id", "v", "dim", "parts"])

        return run

    schema = "uid long, vec_id long, v array<double>, dim int, parts array<int>"
    index = held(v.mapInArrow(route(1), schema).select("uid", "vec_id", "v", "dim", F.col("parts")[0].alias("part")), "ann-index")
    held_rows = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}  # one row per part
    shards = {p: -(-c // shard_rows) for p, c in held_rows.items()}
    counts = np.array([held_rows.get(p, 0) for p in range(parts)], np.int64)
    first, total = {}, 0
    for p in sorted(shards):
        first[p], total = total, total + shards[p]
    spark = v.sparkSession
    places = spark.createDataFrame([(p, first[p], shards[p]) for p in sorted(shards)], "part int, first long, n_shards long")
    rows = index.join(places, "part").withColumn("shard", F.col("first") + F.pmod(F.xxhash64("uid"), "n_shards"))
    asks = v.filter(is_query).mapInArrow(route(probes, counts), schema)
    blocks = max(1, -(-v.filter(is_query).count() // QUERY_ROWS))
    asks = (asks.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks))).select("uid", "vec_id", "v", "dim", "block", F.explode("parts").alias("part"))
            .join(places, "part").withColumn("shard", F.explode(F.sequence("first", F.col("first") + F.col("n_shards") - 1))))
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))
    cols = ["uid", "vec_id", "v", "dim", "block", "shard"]
    tiles = tile_top(rows.withColumn("block", each).select(cols), asks.select(cols), ["block", "shard", "dim"], _top(k), "double")
    return merge_top(tiles, k, total, F.asc("score"))
