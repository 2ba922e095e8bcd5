r"""Clustering around centroids by Orchard search, in whole numbers.

Each round the driver holds the k centroids and, of each, the list of the others by
distance (k squared numbers). A task moves its vectors along these lists, all of a
chunk in step: a vector looks at the centroids next to its best so far; at a closer
one (or an equally close one of a smaller number) it goes over to that one's list.
What it has met it does not measure again. It stops where the list's distance is
strictly beyond twice its own: nothing behind can be as close. Tasks add up the
vectors of each centroid, so k x dim sums of a task cross the shuffle.

Defined results: vectors that are null, of another length, or hold a null or
non-finite component take no part; floor(scale * x) saturates at -2^27 and 2^27, so
that squared distances stay whole 64-bit numbers; sums of them end at 2^63 - 1. Rows
that repeat a vec_id are vectors of their own; among equal hashes the smaller vector
starts first, null ids last. With fewer vectors than k there are as many centroids
as vectors; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held
from .vectors import matrix

#: The largest component, and vectors measured at a time.
MOST, CHUNK = 1 << 27, 8192


def whole_vectors(vectors: DataFrame, dim: int, scale: float, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v array<bigint>): the vectors that take part, in whole numbers."""
    x = F.col(vector).cast("array<double>")
    ok = (F.size(x) == dim) & F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
    whole = F.transform(x, lambda a: F.greatest(F.lit(float(-MOST)), F.least(F.lit(float(MOST)), F.lit(scale) * a)))
    return vectors.filter(ok).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(whole, lambda a: F.floor(a)).alias("v"))


class Lists:
    """Centroids with, for each, the others in order of distance (ties: smaller number)."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.c = centroids
        between = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
        np.fill_diagonal(between, -1)
        self.near = np.argsort(between, axis=1, kind="stable")[:, 1:]
        self.between = np.take_along_axis(between, self.near, axis=1)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, squared distance to it, distances measured)."""
        n, k = len(x), len(self.c)
        best, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
        distance = ((x - self.c[0]) ** 2).sum(axis=1)
        met = np.zeros((n, k), bool)
        met[:, 0] = True
        measured, active = n, np.arange(n)
        while len(active):
            active = active[place[active] < k - 1]
            # strictly beyond twice the distance: between > 4 * distance, in squares
            gap = self.between[best[active], place[active]]
            active = active[(gap - 1) >> 2 < distance[active]]
            other = self.near[best[active], place[active]]
            place[active] += 1
            new = ~met[active, other]
            at, other = active[new], other[new]
            met[at, other] = True
            measured += len(at)
            d = ((x[at] - self.c[other]) ** 2).sum(axis=1)
            closer = (d < distance[at]) | ((d == distance[at]) & (other < best[at]))
            at, other = at[closer], other[closer]
            best[at], distance[at], place[at] = other, d[closer], 0
        return best, distance, measured


def _chunks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, CHUNK):
            part = batch.slice(i, CHUNK)
            yield part, matrix(part.column(1), dim).astype(np.int64)


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of their vectors; those without any stay."""
    lists, (k, dim) = Lists(centroids), centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, x in _chunks(batches, dim):
            best = lists.assign(x)[0]
            np.add.at(total, best, x)
            count += np.bincount(best, minlength=k)
        full = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(full, dim)), pa.array(np.tile(np.arange(dim), len(full))),
                                          pa.array(total[full].ravel()), pa.array(np.repeat(count[full], dim))], names=["cluster", "place", "s", "n"])

    parts = kept.mapInArrow(add, "cluster long, place long, s long, n long")
    out = centroids.copy()
    # k x dim numbers at most
    for r in parts.groupBy("cluster", "place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect():
        out[r["cluster"], r["place"]] = int(r["s"]) // r["n"]
    return out


def clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: float = 64.0, seed: int = 1,
             vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256: one row per vector.

    The first centroids are the k vectors with the smallest SHA-256 of ``seed:vec_id``."""
    spark = vectors.sparkSession
    kept = held(whole_vectors(vectors, dim, scale, vec_id, vector), "whole-vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(order.asc_nulls_last(), "v").limit(k).collect()
    if not first:
        return kept.select("vec_id", *(F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))))
    centroids = np.array([r["v"] for r in first], np.int64)
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    lists = Lists(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _chunks(batches, dim):
            best, distance, _ = lists.assign(x)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    rows = held(kept.mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters")
    sums = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    most = (1 << 63) - 1
    facts = [(c, min(most, s), min(most, sum(sums.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, s in sorted(sums.items())]
    # k rows
    return rows.join(F.broadcast(spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
