"""Exact top-k search by inner product of integer vectors: tiled matrix products.

Rows are cut into shards and queries into blocks; each (block, shard) is one
tile, whose scores are one matrix product. A tile keeps each query's top k by
partial selection; the lists are merged as a tree. Every query meets every row
once; a tile's size is fixed, whatever the table's.

Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part; rows that repeat a vec_id count each, and only a query's
own row is left out of its candidates; vectors of different lengths do not meet.
Ties go to the smaller vec_id. Products are made in doubles while they are exact
there, else in whole numbers; components end at 2^62 either way, a score beyond a long ends at its bounds, and candidates
are ranked by their whole scores.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import QUERY_ROWS, SHARD_ROWS, clean, merge_top, tile_top


#: Components end here, so that they are whole numbers in doubles.
WIDEST = 2.0**62
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _top(k: int):
    def run(q: np.ndarray, x: np.ndarray, quid: np.ndarray, uid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(x)
        worst = float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1]
        if worst * n < 2.0**52:
            scores = (q @ x.T).astype(np.int64)
        else:
            whole = np.array([[int(v) for v in row] for row in x], dtype=object)
            scores = np.array([[int(v) for v in row] for row in q], dtype=object) @ whole.T
        # one number holds score and place, so no two candidates tie
        key = scores * n + (n - 1 - np.arange(n))
        low = key.min() - 1 if key.size else 0
        own = np.searchsorted(np.sort(uid), quid)
        place = np.argsort(uid)
        own = np.minimum(own, n - 1)
        mine = np.flatnonzero(uid[place[own]] == quid)
        key[mine, place[own[mine]]] = low
        m = min(k, n)
        at = np.argpartition(key, n - m, axis=1)[:, n - m:] if key.dtype != object else np.argsort(key, axis=1)[:, n - m:]
        qi, ri = np.repeat(np.arange(len(q)), m), at.ravel()
        ok = key[qi, ri] != low
        qi, ri = qi[ok], ri[ok]
        return qi, ri, np.array([min(max(s, LEAST), MOST) for s in scores[qi, ri].tolist()], np.int64)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, vec_id: str = "vec_id", vector: str = "embedding",
          shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products of each query.

    Components count as floor(scale * x). ``is_query`` selects the queries by
    ``vec_id``; every row but a query's own is its candidate."""
    v = clean(vectors.withColumnRenamed(vec_id, "vec_id"), "vec_id", vector, zero=True)
    v = v.withColumn("v", F.transform("v", lambda x: F.floor(F.greatest(F.lit(-WIDEST), F.least(F.lit(WIDEST), F.lit(scale) * x))).cast("double")))
    q = v.filter(is_query)
    n, n_queries = v.count(), q.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // query_rows))
    spread = lambda m: F.pmod(F.xxhash64("uid"), F.lit(m))
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)).cast("array<bigint>"))
    rows = v.withColumn("shard", spread(shards)).withColumn("block", each(blocks))
    asks = q.withColumn("block", spread(blocks)).withColumn("shard", each(shards))
    tiles = tile_top(rows, asks, ["block", "shard", "dim"], _top(k), "long")
    return merge_top(tiles, k, shards, F.desc("score"))
