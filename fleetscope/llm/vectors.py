"""Shared by the vector searches: clean vectors, tiles of queries and rows, merging of top lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import held

#: Rows of one shard and queries of one block, at most about.
SHARD_ROWS = 4096
QUERY_ROWS = 2048
#: Top lists that one merge step joins.
FAN = 8


def clean(vectors: DataFrame, vec_id: str, vector: str, zero: bool) -> DataFrame:
    """(uid, vec_id, v array<double>, dim) without nulls, empty vectors and null or non-finite components; zero
    vectors stay only if ``zero``. uid tells rows apart that repeat a vec_id."""
    v = F.col(vector).cast("array<double>")
    ok = F.col(vec_id).isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if not zero:
        ok &= F.exists(v, lambda x: x != 0)
    return held(vectors.filter(ok).select(F.monotonically_increasing_id().alias("uid"), F.col(vec_id).cast("long").alias("vec_id"),
                                          v.alias("v"), F.size(v).alias("dim")), "vectors")


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def tile_top(rows: DataFrame, queries: DataFrame, keys: list[str], top: Callable, kind: str) -> DataFrame:
    """(quid, query_id, vec_id, score, shard, uid): ``top`` of every tile of a query block and a shard.

    ``rows`` and ``queries`` hold uid, vec_id, v, dim and ``keys`` (the tile)."""

    columns = ["uid", "vec_id", "v", "dim", *(k for k in keys if k != "dim")]
    rows = rows.select(*columns, *([] if "shard" in keys else ["shard"]))
    # both sides may come from one table; new attributes keep the cogroup from mixing them up
    queries = queries.select(*(F.col(c).alias("q_" + c) for c in columns))

    def run(q: pa.Table, r: pa.Table) -> pa.Table:
        schema = pa.schema([("quid", pa.int64()), ("query_id", pa.int64()), ("uid", pa.int64()), ("vec_id", pa.int64()),
                            ("score", pa.int64() if kind == "long" else pa.float64()), ("shard", pa.int64())])
        if not q.num_rows or not r.num_rows:
            return schema.empty_table()
        dim = q["q_dim"][0].as_py()
        quid, qid, uid, vid = (t[c].to_numpy() for t, c in ((q, "q_uid"), (q, "q_vec_id"), (r, "uid"), (r, "vec_id")))
        order = np.lexsort((uid, vid))  # so that ties go to the smaller vec_id by place
        x = matrix(r["v"], dim)[order]
        qi, ri, score = top(matrix(q["q_v"], dim), x, quid, uid[order])
        ri = order[ri]
        return pa.table([pa.array(quid[qi]), pa.array(qid[qi]), pa.array(uid[ri]), pa.array(vid[ri]), pa.array(score),
                         pa.array(np.full(len(qi), r["shard"][0].as_py(), np.int64))], schema=schema)

    return (queries.groupBy(*("q_" + k for k in keys)).cogroup(rows.groupBy(*keys))
            .applyInArrow(run, f"quid long, query_id long, uid long, vec_id long, score {kind}, shard long"))


def merge_top(tiles: DataFrame, k: int, shards: int, order: Column) -> DataFrame:
    """query_id, rank, vec_id, score: top lists merged ``FAN`` at a time, as a tree."""
    while shards > 1:
        shards = -(-shards // FAN)
        tiles = tiles.withColumn("shard", F.floor(F.col("shard") / FAN))
        w = Window.partitionBy("quid", "shard").orderBy(order, "vec_id", "uid")
        tiles = tiles.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("rank")
    w = Window.partitionBy("quid").orderBy(order, "vec_id", "uid")
    return tiles.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
