"""Isolation-forest anomaly labels on the per-driver summary (M6, M7).

Spark ML has no isolation forest, so it is built from Spark pieces:

1. Sample: every row takes part in tree ``t`` when a seeded hash of
   ``(key, t)`` falls below a rate chosen so a tree sees about 1.5 x
   ``max_samples`` candidates (doubled until every tree has enough); per tree the ``max_samples`` smallest hashes
   are kept (sampling without replacement, independent per tree). Only the
   selected (tree, row) pairs are ever produced.
2. Grow: ``groupBy("tree").applyInPandas`` builds each tree from its sample
   (at most ``max_samples`` rows per group), with a generator seeded by
   ``(seed, tree)``.
3. Score: the forest (at most ``trees x (2 * max_samples - 1)`` nodes, a
   bound independent of the data size) is broadcast to a vectorised pandas
   UDF computing ``2 ** (-E[h(x)] / c(max_samples))`` per row.
4. Label: -1 above the ``1 - contamination`` quantile of the score, else 1;
   the quantile is exact.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.operators.quantiles import column_quantiles
from fleetscope.schema import MEASURES
from fleetscope.session import ship_package
from fleetscope.sources.sinks import materialize

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType(), False),
    T.StructField("node", T.IntegerType(), False),
    T.StructField("feature", T.IntegerType(), False),
    T.StructField("threshold", T.DoubleType(), False),
    T.StructField("left", T.IntegerType(), False),
    T.StructField("right", T.IntegerType(), False),
    T.StructField("size", T.IntegerType(), False),
])


def average_path(n) -> np.ndarray:
    """c(n): mean path length of an unsuccessful search in a binary search tree."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + np.euler_gamma) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """One isolation tree over sample ``x`` as (node, feature, threshold, left, right, size)."""
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, None)]
    while stack:
        idx, depth, parent = stack.pop()
        node_id = len(nodes)
        if parent is not None:
            nodes[parent[0]][3 if parent[1] == 0 else 4] = node_id
        sub = x[idx]
        lo, hi = (sub.min(axis=0), sub.max(axis=0)) if len(idx) else (None, None)
        splittable = np.flatnonzero(hi > lo) if len(idx) > 1 else np.array([], dtype=int)
        if depth >= max_depth or len(splittable) == 0:
            nodes.append([node_id, -1, 0.0, -1, -1, len(idx)])
            continue
        f = int(rng.choice(splittable))
        thr = float(rng.uniform(lo[f], hi[f]))
        nodes.append([node_id, f, thr, -1, -1, len(idx)])
        go_left = sub[:, f] < thr
        stack.append((idx[~go_left], depth + 1, (node_id, 1)))
        stack.append((idx[go_left], depth + 1, (node_id, 0)))
    return [tuple(n) for n in nodes]


def fit_forest(features: DataFrame, columns: list[str], key: str = "driverID",
               n_trees: int = 100, max_samples: int = 256, seed: int = 0) -> DataFrame:
    """Grow ``n_trees`` isolation trees; returns the nodes (bounded table)."""
    ship_package(features.sparkSession)
    n = features.count()
    m = max(1, min(max_samples, n))
    scale = float(2 ** 63)
    u = lambda t: (F.abs(F.xxhash64(F.col(key), F.lit(seed), t).cast("double")) / F.lit(scale))
    rate = min(1.0, 1.5 * m / max(n, 1))
    while True:
        trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t, r=rate: u(t) < F.lit(r))
        picked = features.select(key, *columns, F.explode(trees).alias("tree"))
        sizes = [r["count"] for r in picked.groupBy("tree").count().collect()]  # one row per tree
        if rate >= 1.0 or n == 0 or (len(sizes) == n_trees and min(sizes) >= m):
            break
        rate = min(1.0, 2 * rate)  # some tree has too few candidates
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(u(F.col("tree")), key))
    sample = picked.withColumn("_r", rank).filter(F.col("_r") <= m).drop("_r")
    max_depth = int(math.ceil(math.log2(max(m, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(key, kind="stable")
        x = pdf[columns].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        rows = _grow(x, rng, max_depth)
        out = pd.DataFrame(rows, columns=["node", "feature", "threshold", "left", "right", "size"])
        out.insert(0, "tree", tree)
        return out

    return sample.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def _forest_arrays(nodes: pd.DataFrame, n_trees: int):
    width = int(nodes["node"].max()) + 1 if len(nodes) else 1
    shape = (n_trees, width)
    feat = np.full(shape, -1, dtype=np.int64)
    thr = np.zeros(shape)
    left = np.full(shape, -1, dtype=np.int64)
    right = np.full(shape, -1, dtype=np.int64)
    size = np.zeros(shape)
    t, nd = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
    feat[t, nd] = nodes["feature"].to_numpy()
    thr[t, nd] = nodes["threshold"].to_numpy()
    left[t, nd] = nodes["left"].to_numpy()
    right[t, nd] = nodes["right"].to_numpy()
    size[t, nd] = nodes["size"].to_numpy()
    present = np.zeros(n_trees, dtype=bool)
    present[np.unique(t)] = True
    return feat, thr, left, right, size, present


def anomaly_scores(features: DataFrame, nodes: DataFrame, columns: list[str],
                   n_trees: int, max_samples: int) -> DataFrame:
    """Anomaly score in (0, 1] per row; higher is more isolated."""
    spark = features.sparkSession
    ship_package(spark)
    # Bounded by n_trees x (2 * max_samples - 1) rows, whatever the data size.
    forest = _forest_arrays(nodes.toPandas(), n_trees)
    bc = spark.sparkContext.broadcast(forest)
    n = features.count()
    c_norm = float(average_path([max(1, min(max_samples, n))])[0]) or 1.0

    @F.pandas_udf(T.DoubleType())
    def score(*cols: pd.Series) -> pd.Series:
        feat, thr, left, right, size, present = bc.value
        x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        rows = np.arange(len(x))
        total = np.zeros(len(x))
        used = 0
        for t in np.flatnonzero(present):
            node = np.zeros(len(x), dtype=np.int64)
            depth = np.zeros(len(x))
            while True:
                f = feat[t, node]
                inner = f >= 0
                if not inner.any():
                    break
                r = rows[inner]
                go_left = x[r, f[inner]] < thr[t, node[inner]]
                node[inner] = np.where(go_left, left[t, node[inner]], right[t, node[inner]])
                depth[inner] += 1
            total += depth + average_path(size[t, node])
            used += 1
        mean_path = total / max(used, 1)
        return pd.Series(np.power(2.0, -mean_path / c_norm))

    return features.withColumn("score", score(*[F.col(c) for c in columns]))


def driver_anomalies(summary: DataFrame, columns: list[str] = MEASURES, key: str = "driverID",
                     contamination: float = 0.1, n_trees: int = 100, max_samples: int = 256,
                     seed: int = 0) -> DataFrame:
    """M6: ``(driverID, score, anomaly)`` with anomaly -1 for about the
    ``contamination`` share of most isolated rows and 1 otherwise."""
    features = materialize(summary.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                     for c in columns]), "anomaly-features")
    nodes = fit_forest(features, columns, key, n_trees, max_samples, seed)
    scored = materialize(anomaly_scores(features, nodes, columns, n_trees, max_samples).select(key, "score"), "anomaly-scores")
    q = column_quantiles(scored, "score", [1.0 - contamination])[0]
    label = F.when(F.col("score") > F.lit(q), F.lit(-1)).otherwise(F.lit(1)) if q is not None \
        else F.lit(1)
    return scored.select(key, "score", label.cast("int").alias("anomaly"))
