import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetscope.llm.ann import balanced_parts, nearest, neighbour_graph
from fleetscope.llm.topk import top_k


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "s") for i, v in zip(ids, vectors, strict=True)],
                                 "vec_id long, embedding array<float>, uid int, shard string")


@pytest.fixture(scope="module")
def odd():
    """Ties, copies, zeros, nulls and non-finite components."""
    rng = np.random.default_rng(2)
    v = [list(np.float32(x)) for x in rng.normal(size=(150, 8)).round(1)]
    return [*v, *v[:5], v[0], [0.0] * 8, None, [], [None, *v[1][1:]], [float("nan"), *v[1][1:]], [float("inf"), *v[1][1:]]]


def usable(vectors, zero):
    ok = [i for i, v in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))]
    return ok, np.array([vectors[i] for i in ok], np.float64)


@pytest.mark.parametrize(("shard", "block"), [(4096, 2048), (7, 3)])
def test_top_k_is_exact(shipped, odd, shard, block):
    got = top_k(table(shipped, odd), F.col("vec_id") % 5 == 0, k=6, shard_rows=shard, query_rows=block).collect()
    ids, x = usable(odd, True)
    x = np.floor(64 * x).astype(np.int64)
    want = set()
    for i, q in zip(ids, x, strict=True):
        if i % 5 == 0:
            s = [(-int(q @ y), j) for j, y in zip(ids, x, strict=True) if j != i]
            want |= {(i, r, j, -c) for r, (c, j) in enumerate(sorted(s)[:6], 1)}
    assert {tuple(r) for r in got} == want


def test_top_k_of_large_numbers_few_rows_and_repeated_ids(shipped):
    v = [[3e7, 2.0], [-3e7, 5.0], [3e7, 2.5]]
    got = {(r.query_id, r.rank, r.vec_id): r.score for r in top_k(table(shipped, v), F.col("vec_id") == 0, k=5).collect()}
    x = np.floor(64 * np.array(v, np.float32).astype(float)).astype(int).tolist()
    dot = lambda a, b: sum(p * q for p, q in zip(a, b, strict=True))
    assert got == {(0, 1, 2): dot(x[0], x[2]), (0, 2, 1): dot(x[0], x[1])}
    twice = top_k(table(shipped, [[1.0], [1.0], [2.0]], ids=[0, 0, 1]), F.col("vec_id") == 0, k=5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in twice) == [(0, 1, 1), (0, 1, 1), (0, 2, 0), (0, 2, 0)]
    assert top_k(table(shipped, v).limit(0), F.col("vec_id") == 0).collect() == []
    vast = top_k(table(shipped, [[1e12, 1.0], [1e30, 1.0], [-1e30, 0.0], [2e12, 0.0]]), F.col("vec_id") == 0, k=5).collect()
    assert [(r.vec_id, r.score) for r in sorted(vast, key=lambda r: r.rank)] == [(1, 2**63 - 1), (3, 2**63 - 1), (2, -(2**63))]


def test_small_tables_are_searched_exactly(shipped, odd):
    got = nearest(table(shipped, odd), F.col("vec_id") % 10 == 0, k=4).collect()
    ids, x = usable(odd, False)
    want = {}
    for i, q in zip(ids, x, strict=True):
        if i % 10 == 0:
            d = sorted((float(np.sqrt(((q - y) ** 2).sum())), j) for j, y in zip(ids, x, strict=True) if j != i)[:4]
            want |= {(i, r, j): c for r, (c, j) in enumerate(d, 1)}
    assert {(r.query_id, r.rank, r.vec_id): r.score for r in got} == pytest.approx(want)
    assert nearest(table(shipped, odd).limit(0), F.col("vec_id") == 0).collect() == []


def test_recall_and_scores_on_learned_partitions(shipped):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16)) * 2
    x = (centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 16))).astype(np.float32)
    got = nearest(table(shipped, x.tolist()), F.col("vec_id") % 100 == 0, sample=1024, shard_rows=200).collect()
    hit = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x.astype(float) - x[q]) ** 2).sum(1))
        d[q] = np.inf
        mine = [r for r in got if r.query_id == q]
        assert [r.rank for r in sorted(mine, key=lambda r: r.rank)] == list(range(1, 11))
        assert all(r.score == pytest.approx(d[r.vec_id], rel=1e-12) for r in mine)
        hit += len({r.vec_id for r in mine} & set(np.argsort(d)[:10]))
    assert hit / 300 >= 0.9


def test_every_query_gets_k_rows_though_its_part_holds_fewer(shipped):
    """Clusters of five, far apart, and some outliers: no part of a query's need hold ten rows."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(300, 8)) * 100
    x = np.concatenate([(centres[np.repeat(np.arange(300), 5)] + rng.normal(size=(1500, 8)) * 0.01), rng.normal(size=(4, 8)) * 1e5]).astype(np.float32)
    got = nearest(table(shipped, x.tolist()), F.col("vec_id") % 100 == 0, sample=1024).collect()
    per = {}
    for r in got:
        per.setdefault(r.query_id, []).append(r.rank)
    assert len(per) == 16 and all(sorted(v) == list(range(1, 11)) for v in per.values())
    outliers = nearest(table(shipped, x.tolist()), F.col("vec_id") >= 1500, sample=1024).collect()
    assert sorted((r.query_id, r.rank) for r in outliers) == [(1500 + i, k) for i in range(4) for k in range(1, 11)]


def test_parts_are_balanced():
    x = np.random.default_rng(1).normal(size=(600, 8))
    label = balanced_parts(x, neighbour_graph(x, 8), 6)
    assert label.min() >= 0 and np.bincount(label, minlength=6).max() <= np.ceil(1.1 * 100)
