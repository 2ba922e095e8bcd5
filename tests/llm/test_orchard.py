"""op13 against plain rounds over all centroids, and the lists against a full search."""

import hashlib

import numpy as np
import pytest

from fleetscope.llm.orchard import Lists, clusters


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, "c") for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<double>, cluster int, v string")


def plain(ids, vectors, k, rounds):
    x = [[int(np.floor(64 * a)) for a in v] for v in vectors]
    order = sorted(range(len(x)), key=lambda i: (hashlib.sha256(f"1:{ids[i]}".encode()).hexdigest(), x[i]))
    c = [x[i] for i in order[:k]]
    distance = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    nearest = lambda v: min((distance(v, y), j) for j, y in enumerate(c))
    for _ in range(rounds):
        mine = [nearest(v)[1] for v in x]
        c = [[sum(col) // len(col) for col in zip(*[v for v, m in zip(x, mine, strict=True) if m == j], strict=True)] if j in mine else c[j] for j in range(len(c))]
    found = [nearest(v) for v in x]
    per = {j: sum(d for d, m in found if m == j) for j in range(len(c))}
    sha = [hashlib.sha256(",".join(map(str, y)).encode()).hexdigest() for y in c]
    return sorted((i, j, d, per[j], sum(per.values()), sha[j]) for i, (d, j) in zip(ids, found, strict=True))


def rows(df):
    return sorted(tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())


@pytest.mark.parametrize("spread", [0.02, 0.3, 3.0])
def test_lists_find_the_nearest_with_ties_to_the_smaller_number(spread):
    rng = np.random.default_rng(5)
    c = rng.integers(-2, 3, size=(40, 3))  # many equal centroids and equal distances
    x = np.concatenate([rng.integers(-3, 4, size=(400, 3)), (c[rng.integers(0, 40, 400)] + rng.normal(size=(400, 3)) * spread).astype(np.int64)])
    best, distance, _ = Lists(c).assign(x)
    full = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (best == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_lists_measure_fewer_distances():
    rng = np.random.default_rng(6)
    c = rng.integers(-10_000, 10_000, size=(64, 4))
    x = c[rng.integers(0, 64, 2000)] + rng.integers(-50, 50, size=(2000, 4))
    best, _, measured = Lists(c).assign(x)
    assert measured < 0.5 * 64 * 2000
    assert (best == ((x[:, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_rounds_are_exact(shipped):
    rng = np.random.default_rng(7)
    v = (rng.normal(size=(300, 4)) + rng.integers(0, 4, size=(300, 1))).round(2).tolist()
    v += v[:40] + [[0.0] * 4] * 30
    ids = list(range(len(v)))
    assert rows(clusters(table(shipped, v, ids).repartition(3), k=7, rounds=3, dim=4)) == plain(ids, v, 7, 3)


def test_what_takes_no_part_few_vectors_repeats_and_large_numbers(shipped):
    good = [[1.0, 2.0], [-1.5, 0.25], [1.0, 2.0]]
    odd = [None, [], [1.0], [1.0, 2.0, 3.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0]]
    got = rows(clusters(table(shipped, good + odd, [5, 5, 9, *range(20, 27)]), k=16, dim=2))
    assert got == plain([5, 5, 9], good, 16, 3)
    huge = clusters(table(shipped, [[1e300, -1e300], [1e300, 1e300]], [1, 2]), k=1, dim=2).collect()
    assert all(0 <= r.distance <= r.inertia < 2**63 for r in huge)
    nameless = clusters(table(shipped, good, [None, 1, 2]), k=2, dim=2).collect()
    assert sorted(r.vec_id is None for r in nameless) == [False, False, True]
    assert clusters(table(shipped, good).limit(0), dim=2).collect() == []
