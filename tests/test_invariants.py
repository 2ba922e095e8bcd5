"""Invariants of the batch operators on the test tables."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetscope.operators import behaviour as B
from fleetscope.operators import iforest as IF
from fleetscope.operators import ml as ML
from fleetscope.operators import slices as S
from fleetscope.operators import stats as ST
from fleetscope.operators import trips as TR
from fleetscope.schema import MEASURES, REGRESSION_FEATURES
from fleetscope.sources.telemetry import load_telemetry
from tests.conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def tel(spark):
    return load_telemetry(spark, SF_MID)


@pytest.fixture(scope="module")
def summary(spark, tel):
    return TR.driver_summary(tel).cache()


def test_behaviour_totals_equal_global_sums(tel):
    a1 = B.behaviour_by_plate(tel).agg(F.sum("overspeed_count"), F.sum("overspeed_time")).first()
    g = tel.agg(F.count("isOverspeedFinished"), F.sum("overspeedTime")).first()
    assert a1[0] == g[0] and a1[1] == pytest.approx(g[1])


def test_correlation_symmetric_unit_diagonal(summary):
    m = {(r["row_idx"], r["col_idx"]): r["corr"]
         for r in ST.correlation_matrix(summary).collect()}
    assert len(m) == 121
    for (i, j), v in m.items():
        assert v == m[(j, i)]
        assert -1.0 <= v <= 1.0
        if i == j:
            assert v == 1.0


def test_correlation_equals_pandas(summary):
    pdf = summary.toPandas()[MEASURES].astype(float)
    want = pdf.corr(method="pearson")
    got = {(r["row_measure"], r["col_measure"]): r["corr"]
           for r in ST.correlation_matrix(summary).collect()}
    for a in MEASURES:
        for b in MEASURES:
            assert got[(a, b)] == pytest.approx(want.loc[a, b], abs=1e-6)


def test_summary_stats_equal_pandas(summary):
    pdf = summary.toPandas()[MEASURES].astype(float)
    got = {r["measure"]: r for r in ST.summary_stats(summary).collect()}
    for m in MEASURES:
        assert got[m]["mean"] == pytest.approx(pdf[m].mean(), abs=1e-6)
        assert got[m]["median"] == pytest.approx(pdf[m].median(), abs=1e-6)
        assert got[m]["std"] == pytest.approx(pdf[m].std(), abs=1e-6)


def test_boxplot_matches_numpy(summary):
    x = summary.toPandas()["total_rapid_accelerations"].astype(float).to_numpy()
    q1, q2, q3 = np.percentile(x, [25, 50, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    r = ST.boxplot_stats(summary).first()
    assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, q2, q3))
    assert r["whisker_low"] == x[x >= lo].min() and r["whisker_high"] == x[x <= hi].max()
    assert r["n_outliers"] == int(((x < lo) | (x > hi)).sum())


def test_pages_concatenate_to_search_result(tel):
    table = B.behaviour_by_plate(tel).cache()
    hits = sorted(r[0] for r in B.search(table, "1").select("carPlateNumber").collect())
    pages = []
    for start in range(0, len(hits) + 25, 25):
        pages += [r[0] for r in B.page(B.search(table, "1"), start, 25,
                                        ["carPlateNumber"]).select("carPlateNumber").collect()]
    assert pages == hits


def test_windows_partition_the_rows(tel):
    win = S.speed_by_window(tel)
    assert win.agg(F.sum("n_records")).first()[0] == tel.count()
    rep = S.replay_slices(tel)
    assert rep.agg(F.sum("n_records")).first()[0] == tel.count()
    assert rep.filter(F.col("slice_no") < 0).count() == 0


def test_distance_matches_plain_window(tel):
    w = Window.partitionBy("driverID").orderBy("Time", "event_id")
    ref = (tel.withColumn("dt", F.timestamp_diff("SECOND", F.lag("Time").over(w), F.col("Time")))
              .groupBy("driverID").agg((F.sum(F.col("Speed") * F.col("dt")) / 3600.0).alias("ref")))
    got = TR.driver_distance(tel)
    bad = got.join(ref, "driverID", "full").filter(~F.col("total_distance").eqNullSafe(F.col("ref")))
    assert bad.count() == 0


def test_clusters_labels_and_cost(spark, summary):
    cl = ML.driver_clusters(summary, n_init=3)
    labels = {r[0] for r in cl.select("cluster").distinct().collect()}
    assert labels <= {0, 1, 2} and len(labels) == 3
    assert cl.count() == summary.count()
    # Repeatable labels for the same seed.
    again = ML.driver_clusters(summary, n_init=3)
    diff = cl.join(again.withColumnRenamed("cluster", "c2"), "driverID").filter("cluster != c2")
    assert diff.count() == 0


def test_regression_equals_numpy_least_squares(summary):
    coefficients, intercept = ML.fit_speed_regression(summary)
    train = ML.split_flag(summary).filter(~F.col("is_test")).toPandas()
    x = np.column_stack([train[REGRESSION_FEATURES].astype(float).fillna(0.0).to_numpy(), np.ones(len(train))])
    coef, *_ = np.linalg.lstsq(x, train["average_speed"].to_numpy(), rcond=None)
    assert list(coefficients) == pytest.approx(list(coef[:-1]), rel=1e-6, abs=1e-8)
    assert intercept == pytest.approx(coef[-1], rel=1e-6)
    r2 = ML.regression_score(summary).first()
    assert r2["r2"] <= 1.0 and r2["n_test"] > 0
    assert len(REGRESSION_FEATURES) == 7


def test_least_squares_of_dependent_columns_has_the_smallest_coefficients(spark):
    rng = np.random.default_rng(8)
    a, b = rng.normal(1e4, 1, 400), rng.normal(size=400)
    x = np.column_stack([a, b, a, np.full(400, 0.1), 2 * b - a])
    y = 3 * a - b + rng.normal(size=400) * 0.1 + 50
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "c0 double, c1 double, c2 double, c3 double, c4 double, y double")
    got, intercept = ML.least_squares(df.repartition(7), [f"c{i}" for i in range(5)], "y")
    centred = x - x.mean(axis=0)
    centred[:, 3] = 0
    want = np.linalg.lstsq(centred, y - y.mean(), rcond=1e-10)[0]
    assert list(got) == pytest.approx(list(want), rel=1e-6, abs=1e-8) and got[3] == 0
    assert intercept == pytest.approx(y.mean() - x.mean(axis=0) @ want, rel=1e-6)
    one = ML.least_squares(df.limit(1), ["c0", "c1"], "y")
    assert list(one[0]) == [0, 0] and one[1] == pytest.approx(df.limit(1).first()["y"])
    assert ML.least_squares(df.limit(0), ["c0"], "y") is None


def test_restarts_in_one_pass_cost_what_the_best_of_single_fits_does(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(c, 1, size=(60, 2)) for c in ((0, 0), (9, 0), (0, 9), (30, 30))])
    df = spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "key long, x array<double>")
    centres, cost = ML.fit_centres(df.repartition(5), 4, 10, 0)
    d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert cost == pytest.approx(d.min(axis=1).sum()) and np.bincount(d.argmin(axis=1)).tolist() == [60] * 4
    singles = [ML.fit_centres(df, 4, 1, s)[1] for s in range(3)]
    assert cost <= min(singles) * (1 + 1e-9)
    assert ML.fit_centres(df.limit(0), 3, 2, 0)[0].size == 0
    few = ML.fit_centres(spark.createDataFrame([(1, [1.0]), (2, [1.0])], df.schema), 3, 2, 0)
    assert few[0].tolist() == [[1.0]] and few[1] == 0


def test_comoments_are_pairwise_complete_and_stable(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(300, 4)) + [1e9, 0, -5, 1e-6]
    x[:, 3] = x[:, 0] - 1e9 + 0.1 * rng.normal(size=300)
    x[rng.random(x.shape) < 0.2] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) + (0.1, None) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double")
    got = {(r.row_measure, r.col_measure): r["corr"] for r in ST.correlation_matrix(df.repartition(9), list("abcdef")).collect()}
    import pandas as pd

    want = pd.DataFrame(x, columns=list("abcd")).corr()
    for i in "abcd":
        for j in "abcd":
            assert got[i, j] == pytest.approx(want.loc[i, j], abs=2e-6)
    assert all(got[i, j] is None for i in "ef" for j in "abcdef") and len(got) == 36
    plan = ST.correlation_matrix(df, list("abcdef"))._jdf.queryExecution().toString()
    assert plan.count("MapInArrow") >= 1


def test_text_index_equals_the_scan(spark, tel):
    from fleetscope.operators import indexes as IX

    table = B.behaviour_by_plate(tel)
    index = IX.build_text_index(table, buckets=4)
    for term in ("az0", "AZ000", "z00001", "00", "1", "", None, ".0", "100.0", "nothing", "a_0", "0000100"):
        want = sorted(map(str, B.search(table, term).collect()))
        assert sorted(map(str, IX.search_index(index, term).collect())) == want, term
    odd = spark.createDataFrame([("ÄB%c", 1.5), (None, None), ("", 2.0), ("aa", 3.0), ("ÄB%c", 1.5)], "t string, v double")
    index = IX.build_text_index(odd, buckets=2)
    for term in ("äb%", "Äb%c", "1.5", "aaa", "aa", "zz"):
        assert sorted(map(str, IX.search_index(index, term).collect())) == sorted(map(str, B.search(odd, term).collect())), term
    assert "PushedFilters: [In(gram" in index.postings.filter(F.col("gram").isin(["az0", "z00"])).groupBy("_row").count()._jdf.queryExecution().toString()


def test_deep_pages_read_the_ranges_they_lie_in(spark):
    from fleetscope.operators import indexes as IX

    df = spark.range(5000).select((F.col("id") % 700).alias("k"), F.col("id").alias("v"), (F.col("id") % 3).cast("string").alias("t"))
    index = IX.build_page_index(df.union(df.limit(20)), ["k"], rows_per_range=400)
    assert sum(index.counts) == 5020 and len(index.counts) > 8
    every = [tuple(r) for r in df.union(df.limit(20)).orderBy("k", "v", "t").collect()]
    for start, length in ((0, 25), (4000, 25), (395, 30), (5010, 25), (6000, 5), (10, 0)):
        assert [tuple(r) for r in IX.indexed_page(index, start, length).collect()] == every[start:start + length]
    found, _ = IX.ranges_of(index, 4000, 25)
    assert 1 <= len(found) <= 2
    plan = IX.indexed_page(index, 4000, 25)._jdf.queryExecution().toString()
    assert "PartitionFilters: [range_no" in plan or "PartitionFilters: [isnotnull(range_no" in plan
    empty = IX.build_page_index(df.limit(0), ["k"])
    assert IX.indexed_page(empty, 0, 10).collect() == []


def test_isolation_forest_share_and_repeatability(summary):
    a = IF.driver_anomalies(summary, n_trees=30, seed=7).cache()
    n = a.count()
    k = a.filter(F.col("anomaly") == -1).count()
    assert abs(k - 0.1 * n) <= 2
    assert a.filter(~F.col("anomaly").isin(-1, 1)).count() == 0
    b = IF.driver_anomalies(summary, n_trees=30, seed=7)
    same = a.join(b.withColumnRenamed("anomaly", "a2").withColumnRenamed("score", "s2"),
                  "driverID").filter("anomaly != a2").count()
    assert same == 0


def test_isolation_forest_flags_planted_outlier(spark):
    rng = np.random.default_rng(1)
    pts = [(f"d{i}", float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1, (200, 2)))]
    pts.append(("far", 40.0, -40.0))
    df = spark.createDataFrame(pts, "driverID string, a double, b double")
    out = IF.driver_anomalies(df, columns=["a", "b"], n_trees=50, seed=3)
    top = out.orderBy(F.desc("score")).first()
    assert top["driverID"] == "far" and top["anomaly"] == -1


def test_value_counts_descending(summary):
    vc = ST.value_counts(ML.split_flag(summary), "is_test").collect()
    assert vc[0]["count"] >= vc[-1]["count"]


def test_earliest_per_date_small(spark):
    tel = load_telemetry(spark, SF_SMALL)
    e = S.earliest_of_date(tel, "2017-01-01").first()["timestamp"]
    pdf = tel.select("Time").toPandas()
    want = pdf[pdf["Time"].dt.strftime("%Y-%m-%d") == "2017-01-01"]["Time"].min()
    assert e == want.strftime("%Y-%m-%d %H:%M:%S")


def test_kmeans_cost_close_to_numpy_lloyd(summary):
    from fleetscope.operators.ml import assemble

    pdf = summary.toPandas()[MEASURES].astype(float).fillna(0.0)
    x = pdf.to_numpy()

    def lloyd(seed):
        rng = np.random.default_rng(seed)
        c = x[rng.choice(len(x), 3, replace=False)]
        for _ in range(300):
            lab = ((x[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
            new = np.array([x[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(3)])
            if np.allclose(new, c):
                break
            c = new
        return ((x - c[lab]) ** 2).sum()

    best_numpy = min(lloyd(s) for s in range(10))
    labels = ML.driver_clusters(summary).toPandas()
    feats = assemble(summary).select("driverID", *MEASURES).toPandas()
    merged = feats.merge(labels, on="driverID")
    centres = merged.groupby("cluster")[MEASURES].mean()
    ours = sum(((merged[merged["cluster"] == j][MEASURES] - centres.loc[j]) ** 2).to_numpy().sum()
               for j in centres.index)
    assert ours <= best_numpy * 1.05
