"""Machine learning on the per-driver summary (P12, M1-M5, M2/M7 via A7).

Fits are scans whose tasks hand on sums or factors; only fitted parameters (the
restarts' centres, one triangular factor) reach the driver. Features are
null-filled first (P12 + Q11), as the fits know no missing values.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.schema import MEASURES, REGRESSION_FEATURES, REGRESSION_LABEL
from fleetscope.session import ship_package


def assemble(summary: DataFrame, columns: list[str] = MEASURES, key: str = "driverID",
             out: str = "features", extra: list[str] | None = None) -> DataFrame:
    """Null-filled numeric columns assembled into one vector column."""
    extra = [c for c in (extra or []) if c not in columns]
    filled = summary.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                   for c in columns], *extra)
    return VectorAssembler(inputCols=columns, outputCol=out).transform(filled)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows by centres."""
    return ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)


def _seeds(data: DataFrame, k: int, n_init: int, seed: int) -> list[np.ndarray]:
    """Starting centres of all restarts by k-means++, one job per centre for all restarts at once.

    A row is drawn with a weight (its squared distance to the centres so far) by taking the largest log(u) / weight, where
    u is a number of its key, the restart and the step: the draws are the same however the rows are cut."""
    chosen: list[list[np.ndarray]] = [[] for _ in range(n_init)]
    for step in range(k):
        so_far = [np.array(c) for c in chosen]

        def best(batches: Iterator[pa.RecordBatch], so_far=so_far) -> Iterator[pa.RecordBatch]:
            top: dict[int, tuple[float, int, list[float]]] = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch.column("x"))
                for r, centres in enumerate(so_far):
                    u = (batch.column(f"u{r}").to_numpy() + 0.5) / 2.0**31
                    weight = _distances(x, centres).min(axis=1) if len(centres) else np.ones(len(x))
                    score = np.where(weight > 0, np.log(u) / np.where(weight > 0, weight, 1.0), -np.inf)
                    i = int(np.argmax(score))
                    if r not in top or score[i] > top[r][0]:
                        top[r] = (float(score[i]), i, x[i].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(list(top), pa.int32()), pa.array([v[0] for v in top.values()], pa.float64()),
                                              pa.array([v[2] for v in top.values()], pa.list_(pa.float64()))], names=["r", "score", "x"])

        numbers = [F.pmod(F.xxhash64("key", F.lit(seed + r), F.lit(step)), F.lit(1 << 31)).alias(f"u{r}") for r in range(n_init)]
        drawn = (data.select("x", *numbers).mapInArrow(best, "r int, score double, x array<double>")
                 .groupBy("r").agg(F.max(F.struct("score", "x")).alias("m")).select("r", "m.score", "m.x").collect())  # a row per restart
        for row in drawn:
            if row["score"] > -np.inf:  # else all rows are centres already
                chosen[row["r"]].append(np.array(row["x"]))
    return [np.array(c) for c in chosen]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _step(data: DataFrame, sets: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """One scan: every set of centres with its sums and counts per centre, and its cost."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {r: np.zeros((len(c), c.shape[1] + 2)) for r, c in sets.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            for r, c in sets.items():
                d = _distances(x, c)
                near = d.argmin(axis=1)
                np.add.at(sums[r], near, np.column_stack([x, np.ones(len(x)), d[np.arange(len(x)), near]]))
        rows = [(r, i, j, v) for r, s in sums.items() for (i, j), v in np.ndenumerate(s)]
        r, i, j, v = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(v, pa.float64())], names=["r", "i", "j", "v"])

    total = {r: np.zeros((len(c), c.shape[1] + 2)) for r, c in sets.items()}
    for row in data.select("x").mapInArrow(add, "r int, i int, j int, v double").groupBy("r", "i", "j").agg(F.sum("v").alias("v")).collect():
        total[row["r"]][row["i"], row["j"]] = row["v"]  # restarts x centres x measures
    return {r: (t[:, :-2], t[:, -2], float(t[:, -1].sum())) for r, t in total.items()}


def fit_centres(data: DataFrame, k: int, n_init: int, seed: int, max_iter: int = 300, tol: float = 1e-4) -> tuple[np.ndarray, float]:
    """(centres, cost) of the best of ``n_init`` restarts over ``data`` (key, x). All restarts move in the same scan, one job
    per iteration; one that moves less than ``tol`` (of the mean variance, squared) takes part no more."""
    sets = {r: c for r, c in enumerate(_seeds(data, k, n_init, seed)) if len(c)}
    if not sets:
        return np.zeros((0, 0)), 0.0
    spread = data.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.var_pop("v").alias("v")).agg(F.avg("v")).first()[0]
    least, final = tol * (spread or 0.0), {}
    for _ in range(max_iter):
        moved = _step(data, sets)
        going = {}
        for r, (s, n, _) in moved.items():
            new = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], sets[r])
            if ((new - sets[r]) ** 2).sum() > least:
                going[r] = new
            final[r] = new
        if not going:
            break
        sets = going
    costs = _step(data, final)
    best = min(final, key=lambda r: (costs[r][2], r))
    return final[best], costs[best][2]


def driver_clusters(summary: DataFrame, k: int = 3, n_init: int = 10, seed: int = 0,
                    max_iter: int = 300, key: str = "driverID") -> DataFrame:
    """M1: k-means on the eleven unscaled measures; the best of ``n_init``
    seeded restarts (lowest within-cluster sum of squares) labels each driver.

    Labels are made independent of the restart by numbering clusters in order of
    their centre (lexicographic over the measures). Blank measures count as 0.
    """
    ship_package(summary.sparkSession)
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in MEASURES])
    data = summary.select(F.col(key).alias("key"), x.alias("x"))
    centres, _ = fit_centres(data, k, n_init, seed, max_iter)
    centres = centres[np.lexsort(centres.T[::-1])] if len(centres) else centres

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _distances(_matrix(batch.column("x")), centres).argmin(axis=1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(near.astype(np.int32))], names=["key", "cluster"])

    kind = data.schema["key"].dataType.simpleString()
    return data.mapInArrow(label, f"key {kind}, cluster int").withColumnRenamed("key", key)


#: Seed of the train/test split.
SPLIT_SEED = 42


def split_flag(summary: DataFrame, test_fraction: float = 0.2, seed: int = SPLIT_SEED,
               key: str = "driverID") -> DataFrame:
    """M3: deterministic train/test split by an MD5 of key and seed
    (about ``test_fraction`` of the rows in the test set, stable across runs and
    engines). A null key counts as the empty text."""
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed))).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10_000
    return summary.withColumn("is_test", bucket < F.lit(int(round(test_fraction * 10_000))))


_FACTOR = "shard long, r array<double>"


def _stack(m: np.ndarray) -> np.ndarray:
    """The triangular factor of a tall matrix."""
    return np.linalg.qr(m, mode="r") if len(m) > m.shape[1] else m


def triangular_factor(df: DataFrame, columns: list[str], fan: int = 64) -> np.ndarray:
    """R of the QR decomposition of (1, ``columns``): every task factors its own rows, and the factors are stacked and factored
    again, ``fan`` of them at a time, then all. Unlike normal equations it does not square the condition of the columns."""
    p = len(columns) + 1
    ship_package(df.sparkSession)

    def out(r: np.ndarray, shard: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], names=["shard", "r"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, shard = np.zeros((0, p)), 0
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([np.ones(batch.num_rows), *(batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in range(p - 1))])
                r, shard = _stack(np.vstack([r, x])), int(batch.column(p - 1)[0].as_py())
        if len(r):
            yield out(r, shard)

    def merge(key: tuple[pa.Scalar, ...], group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, p))
        for batch in group:
            for part in batch.column("r").to_pylist():
                r = _stack(np.vstack([r, np.array(part).reshape(-1, p)]))
        yield out(r, 0)

    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)], F.pmod(F.spark_partition_id(), F.lit(fan)).cast("long").alias("shard"))
    found = rows.mapInArrow(read, _FACTOR).groupBy("shard").applyInArrow(merge, _FACTOR).groupBy("shard").applyInArrow(merge, _FACTOR).collect()  # one row
    r = np.array(found[0]["r"]).reshape(-1, p) if found else np.zeros((0, p))
    return np.linalg.qr(r, mode="r") if len(r) else r


def least_squares(df: DataFrame, features: list[str], label: str) -> tuple[np.ndarray, float] | None:
    """(coefficients, intercept) of ordinary least squares; of all solutions, as with constant, repeated or dependent
    columns, the one with the smallest coefficients. None for an empty table.

    The first column of R belongs to the intercept, so the rest below it is R of the columns around their means."""
    r = triangular_factor(df, [*features, label])
    if not len(r):
        return None
    p = len(features)
    mean = r[0] / r[0, 0]
    inner = r[1:p + 2]
    if not len(inner):
        return np.zeros(p), float(mean[p + 1])
    # columns that are constant but for rounding are constant
    scale = np.abs(r[0, 1:p + 1])
    a = np.where(np.linalg.norm(inner[:, 1:p + 1], axis=0) > 1e-12 * scale, inner[:, 1:p + 1], 0.0)
    coefficients = np.linalg.lstsq(a, inner[:, p + 1], rcond=1e-12)[0]
    return coefficients, float(mean[p + 1] - mean[1:p + 1] @ coefficients)


def _regression_data(summary: DataFrame, test_fraction: float, seed: int, key: str) -> DataFrame:
    split = split_flag(summary, test_fraction, seed, key)
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in REGRESSION_FEATURES]
    return split.select(key, *filled, F.col(REGRESSION_LABEL).cast("double").alias(REGRESSION_LABEL), "is_test")


def fit_speed_regression(summary: DataFrame, test_fraction: float = 0.2, seed: int = SPLIT_SEED,
                         key: str = "driverID") -> tuple[np.ndarray, float] | None:
    """M4: ordinary least squares ``average_speed ~ seven behaviour totals`` on the rows of the training part that have
    an average speed."""
    data = _regression_data(summary, test_fraction, seed, key)
    return least_squares(data.filter(~F.col("is_test") & F.col(REGRESSION_LABEL).isNotNull()), REGRESSION_FEATURES, REGRESSION_LABEL)


def regression_coefficients(summary: DataFrame, test_fraction: float = 0.2,
                            seed: int = SPLIT_SEED) -> DataFrame:
    """M4 output: one row per feature (plus the intercept); no rows without training rows."""
    fit = fit_speed_regression(summary, test_fraction, seed)
    rows = [] if fit is None else [*((f, float(c)) for f, c in zip(REGRESSION_FEATURES, fit[0], strict=True)), ("intercept", fit[1])]
    return summary.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def regression_predictions(summary: DataFrame, test_fraction: float = 0.2, seed: int = SPLIT_SEED,
                           key: str = "driverID") -> DataFrame:
    """M5: ``(key, label, prediction)`` of the test part."""
    fit = fit_speed_regression(summary, test_fraction, seed, key)
    test = _regression_data(summary, test_fraction, seed, key).filter("is_test")
    value = F.lit(None).cast("double") if fit is None else reduce(
        lambda a, b: a + b, [F.col(f) * F.lit(float(c)) for f, c in zip(REGRESSION_FEATURES, fit[0], strict=True)], F.lit(fit[1]))
    return test.select(key, REGRESSION_LABEL, value.alias("prediction"))


def regression_score(summary: DataFrame, test_fraction: float = 0.2, seed: int = SPLIT_SEED) -> DataFrame:
    """M5: R-squared ``1 - SSres/SStot`` of the predictions on the test part."""
    pred = regression_predictions(summary, test_fraction, seed)
    y = F.col(REGRESSION_LABEL)
    # One pass: SStot = n * population variance (Spark's stable online form).
    n = F.count(F.lit(1))
    ss_res = F.sum((y - F.col("prediction")) ** 2)
    ss_tot = F.var_pop(y) * n
    return pred.agg(n.alias("n_test"),
                    (F.lit(1.0) - F.try_divide(ss_res, ss_tot)).alias("r2"))
