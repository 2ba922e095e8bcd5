"""Statistics over the per-driver summary.

The summary has one row per driver. Every statistic here is a Spark
aggregate over it; the correlation matrix comes from co-moments that each
task works out on its rows as a matrix and that are merged as a tree. Only the three quartiles of the
box plot cross to the driver, as scalars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.operators.quantiles import column_quantiles, quantile_table
from fleetscope.schema import MEASURES
from fleetscope.session import ship_package

# Fixed-point rendering, 6 decimals, as the published matrix.
DECIMALS = 6


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def to_long(df: DataFrame, columns: list[str], name: str = "measure",
            value: str = "value") -> DataFrame:
    """Unpivot ``columns`` to ``(measure, measure_idx, value)`` rows."""
    structs = ", ".join(
        f"named_struct('{name}', '{c}', '{name}_idx', {i}, '{value}', CAST(`{c}` AS DOUBLE))"
        for i, c in enumerate(columns))
    return df.selectExpr(f"inline(array({structs}))")


def summary_stats(summary: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A5: mean, exact median and sample standard deviation of each numeric
    column, nulls skipped; one row per measure.

    Mean and deviation are one partial aggregate over the unpivoted table; the
    medians come from ``operators.quantiles`` and are joined back, one row per measure.
    """
    cols = columns or numeric_columns(summary)
    long = to_long(summary, cols)
    moments = long.groupBy("measure", "measure_idx").agg(
        F.round(F.avg("value"), DECIMALS).alias("mean"),
        F.round(F.stddev_samp("value"), DECIMALS).alias("std"),
    )
    medians = quantile_table(long, "measure", "value", [0.5]).select(F.col("k").alias("measure"), F.col("quantile").alias("median"))
    joined = moments.join(medians, "measure", "left")
    return joined.select("measure", "measure_idx", "mean",
                         F.round("median", DECIMALS).alias("median"), "std")


def _comoments(x: np.ndarray) -> np.ndarray:
    """Of every pair (i, j) of columns, over the rows where neither is NaN: n, mean of i, sum of squares of i and sum of
    products around those means, least and largest i."""
    here = ~np.isnan(x)
    out = np.zeros((6, x.shape[1], x.shape[1]))
    out[4], out[5] = np.inf, -np.inf
    for i in range(x.shape[1]):
        both = here[:, [i]] & here
        n = both.sum(axis=0)
        xi = np.where(both, x[:, [i]], 0.0)
        xj = np.where(both, x, 0.0)
        di = np.where(both, xi - xi.sum(axis=0) / np.maximum(n, 1), 0.0)
        dj = np.where(both, xj - xj.sum(axis=0) / np.maximum(n, 1), 0.0)
        out[:4, i] = n, xi.sum(axis=0) / np.maximum(n, 1), (di * di).sum(axis=0), (di * dj).sum(axis=0)
        out[4, i], out[5, i] = np.where(both, x[:, [i]], np.inf).min(axis=0, initial=np.inf), np.where(both, x[:, [i]], -np.inf).max(axis=0, initial=-np.inf)
    return out


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two parts as one (Chan's formula)."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    d, w = b[1] - a[1], a[0] * share
    return np.stack([n, a[1] + d * share, a[2] + b[2] + d * d * w, a[3] + b[3] + d * d.T * w, np.minimum(a[4], b[4]), np.maximum(a[5], b[5])])


_PART = "shard long, m array<double>"


def comoment_table(df: DataFrame, cols: list[str], fan: int = 64) -> DataFrame:
    """(i, j, n, mx, my, mxx, myy, mxy, flat) for i <= j: the co-moments of every pair of columns; ``flat`` if one of the
    two is constant over the rows that have both.

    A task reads its rows as one matrix and hands on one row, whatever it read; those rows are merged ``fan`` at a time, then
    all of them. Pairs without a common row have n = 0."""
    p = len(cols)
    ship_package(df.sparkSession)

    def part(total: np.ndarray | None, shard: int) -> pa.RecordBatch:
        flat = np.zeros((6, p, p)) if total is None else total
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([flat.ravel().tolist()], pa.list_(pa.float64()))], names=["shard", "m"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, shard = None, 0
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in range(p)])
                total = _comoments(x) if total is None else _merged(total, _comoments(x))
                shard = int(batch.column(p)[0].as_py())
        if total is not None:
            yield part(total, shard)

    def merge(key: tuple[pa.Scalar, ...], group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in group:
            for m in batch.column("m").to_pylist():
                x = np.array(m).reshape(6, p, p)
                total = x if total is None else _merged(total, x)
        yield part(total, 0)

    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)], F.pmod(F.spark_partition_id(), F.lit(fan)).cast("long").alias("shard"))
    parts = values.mapInArrow(read, _PART).groupBy("shard").applyInArrow(merge, _PART).groupBy("shard").applyInArrow(merge, _PART)
    cell = lambda k, i, j: f"m[{k * p * p + i * p + j}]"
    cells = ", ".join(
        f"named_struct('i', {i}, 'j', {j}, 'n', {cell(0, i, j)}, 'mx', {cell(1, i, j)}, 'my', {cell(1, j, i)}, 'mxx', {cell(2, i, j)}, 'myy', {cell(2, j, i)}, "
        f"'mxy', {cell(3, i, j)}, 'flat', {cell(4, i, j)} >= {cell(5, i, j)} OR {cell(4, j, i)} >= {cell(5, j, i)})" for i in range(p) for j in range(i, p))
    return parts.selectExpr(f"inline(array({cells}))")  # of the one row that is left


def correlation_matrix(summary: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A6 + P17: Pearson correlation of every column pair, in long form
    ``(row_measure, col_measure, row_idx, col_idx, corr)``.

    Pairwise-complete: a pair uses the rows where both values are present.
    A zero-variance column gives null instead of a division error.
    """
    cols = columns or [c for c in MEASURES if c in summary.columns]
    agg = comoment_table(summary, cols)
    corr = F.when(~F.col("flat"), F.try_divide(F.col("mxy"), F.sqrt("mxx") * F.sqrt("myy")))
    upper = agg.select("i", "j", corr.alias("corr"))
    lower = upper.filter(F.col("i") != F.col("j")).select(
        F.col("j").alias("i"), F.col("i").alias("j"), "corr")
    names = F.array(*[F.lit(c) for c in cols])
    both = upper.unionByName(lower)
    return both.select(
        F.element_at(names, F.col("i") + 1).alias("row_measure"),
        F.element_at(names, F.col("j") + 1).alias("col_measure"),
        F.col("i").alias("row_idx"), F.col("j").alias("col_idx"),
        # Clamp rounding noise into [-1, 1]; greatest/least would turn null into a bound.
        F.when(F.col("corr").isNotNull(),
               F.round(F.least(F.greatest(F.col("corr"), F.lit(-1.0)), F.lit(1.0)), DECIMALS))
        .alias("corr"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """A7 + L4: frequency of each value, most frequent first."""
    return df.groupBy(column).count().orderBy(F.desc("count"), F.asc(column))


def quartiles(df: DataFrame, column: str) -> tuple[float | None, float | None, float | None]:
    """Exact linear-interpolation quartiles of one column (three scalars),
    by bounded-memory selection rather than one all-values buffer."""
    q = column_quantiles(df, column, [0.25, 0.5, 0.75])
    return q[0], q[1], q[2]


def boxplot_stats(df: DataFrame, column: str = "total_rapid_accelerations") -> DataFrame:
    """Quartiles, whiskers at the most extreme values within 1.5 IQR of
    the box, and the number of outliers beyond them (one row)."""
    q1, q2, q3 = quartiles(df, column)
    x = F.col(column).cast("double")
    if q1 is None:
        lo_fence = hi_fence = F.lit(None).cast("double")
    else:
        iqr = q3 - q1
        lo_fence, hi_fence = F.lit(q1 - 1.5 * iqr), F.lit(q3 + 1.5 * iqr)
    inside = (x >= lo_fence) & (x <= hi_fence)
    return df.agg(
        F.lit(q1).cast("double").alias("q1"),
        F.lit(q2).cast("double").alias("median"),
        F.lit(q3).cast("double").alias("q3"),
        F.lit(None if q1 is None else q3 - q1).cast("double").alias("iqr"),
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(x.isNotNull() & ~inside).alias("n_outliers"),
    ).select(*[F.round(c, DECIMALS).alias(c) if c != "n_outliers" else F.col(c)
               for c in ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high",
                         "n_outliers"]])


def boxplot_outliers(df: DataFrame, column: str = "total_rapid_accelerations",
                     key: str = "driverID") -> DataFrame:
    """A11 outlier points: rows beyond the 1.5 IQR fences."""
    q1, _, q3 = quartiles(df, column)
    if q1 is None:
        return df.select(key, column).filter(F.lit(False))
    iqr = q3 - q1
    x = F.col(column).cast("double")
    return df.select(key, column).filter((x < q1 - 1.5 * iqr) | (x > q3 + 1.5 * iqr))


def bar_values(summary: DataFrame, key: str = "driverID",
               value: str = "total_overspeed_duration") -> DataFrame:
    """Bar height per category, the mean of ``value`` (one row per driver,
    so the value itself)."""
    return summary.groupBy(key).agg(F.avg(value).alias(value))
