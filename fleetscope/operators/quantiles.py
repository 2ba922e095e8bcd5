"""Exact quantiles in one sort (used by A5 medians, A11 quartiles, M6's threshold).

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer. Here equal values are counted first, the distinct ones are
range-partitioned by (group, value) over many tasks, and their running counts are
sums within a range plus the totals of the ranges before it. The rows that hold
the wanted ranks are then a filter: no passes, no caps on groups or values, and
any double (infinities, denormals) has its place. Results use linear
interpolation between the two closest ranks, like ``percentile`` and numpy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.sources.sinks import materialize


def quantile_table(long: DataFrame, key: str, value: str, probs: list[float]) -> DataFrame:
    """``(k, p, quantile)``: one row per group with values and per probability.

    ``long`` holds ``(key, value)`` rows; nulls and NaN are ignored."""
    data = long.select(F.col(key).alias("k"), F.col(value).cast("double").alias("v")) \
        .filter(F.col("v").isNotNull() & ~F.isnan("v"))
    counted = data.groupBy("k", "v").agg(F.count(F.lit(1)).alias("c"))
    # written once: range borders are sampled per execution, and all consumers need the same
    ranged = materialize(counted.repartitionByRange("k", "v").withColumn("part", F.spark_partition_id()), "quantile-values")
    parts = ranged.groupBy("k", "part").agg(F.sum("c").alias("rows"))
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("k").alias("_k"), F.col("part").alias("_part"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
                         F.sum("rows").over(Window.partitionBy("k")).alias("n"))
    inside = Window.partitionBy("k", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranged.withColumn("_to", F.sum("c").over(inside))
    ranked = ranked.join(parts, ranked["k"].eqNullSafe(parts["_k"]) & (ranked["part"] == parts["_part"]))
    last = F.col("start") + F.col("_to") - 1
    ranked = ranked.select("k", "v", "n", (last - F.col("c") + 1).alias("lo"), last.alias("hi"))
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p")) for p in probs])
    asked = ranked.select("k", "v", "lo", "hi", F.explode(wanted).alias("w"), "n").withColumn("pos", (F.col("n") - 1) * F.col("w.p"))
    holds = lambda r: (F.col("lo") <= r) & (r <= F.col("hi"))
    low, high = F.floor("pos"), F.ceil("pos")
    hit = asked.filter(holds(low) | holds(high))
    per = hit.groupBy("k", F.col("w.p").alias("p")).agg(F.max(F.when(holds(low), F.col("v"))).alias("a"), F.max(F.when(holds(high), F.col("v"))).alias("b"),
                                                        F.first("pos").alias("pos"))
    mixed = (F.ceil("pos") - F.col("pos")) * F.col("a") + (F.col("pos") - F.floor("pos")) * F.col("b")
    return per.select("k", "p", F.when(F.col("a") == F.col("b"), F.col("a")).when(F.floor("pos") == F.col("pos"), F.col("a"))
                      .otherwise(mixed).alias("quantile"))


def exact_quantiles(long: DataFrame, key: str, value: str, probs: list[float]) -> dict:
    """``{(key_value, p): quantile}`` on the driver: one entry per group and probability."""
    return {(r["k"], r["p"]): r["quantile"] for r in quantile_table(long, key, value, probs).collect()}


def column_quantiles(df: DataFrame, column: str, probs: list[float]) -> list:
    """Exact quantiles of one column, in the order of ``probs``."""
    long = df.select(F.lit(0).alias("k"), F.col(column).alias("v"))
    res = exact_quantiles(long, "k", "v", probs)
    return [res.get((0, float(p))) for p in probs]
