"""Bounded-memory exact quantiles equal numpy's linear interpolation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetscope.operators.quantiles import column_quantiles, exact_quantiles


@pytest.mark.parametrize("seed", [0, 1])
def test_random_values(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.lognormal(0, 3, 3000), np.full(2000, 7.25), rng.integers(0, 5, 500)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = column_quantiles(df, "v", probs)
    assert got == pytest.approx(list(np.percentile(x, [p * 100 for p in probs])), rel=1e-12)


def test_groups_nulls_and_constants(spark):
    rows = [("a", float(i)) for i in range(10)] + [("b", 3.0)] * 4 + [("c", None)] + \
           [("d", 1e300), ("d", -1e-300), ("d", 5e-324)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = exact_quantiles(df, "k", "v", [0.5])
    assert got[("a", 0.5)] == 4.5
    assert got[("b", 0.5)] == 3.0
    assert ("c", 0.5) not in got
    assert got[("d", 0.5)] == 5e-324


def test_matches_spark_percentile(spark):
    df = spark.range(0, 20001).select((F.col("id") * 7 % 1013 / 3.0).alias("v"))
    want = df.agg(F.percentile("v", [0.25, 0.5, 0.75])).first()[0]
    assert column_quantiles(df, "v", [0.25, 0.5, 0.75]) == pytest.approx(want, rel=1e-12)


def test_infinities_and_many_groups(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, float("inf"))], "v double")
    assert column_quantiles(df, "v", [0.5, 1.0]) == [3.0, float("inf")]
    many = spark.range(6000).select((F.col("id") % 2000).alias("k"), F.col("id").cast("double").alias("v"))
    got = exact_quantiles(many, "k", "v", [0.5])
    assert len(got) == 2000 and all(got[(k, 0.5)] == k + 2000.0 for k in range(2000))
