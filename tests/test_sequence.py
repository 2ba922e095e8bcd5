"""The bucketed predecessor equals a plain window, whatever the bucket
width and key skew (hot keys, null keys, null times, ties)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetscope.operators import trips as TR
from fleetscope.operators.sequence import PREV_TS, with_previous_time
from fleetscope.sources.telemetry import load_telemetry
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def skewed(spark):
    tel = load_telemetry(spark, SF_SMALL)
    driver = (F.when(F.col("event_id") % 3 == 0, F.lit("HOT"))
              .when(F.col("event_id") % 17 == 0, F.lit(None).cast("string"))
              .otherwise(F.col("driverID")))
    time = F.when(F.col("event_id") % 29 == 0, F.lit(None)).otherwise(F.col("Time"))
    # Many equal times inside the hot key.
    time = F.when(F.col("event_id") % 5 == 0, F.to_timestamp_ntz(F.lit("2017-01-01 09:00:00"))) \
        .otherwise(time)
    return tel.withColumn("driverID", driver).withColumn("Time", time).cache()


def _reference(df):
    w = Window.partitionBy("driverID").orderBy(F.col("Time").asc_nulls_first(), "event_id")
    return df.select("event_id", F.timestamp_diff("SECOND", F.lag("Time").over(w),
                                                  F.col("Time")).alias("ref"))


@pytest.mark.parametrize("n", [1, 30, 3600, 86_400, 10**9])
def test_predecessor_matches_window(skewed, n):
    got = with_previous_time(skewed, "driverID", "Time", "event_id", n)
    got = got.select("event_id", (F.col("_ts") - F.col(PREV_TS)).alias("dt"))
    bad = got.join(_reference(skewed), "event_id").filter(~F.col("dt").eqNullSafe(F.col("ref")))
    assert bad.count() == 0
    assert got.count() == skewed.count()


@pytest.mark.parametrize("n", [7, 3600, 10**9])
def test_step_sum_matches_window(skewed, n):
    w = Window.partitionBy("driverID").orderBy(F.col("Time").asc_nulls_first(), "event_id")
    ref = (skewed.withColumn("dt", F.timestamp_diff("SECOND", F.lag("Time").over(w), F.col("Time")))
           .groupBy("driverID").agg((F.sum(F.col("Speed") * F.col("dt")) / 3600.0).alias("ref")))
    got = TR.driver_distance(skewed, bucket_seconds=n)
    bad = got.join(ref, got["driverID"].eqNullSafe(ref["driverID"]), "full") \
        .filter(~F.col("total_distance").eqNullSafe(F.col("ref")))
    assert bad.count() == 0
    assert got.count() == ref.count()


def test_hot_key_spreads_over_buckets_in_one_scan_and_shuffle(skewed):
    from fleetscope.operators.sequence import BUCKET, _in_buckets
    hot = _in_buckets(skewed, "driverID", "Time", "event_id", 86_400).filter(F.col("driverID") == "HOT")
    assert hot.select(BUCKET).distinct().count() >= 4
    plan = TR.driver_summary(load_telemetry(skewed.sparkSession, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Pandas" not in plan and "Arrow" not in plan
    assert plan.count("hashpartitioning(driverID") == 2  # the facts by (driver, bucket), then the buckets by driver


def test_summary_keeps_null_driver_distance(skewed):
    got = TR.driver_summary(skewed).filter(F.col("driverID").isNull()).first()
    w = Window.partitionBy("driverID").orderBy(F.col("Time").asc_nulls_first(), "event_id")
    ref = (skewed.filter(F.col("driverID").isNull())
           .withColumn("dt", F.timestamp_diff("SECOND", F.lag("Time").over(w), F.col("Time")))
           .agg((F.sum(F.col("Speed") * F.col("dt")) / 3600.0).alias("d")).first()["d"])
    assert got is not None and got["total_distance"] == ref


def test_session_partitions_with_aqe_coalescing(spark, skewed):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
        got = with_previous_time(skewed, "driverID", "Time", "event_id")
        got = got.select("event_id", (F.col("_ts") - F.col(PREV_TS)).alias("dt"))
        bad = got.join(_reference(skewed), "event_id").filter(~F.col("dt").eqNullSafe(F.col("ref")))
        assert bad.count() == 0
        w = Window.partitionBy("driverID").orderBy(F.col("Time").asc_nulls_first(), "event_id")
        ref = (skewed.withColumn("dt", F.timestamp_diff("SECOND", F.lag("Time").over(w), F.col("Time")))
               .groupBy("driverID").agg((F.sum(F.col("Speed") * F.col("dt")) / 3600.0).alias("ref")))
        dist = TR.driver_distance(skewed)
        bad = dist.join(ref, dist["driverID"].eqNullSafe(ref["driverID"]), "full") \
            .filter(~F.col("total_distance").eqNullSafe(F.col("ref")))
        assert bad.count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
