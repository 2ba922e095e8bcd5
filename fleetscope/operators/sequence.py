"""Predecessor of each record in time order per key, skew-safe.

``lag(Time).over(Window.partitionBy(key).orderBy(Time))`` puts every record of
one key into one task. Here the window runs per ``(key, time bucket)``: a key
that holds a third of all rows is cut along time into as many tasks as it has
buckets. Only the first record of a bucket has its predecessor elsewhere: it is
the last record of the key's previous bucket that holds any. First records and
bucket totals are one row per ``(key, bucket)``, bounded by the time span, so the
window over them per key is small.

Everything stays in the JVM (windows and hash aggregates), the facts are scanned
and shuffled once, and the bucket width is an argument, not a size-based choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.functions.expr import epoch_seconds

TS = "_ts"
PREV_TS = "_prev_ts"
BUCKET = "_bucket"
FIRST = "_first"
#: Default bucket width.
DAY = 86_400


def _in_buckets(df: DataFrame, key: str, time: str, tiebreak: str, bucket_seconds: int) -> DataFrame:
    """Adds whole seconds, bucket, the predecessor's seconds within the bucket,
    and whether the row is its bucket's first. Null times sort first, as a bucket of their own."""
    rows = df.withColumn(TS, epoch_seconds(time)).withColumn(BUCKET, F.floor(F.col(TS) / F.lit(int(bucket_seconds))))
    w = Window.partitionBy(key, BUCKET).orderBy(F.col(TS).asc_nulls_first(), F.col(tiebreak).asc_nulls_first())
    # a marker instead of row_number() = 1, so that Catalyst does not turn the filter
    # into a limit of its own below the shuffle that all consumers share
    return rows.withColumn(PREV_TS, F.lag(TS).over(w)).withColumn(FIRST, F.lag(F.lit(1)).over(w).isNull())


def _previous_bucket(key: str, value: Column) -> Column:
    return F.lag(value).over(Window.partitionBy(key).orderBy(F.col(BUCKET).asc_nulls_first()))


def with_previous_time(df: DataFrame, key: str, time: str, tiebreak: str, bucket_seconds: int = DAY) -> DataFrame:
    """W1 per record: adds ``_ts`` (whole seconds of ``time``) and ``_prev_ts``
    (whole seconds of the previous record of the same key in (time, tiebreak)
    order; null for a key's first record)."""
    rows = _in_buckets(df, key, time, tiebreak, bucket_seconds)
    every = Window.partitionBy(key, BUCKET)
    rows = rows.withColumn("_last", F.max(TS).over(every))
    firsts = rows.filter(FIRST).withColumn(PREV_TS, _previous_bucket(key, F.col("_last")))
    return rows.filter(~F.col(FIRST)).unionByName(firsts).drop(BUCKET, FIRST, "_last")


def bucket_totals(df: DataFrame, key: str, time: str, tiebreak: str, weight: str, totals: dict[str, Column],
                  bucket_seconds: int = DAY) -> DataFrame:
    """One row per ``(key, bucket)``: the aggregates ``totals`` and ``_steps``, the
    sum of ``weight_i * (seconds_i - seconds_{i-1})`` over the bucket's records,
    the first one's step reaching into the previous bucket."""
    rows = _in_buckets(df, key, time, tiebreak, bucket_seconds)
    step = F.col(weight) * (F.col(TS) - F.col(PREV_TS))
    per = rows.groupBy(key, BUCKET).agg(
        *[c.alias(n) for n, c in totals.items()],
        F.sum(step).alias("_inner"), F.max(TS).alias("_last"),
        F.max(F.when(F.col(FIRST), F.col(TS))).alias("_first_ts"),
        F.max(F.when(F.col(FIRST), F.col(weight))).alias("_first_weight"))
    per = per.withColumn("_edge", F.col("_first_weight") * (F.col("_first_ts") - _previous_bucket(key, F.col("_last"))))
    both = F.coalesce("_inner", F.lit(0)) + F.coalesce("_edge", F.lit(0))
    steps = F.when(F.col("_inner").isNotNull() | F.col("_edge").isNotNull(), both)
    return per.select(key, *totals, steps.alias("_steps"))


def step_weighted_sum(df: DataFrame, key: str, time: str, tiebreak: str, weight: str, bucket_seconds: int = DAY) -> DataFrame:
    """Per key ``(key, value)``: ``sum(weight_i * (seconds_i - seconds_{i-1}))``, the
    first record of a key contributing nothing; null when no step has both a
    weight and a time difference (as ``sum`` over nulls)."""
    return (bucket_totals(df, key, time, tiebreak, weight, {}, bucket_seconds)
            .groupBy(key).agg(F.sum("_steps").alias("value")))
