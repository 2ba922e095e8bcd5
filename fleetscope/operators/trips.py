"""Per-record travel and the per-driver summary.

The nine behaviour sums, the mean speed and the travelled distance come from one
pass: records are windowed per (driver, time bucket), aggregated per bucket, and
the buckets per driver (see ``operators.sequence``), so one scan and one shuffle
of the facts serve all eleven measures, and no driver is gathered into one task.
Distance is accumulated as ``km/h x s`` and divided by 3600 once per driver:
exact for whole speeds, in doubles for fractional ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.expr import format_time
from fleetscope.operators.sequence import DAY, PREV_TS, TS, bucket_totals, step_weighted_sum, with_previous_time
from fleetscope.schema import MEASURES


def with_tiebreak(telemetry: DataFrame, tiebreak: str = "event_id") -> tuple[DataFrame, str]:
    """Make equal times of one driver orderable: ``event_id`` when present,
    otherwise a hash of the whole record (files carry no record id)."""
    if tiebreak in telemetry.columns:
        return telemetry, tiebreak
    cols = [F.col(c) for c in telemetry.columns]
    return telemetry.withColumn("_row_hash", F.xxhash64(*cols)), "_row_hash"


def record_travel(telemetry: DataFrame, tiebreak: str = "event_id",
                  bucket_seconds: int = DAY,
                  keep: list[str] | None = None) -> DataFrame:
    """W1 + P7: per record, hours since the driver's previous record and the
    distance ``Speed x hours`` (both null for a driver's first record).

    ``keep`` names the columns to carry along (default: all).
    """
    if keep is not None:
        needed = list(dict.fromkeys(["driverID", "Time", "Speed"] + keep +
                                    ([tiebreak] if tiebreak in telemetry.columns else [])))
        telemetry = telemetry.select(*needed)
    df, tb = with_tiebreak(telemetry, tiebreak)
    seq = with_previous_time(df, "driverID", "Time", tb, bucket_seconds)
    hours = (F.col(TS) - F.col(PREV_TS)) / F.lit(3600.0)
    return seq.select(
        *[c for c in df.columns if c not in (TS,)],
        hours.alias("time_difference"),
        (F.col("Speed") * hours).alias("distance"),
    )


def driver_distance(telemetry: DataFrame, tiebreak: str = "event_id",
                    bucket_seconds: int = DAY) -> DataFrame:
    """Per driver: total distance in km (null for a single-record driver)."""
    df, tb = with_tiebreak(telemetry, tiebreak)
    steps = step_weighted_sum(df, "driverID", "Time", tb, "Speed", bucket_seconds)
    return steps.select("driverID", (F.col("value") / F.lit(3600.0)).alias("total_distance"))


def driver_summary(telemetry: DataFrame, tiebreak: str = "event_id", bucket_seconds: int = DAY) -> DataFrame:
    """A3: per driver, nine behaviour sums, mean speed and total distance.

    Sums over all-null flags are null, as ``sum`` in SQL.
    """
    # Input field of each total, in the measures' order.
    fields = {
        "total_rapid_accelerations": "isRapidlySpeedup",
        "total_rapid_decelerations": "isRapidlySlowdown",
        "total_neutral_slide": "isNeutralSlide",
        "total_neutral_slide_duration": "neutralSlideTime",
        "total_overspeed": "isOverspeed",
        "total_overspeed_duration": "overspeedTime",
        "total_fatigue_driving": "isFatigueDriving",
        "total_hthrottle_stop": "isHthrottleStop",
        "total_oil_leak": "isOilLeak",
    }
    df, tb = with_tiebreak(telemetry, tiebreak)
    totals = {name: F.sum(field) for name, field in fields.items()}
    totals |= {"_speed": F.sum("Speed"), "_speeds": F.count("Speed")}
    per = bucket_totals(df, "driverID", "Time", tb, "Speed", totals, bucket_seconds)
    return per.groupBy("driverID").agg(
        *[F.sum(name).alias(name) for name in fields],
        F.try_divide(F.sum("_speed").cast("double"), F.sum("_speeds")).alias("average_speed"),
        (F.sum("_steps") / F.lit(3600.0)).alias("total_distance"),
    ).select("driverID", *MEASURES)


def format_travel(travel: DataFrame) -> DataFrame:
    """Registered projection of W1/P7 output with a text timestamp."""
    return travel.select("driverID", "event_id", format_time("Time").alias("Time"), "Speed",
                         "time_difference", "distance")
