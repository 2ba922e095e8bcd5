"""Time slices of the live speed board, in batch form.

F1 (half-open range), A2 (per-plate slice aggregate), P5/P6/P8/P9/P14
(record shape), A8/A13 (client mean and count), A9/F5/L3 (warning counter),
F4 (warnings), A4/F2/F6/F7/F8 (earliest record of a date), T1 (fixed-anchor
tumbling windows) and T4 (per-date replay slices).

Every aggregate here is a hash aggregate with partial aggregation; record
lists are never gathered per plate for the registered forms (the flattened
records are just the filtered rows). The nested form (``with_records``) keeps
a plate's records of one slice in one row, which the slice length bounds.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.functions.expr import format_time, parse_time_literal, same_day, seconds_between
from fleetscope.operators.joins import join_lookup
from fleetscope.schema import DEFAULT_START, SLICE_SECONDS, WARNING_FORMAT


def resolve_start(start: str | datetime | None, default: str = DEFAULT_START):
    """an empty or missing start time falls back to the default start."""
    return parse_time_literal(start if start else default)


def time_range(telemetry: DataFrame, start: str | datetime | None,
               seconds: int = SLICE_SECONDS) -> DataFrame:
    """rows with ``start <= Time < start + seconds`` (P11 for the end).

    Both bounds are literals after constant folding, so on a telemetry table
    stored as parquet the range reaches the scan as pushed filters.
    """
    lo = resolve_start(start)
    hi = F.timestamp_add("SECOND", F.lit(int(seconds)), lo)
    return _prune_dates(telemetry.filter((F.col("Time") >= lo) & (F.col("Time") < hi)), lo, hi)


def _prune_dates(df: DataFrame, lo, hi) -> DataFrame:
    """On a table partitioned by ``event_date`` (= to_date(Time)), restate a
    ``[lo, hi)`` time range on the partition column so whole folders are
    skipped; Catalyst cannot derive it from the ``Time`` predicate."""
    if "event_date" not in df.columns:
        return df
    d = F.col("event_date")
    last = F.to_date(F.timestamp_add("MICROSECOND", F.lit(-1), hi))  # ``hi`` is exclusive
    return df.filter((d >= F.to_date(lo)) & (d <= last))


def fill_overspeed(telemetry: DataFrame) -> DataFrame:
    """P5: blank ``isOverspeed`` is 0 (the schema is fixed, so it never skips)."""
    return telemetry.fillna({"isOverspeed": 0})


def speed_slice(telemetry: DataFrame, start: str | datetime | None = None,
                seconds: int = SLICE_SECONDS) -> DataFrame:
    """A2 scalars: per plate in the slice, mean speed, overspeed record count
    (isOverspeed; not finished episodes), and the number of records."""
    rows = fill_overspeed(time_range(telemetry, start, seconds))
    return rows.groupBy("carPlateNumber").agg(
        F.avg("Speed").alias("avg_speed"),
        F.sum("isOverspeed").alias("overspeed_count"),
        F.count(F.lit(1)).alias("n_records"),
    )


def with_records(telemetry: DataFrame, start: str | datetime | None = None,
                 seconds: int = SLICE_SECONDS, tiebreak: str = "event_id") -> DataFrame:
    """A2 with P8: the nested form, records as ``array<struct<Time, Speed float,
    isOverspeed>>`` ordered by time (a tie-breaker keeps equal times stable)."""
    rows = fill_overspeed(time_range(telemetry, start, seconds))
    tb = F.col(tiebreak) if tiebreak in rows.columns else F.lit(0)
    rec = F.struct(F.col("Time"), tb.alias("_tb"), F.col("Speed").cast("float").alias("Speed"),
                   F.col("isOverspeed"))
    agg = rows.groupBy("carPlateNumber").agg(
        F.sort_array(F.collect_list(rec)).alias("_records"),
        F.avg("Speed").alias("avg_speed"),
        F.sum("isOverspeed").alias("overspeed_count"),
    )
    records = F.transform("_records", lambda x: F.struct(
        x["Time"].alias("Time"), x["Speed"].alias("Speed"), x["isOverspeed"].alias("isOverspeed")))
    return agg.select("carPlateNumber", records.alias("records"), "avg_speed", "overspeed_count")


def flatten_records(nested: DataFrame) -> DataFrame:
    """P9 on the nested form: one row per record, plate copied onto each."""
    return nested.select(F.col("carPlateNumber").alias("car_plate_number"),
                         F.inline("records"))


def slice_records(telemetry: DataFrame, start: str | datetime | None = None,
                  seconds: int = SLICE_SECONDS) -> DataFrame:
    """P9/P6/P10/P14 directly: the slice's records as emitted to the board
    (text time, float speed, overspeed flag, snake_case plate)."""
    rows = fill_overspeed(time_range(telemetry, start, seconds))
    return rows.select(format_time("Time").alias("Time"),
                       F.col("Speed").cast("float").alias("Speed"),
                       F.col("isOverspeed"),
                       F.col("carPlateNumber").alias("car_plate_number"))


#: Names of the flat records in the board's live message.
LIVE_RECORD = "Time string, Speed float, isOverspeed int, car_plate_number string"
LIVE_WARNING = "car_plate_number string, overspeed_count long"


def live_records(telemetry: DataFrame, start: str | datetime | None = None, seconds: int = SLICE_SECONDS) -> DataFrame:
    """S7 + P9: the slice's records as the live message has them, one JSON object each with the plate on it."""
    return slice_records(telemetry, start, seconds).select(F.to_json(F.struct("Time", "Speed", "isOverspeed", "car_plate_number")).alias("value"))


def live_warnings(telemetry: DataFrame, start: str | datetime | None = None, seconds: int = SLICE_SECONDS) -> DataFrame:
    """S7 + F4: the warnings message of the slice, one JSON object per plate."""
    warned = overspeed_warnings(speed_slice(telemetry, start, seconds))
    return warned.select(F.to_json(F.struct("car_plate_number", "overspeed_count")).alias("value"))


def day_steps(telemetry: DataFrame) -> DataFrame:
    """F8: per driver, steps from one record to the next that stay in a calendar day, and those that do not."""
    from fleetscope.operators.sequence import PREV_TS, with_previous_time

    seq = with_previous_time(telemetry.select("driverID", "event_id", "Time"), "driverID", "Time", "event_id").filter(F.col(PREV_TS).isNotNull())
    before = F.timestamp_add("SECOND", F.col(PREV_TS), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    stays = same_day(before, F.col("Time"))
    return seq.groupBy("driverID").agg(F.count_if(stays).alias("same_day"), F.count_if(~stays).alias("other_day"))


def plate_speed(records: DataFrame) -> DataFrame:
    """A8 + A13: mean speed and number of points per plate of emitted records."""
    return records.groupBy("car_plate_number").agg(
        (F.sum("Speed") / F.count(F.lit(1))).alias("speed"),
        F.count(F.lit(1)).alias("count"),
    )


def overspeed_warnings(slice_agg: DataFrame) -> DataFrame:
    """F4 + P14: plates whose slice has at least one overspeed record."""
    return slice_agg.filter(F.col("overspeed_count") > 0).select(
        F.col("carPlateNumber").alias("car_plate_number"), "overspeed_count")


def warning_counter(telemetry: DataFrame, start: str | datetime | None = None,
                    seconds: int = SLICE_SECONDS, tiebreak: str = "event_id") -> DataFrame:
    """A9 + F5 + L3: per plate, the number of overspeed records in the slice
    and the speed of the first one (earliest time, then tie-breaker), with
    the board's warning text."""
    rows = fill_overspeed(time_range(telemetry, start, seconds)).filter(F.col("isOverspeed") == 1)
    order = F.struct(F.col("Time"), F.col(tiebreak)) if tiebreak in rows.columns else F.col("Time")
    agg = rows.groupBy("carPlateNumber").agg(
        F.count(F.lit(1)).alias("overspeed_count"),
        F.min_by(F.col("Speed"), order).alias("speed"),
    )
    whole = F.col("speed") == F.floor("speed")
    shown = F.when(whole, F.col("speed").cast("bigint").cast("string")).otherwise(F.col("speed").cast("string"))
    msg = F.format_string(WARNING_FORMAT, F.col("carPlateNumber"), F.col("overspeed_count"), shown)
    return agg.select(F.col("carPlateNumber").alias("car_plate_number"), "overspeed_count",
                      F.col("speed").cast("float").alias("speed"), msg.alias("message"))


_WHOLE_PREFIX = re.compile(r"(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?")


def _prefix_range(prefix: str) -> tuple[datetime, datetime] | None:
    """The time range a whole ``yyyy``, ``yyyy-MM`` or ``yyyy-MM-dd`` prefix selects;
    None for any other text, an impossible date, or one without a next bound."""
    m = _WHOLE_PREFIX.fullmatch(prefix)
    if not m:
        return None
    year, month, day = (None if g is None else int(g) for g in m.groups())
    try:
        lo = datetime(year, month or 1, day or 1)
        if day:
            return lo, lo + timedelta(days=1)
        if month:
            return lo, datetime(year + month // 12, month % 12 + 1, 1)
        return lo, datetime(year + 1, 1, 1)
    except (ValueError, OverflowError):
        return None


def date_filter(telemetry: DataFrame, date_text: str | None) -> DataFrame:
    """rows whose time text starts with ``date_text``.

    A whole day, month or year prefix becomes the pushable range
    ``[start, next)`` (restated on ``event_date`` for partition pruning); any
    other prefix is a text prefix test. An empty or missing date selects
    nothing (F6).
    """
    if not date_text:
        return telemetry.filter(F.lit(False))
    rng = _prefix_range(date_text)
    if rng is None:
        # Time's own text (fractional seconds included when present).
        return telemetry.filter(F.col("Time").cast("string").startswith(date_text))
    lo, hi = parse_time_literal(rng[0]), parse_time_literal(rng[1])
    return _prune_dates(telemetry.filter((F.col("Time") >= lo) & (F.col("Time") < hi)), lo, hi)


def earliest_of_date(telemetry: DataFrame, date_text: str | None) -> DataFrame:
    """A4 + F6: the earliest record time of a date, as text.

    A date without rows gives one row holding null; an empty date parameter
    gives no row.
    """
    rows = date_filter(telemetry, date_text)
    out = rows.agg(F.min("Time").alias("earliest"))
    out = out.select(format_time("earliest").alias("timestamp"))
    return out if date_text else out.filter(F.lit(False))


def speed_by_window(telemetry: DataFrame, seconds: int = SLICE_SECONDS,
                    offset_seconds: int = 5) -> DataFrame:
    """T1 batch form: tumbling windows ``[origin + k*seconds, ...)`` per plate,
    with a fixed anchor (the default start's seconds offset)."""
    rows = fill_overspeed(telemetry)
    win = F.window("Time", f"{int(seconds)} seconds", startTime=f"{int(offset_seconds)} seconds")
    agg = rows.groupBy(win.alias("w"), "carPlateNumber").agg(
        F.avg("Speed").alias("avg_speed"),
        F.count(F.lit(1)).alias("n_records"),
        F.sum("isOverspeed").alias("overspeed_count"),
    )
    return agg.select(format_time(F.col("w.start")).alias("window_start"),
                      format_time(F.col("w.end")).alias("window_end"),
                      "carPlateNumber", "avg_speed", "n_records", "overspeed_count")


def date_anchors(telemetry: DataFrame) -> DataFrame:
    """Earliest record time per calendar date (one row per date)."""
    return telemetry.groupBy(F.to_date("Time").alias("date")).agg(F.min("Time").alias("anchor"))


def replay_slices(telemetry: DataFrame, seconds: int = SLICE_SECONDS,
                  anchors: DataFrame | None = None) -> DataFrame:
    """T4 batch form: every slice of every date at once.

    Each date is anchored at its own earliest record and cut into
    ``seconds``-long slices: ``slice_no = floor((Time - anchor) / seconds)``.
    The anchors (one row per date) are materialised, so Spark picks the join by
    their size.
    """
    from fleetscope.sources.sinks import materialize

    if anchors is None:
        anchors = materialize(date_anchors(telemetry), "date-anchors")
    rows = fill_overspeed(telemetry).withColumn("date", F.to_date("Time"))
    joined = join_lookup(rows, anchors, on="date")
    joined = joined.filter(same_day(F.col("anchor"), F.col("Time")))
    slice_no = F.floor(seconds_between("anchor", "Time") / F.lit(int(seconds)))
    agg = joined.groupBy("date", "anchor", slice_no.alias("slice_no"), "carPlateNumber").agg(
        F.avg("Speed").alias("avg_speed"),
        F.count(F.lit(1)).alias("n_records"),
        F.sum("isOverspeed").alias("overspeed_count"),
    )
    start = F.timestamp_add("SECOND", (F.col("slice_no") * int(seconds)).cast("int"), F.col("anchor"))
    return agg.select(F.date_format("date", "yyyy-MM-dd").alias("date"),
                      F.col("slice_no").cast(T.LongType()).alias("slice_no"),
                      format_time(start).alias("slice_start"),
                      "carPlateNumber", "avg_speed", "n_records", "overspeed_count")


def overspeed_alerts(telemetry: DataFrame, seconds: int = SLICE_SECONDS,
                     offset_seconds: int = 5) -> DataFrame:
    """T3 batch form: per fixed window and plate, the warnings (F4) of the
    window: plates with at least one overspeed record."""
    win = speed_by_window(telemetry, seconds, offset_seconds)
    return win.filter(F.col("overspeed_count") > 0).select(
        "window_start", "window_end", F.col("carPlateNumber").alias("car_plate_number"),
        "overspeed_count", "avg_speed")


def chart_payload(telemetry: DataFrame, start: str | datetime | None = None,
                  seconds: int = SLICE_SECONDS, tiebreak: str = "event_id") -> DataFrame:
    """S7 + P8 + P14: the board's per-plate chart message as one JSON object
    per plate: ``car_plate_number``, ``avg_speed``, ``overspeed_count`` and
    ``records`` of ``{Time text, speed, isOverspeed}`` in time order."""
    nested = with_records(telemetry, start, seconds, tiebreak)
    records = F.transform("records", lambda r: F.struct(
        format_time(r["Time"]).alias("Time"), r["Speed"].alias("speed"),
        r["isOverspeed"].alias("isOverspeed")))
    return nested.select(F.to_json(F.struct(
        F.col("carPlateNumber").alias("car_plate_number"), F.col("avg_speed"),
        F.col("overspeed_count"), records.alias("records"))).alias("value"))


CHART_SCHEMA = T.StructType([
    T.StructField("car_plate_number", T.StringType()),
    T.StructField("avg_speed", T.DoubleType()),
    T.StructField("overspeed_count", T.LongType()),
    T.StructField("records", T.ArrayType(T.StructType([
        T.StructField("Time", T.StringType()),
        T.StructField("speed", T.FloatType()),
        T.StructField("isOverspeed", T.IntegerType())]))),
])
