"""Structured Streaming forms of the live board.

The reference's "live" board replays stored records in 30-second slices. A
Spark user builds that as streaming queries over a file source:

* T1  tumbling 30 s windows per plate, watermarked, update mode;
* T2  the watermark: windows older than it are closed, so their state stays
      bounded; the records behind it go to a side table as they come;
* T3  overspeed alerts: T1 filtered to windows with an overspeed record,
      emitted as JSON lines;
* T4  slices counted from each date's earliest record, learned in the stream;
* T5  per-record distance: ``lag`` is not allowed on streams, so records wait in
      ``transformWithState`` until the watermark has passed and leave in order;
* T6  running per-plate behaviour totals (A1), update mode;
* T7  raw-file ingest: new CSV files are cleaned (P2) into a parquet table
      by the exactly-once file sink.

Update-mode results go through ``foreachBatch``: each micro-batch writes its
updated rows to ``<sink>/batch=<id>`` with overwrite, so a retried batch
replaces its own output (idempotent), and ``read_latest`` keeps the newest
version of each key. Event time is zone-less in the data; streaming needs a
zone-aware timestamp for ``withWatermark``, so it is converted at ingress as
UTC wall-clock and back at egress (independent of the session time zone).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetscope.session import ship_package
from fleetscope.functions.expr import epoch_seconds, format_time
from fleetscope.operators.behaviour import behaviour_by_plate
from fleetscope.sources.files import clean_cells, typed_records
from fleetscope.sources.records import read_records

EVENT_TIME = "event_time"
_EPOCH = "1970-01-01 00:00:00"


def with_event_time(stream: DataFrame) -> DataFrame:
    """Zone-aware event time from the zone-less ``Time`` (read as UTC wall clock)."""
    return stream.withColumn(EVENT_TIME, F.timestamp_seconds(epoch_seconds("Time")))


def _to_ntz(ts) -> F.Column:
    return F.timestamp_add("SECOND", F.unix_seconds(ts), F.lit(_EPOCH).cast(T.TimestampNTZType()))


def speed_windows(stream: DataFrame, seconds: int = 30, offset_seconds: int = 5,
                  delay: str = "1 minute") -> DataFrame:
    """T1 + T2: per plate and tumbling window, mean speed, record count and
    overspeed record count; state older than the watermark is dropped."""
    rows = with_event_time(stream).fillna({"isOverspeed": 0}).withWatermark(EVENT_TIME, delay)
    win = F.window(EVENT_TIME, f"{int(seconds)} seconds", startTime=f"{int(offset_seconds)} seconds")
    agg = rows.groupBy(win.alias("w"), "carPlateNumber").agg(
        F.avg("Speed").alias("avg_speed"),
        F.count(F.lit(1)).alias("n_records"),
        F.sum("isOverspeed").alias("overspeed_count"),
    )
    return agg.select(format_time(_to_ntz(F.col("w.start"))).alias("window_start"),
                      format_time(_to_ntz(F.col("w.end"))).alias("window_end"),
                      "carPlateNumber", "avg_speed", "n_records", "overspeed_count")


def overspeed_alerts(stream: DataFrame, seconds: int = 30, offset_seconds: int = 5,
                     delay: str = "1 minute") -> DataFrame:
    """Windows of a plate with at least one overspeed record (a window's
    count only grows, so the filter is stable under update mode)."""
    win = speed_windows(stream, seconds, offset_seconds, delay)
    return win.filter(F.col("overspeed_count") > 0).select(
        "window_start", "window_end", F.col("carPlateNumber").alias("car_plate_number"),
        "overspeed_count", "avg_speed")


def running_totals(stream: DataFrame) -> DataFrame:
    """A1 over a stream (state: one row per plate)."""
    return behaviour_by_plate(stream)


TRAVEL_SCHEMA = T.StructType([
    T.StructField("driverID", T.StringType(), True),
    T.StructField("event_id", T.LongType(), True),
    T.StructField("Time", T.StringType(), True),
    T.StructField("Speed", T.IntegerType(), True),
    T.StructField("time_difference", T.DoubleType(), True),
    T.StructField("distance", T.DoubleType(), True),
    T.StructField("late", T.BooleanType(), False),
])


#: Stands for the time of a record without one.
TIMELESS = -(1 << 63)


#: A bucket's records as they wait, and the last time of each of its drivers; state holds them packed.
_WAITING = pa.schema([("driverID", pa.string()), ("us", pa.int64()), ("event_id", pa.int64()), ("Time", pa.string()), ("Speed", pa.int32())])
_LAST = pa.schema([("driverID", pa.string()), ("second", pa.int64())])


def _packed(rows: pa.Table) -> tuple[bytes]:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(rows)
    return (out.getvalue().to_pybytes(),)


def _unpacked(value: tuple) -> pa.Table:
    return pa.ipc.open_stream(bytes(value[0])).read_all()


def _maybe(values: np.ndarray, missing: np.ndarray) -> pd.api.extensions.ExtensionArray:
    return pd.arrays.FloatingArray(np.where(missing, 0.0, values), missing)


class OrderedTravel(StatefulProcessor):
    """T5: the records of a bucket of drivers wait until the watermark has passed them, then leave, each driver's in the
    order of time.

    State per bucket: the records that wait (those of the last ``delay``, whatever came before), packed by arrival, the time
    of the last one of each driver that left, and one timer at the earliest that waits. A record behind the watermark leaves
    at once, flagged late and without a step; so does one without a time, not flagged. A call handles a bucket's records as
    columns: calls and their cost do not grow with the drivers."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.last = handle.getValueState("last", "rows binary")
        self.timer = handle.getValueState("timer", "ms long")

    def _frame(self, rows: pa.Table, hours: np.ndarray | None = None, late: bool = False) -> pd.DataFrame:
        """The rows as they leave; ``hours``: nan where there is no step."""
        hours = np.full(rows.num_rows, np.nan) if hours is None else hours
        speed = rows["Speed"].to_pandas(types_mapper={pa.int32(): pd.Int32Dtype()}.get)
        ids = rows["event_id"].to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        stepless, unknown = np.isnan(hours), speed.isna().to_numpy()
        return pd.DataFrame({
            "driverID": rows["driverID"].to_pandas(), "event_id": ids, "Time": rows["Time"].to_pandas(), "Speed": speed,
            "time_difference": _maybe(hours, stepless), "distance": _maybe(speed.fillna(0).to_numpy(np.float64) * hours, stepless | unknown), "late": late})

    def _steps(self, rows: pa.Table) -> pd.DataFrame:
        """The rows that leave, by driver and time, each with the hours since its driver's previous one."""
        drivers = rows["driverID"].combine_chunks().dictionary_encode("encode")
        code, names = drivers.indices.to_numpy(), drivers.dictionary.to_pylist()
        ids = rows["event_id"].combine_chunks()
        order = np.lexsort((ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), rows["us"].to_numpy(), code))
        code, second = code[order], rows["us"].to_numpy()[order] // 1_000_000
        last = dict(zip(*_unpacked(self.last.get()).to_pydict().values(), strict=True)) if self.last.exists() else {}
        first = np.ones(len(code), bool)
        first[1:] = code[1:] != code[:-1]
        seen = np.array([last.get(x) is not None for x in names])
        since = np.array([last.get(x) or 0 for x in names], np.int64)
        before = np.where(first, since[code], np.roll(second, 1))
        hours = np.where(first & ~seen[code], np.nan, (second - before) / 3600.0)
        ends = np.append(first[1:], True)
        last.update(zip((names[c] for c in code[ends]), second[ends].tolist(), strict=True))
        self.last.update(_packed(pa.table([list(last), list(last.values())], schema=_LAST)))
        return self._frame(rows.take(order), hours)

    def _watch(self, us: int) -> None:
        """One timer, at the earliest time that waits."""
        ms = -(-us // 1000)
        if self.timer.exists():
            if self.timer.get()[0] <= ms:
                return
            self.handle.deleteTimer(self.timer.get()[0])
        self.timer.update((ms,))
        self.handle.registerTimer(ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        behind, earliest = timerValues.getCurrentWatermarkInMs() * 1000, None
        for part in rows:
            us = part["us"].to_numpy()
            found = pa.table([pa.array(part["driverID"], pa.string(), from_pandas=True), us,
                              pa.array(part["event_id"], pa.string(), from_pandas=True).cast(pa.int64()),
                              pa.array(part["Time"], pa.string(), from_pandas=True),
                              pa.array(part["Speed"], from_pandas=True).cast(pa.int32())], schema=_WAITING)
            timed = us != TIMELESS
            wait, late = timed & (us > behind), timed & (us <= behind)
            if wait.any():
                self.waiting.appendValue(_packed(found.filter(pa.array(wait))))
                least = int(us[wait].min())
                earliest = least if earliest is None else min(earliest, least)
            if late.any():
                yield self._frame(found.filter(pa.array(late)), late=True)
            if not timed.all():
                yield self._frame(found.filter(pa.array(~timed)))
        if earliest is not None:
            self._watch(earliest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = pa.concat_tables([_WAITING.empty_table(), *map(_unpacked, self.waiting.get())])
        due = rows["us"].to_numpy() <= passed
        ready, rest = rows.filter(pa.array(due)), rows.filter(pa.array(~due))
        self.timer.clear()
        if rest.num_rows:
            self.waiting.put([_packed(rest)])
            self._watch(int(rest["us"].to_numpy().min()))
        else:
            self.waiting.clear()
        if ready.num_rows:
            yield self._steps(ready)

    def close(self) -> None:
        pass


def _with_watermark(stream: DataFrame, delay: str) -> DataFrame:
    """Rows with ``us`` (microseconds), the watermark tracked but not applied: the event-time column itself is left out, so
    no operator behind drops anything. Heartbeats (a ``Time`` and nothing else) move the watermark and end here; the
    condition names the event time so that it is not applied before the watermark sees them."""
    rows = with_event_time(stream).withWatermark(EVENT_TIME, delay)
    real = (F.col("event_id").isNotNull() | F.col("driverID").isNotNull() | F.col(EVENT_TIME).isNull())
    return rows.filter(real).withColumn("us", F.coalesce(F.unix_micros(EVENT_TIME), F.lit(TIMELESS))).drop(EVENT_TIME)


def record_distance(stream: DataFrame, delay: str = "1 minute", buckets: int = 512) -> DataFrame:
    """T5: per record, hours since the driver's previous record and distance, in the order of event time whatever the
    order of arrival within ``delay``. State is what waits for the watermark, not a driver's history; drivers share it in
    ``buckets`` by a hash of their name.

    Needs ``run_append_sink(..., ordered=True)``; a heartbeat lets the last records out (``heartbeat``)."""
    ship_package(stream.sparkSession)
    # ids as text: whole numbers with nulls among them would reach Python as floating point
    rows = _with_watermark(stream, delay).select("driverID", F.col("event_id").cast("string").alias("event_id"), format_time("Time").alias("Time"), "Speed", "us",
                                                 F.pmod(F.xxhash64("driverID"), F.lit(buckets)).alias("bucket"))
    return rows.groupBy("bucket").transformWithStateInPandas(OrderedTravel(), TRAVEL_SCHEMA, "Append", "EventTime")


class LateRows(StatefulProcessor):
    """Passes on the rows behind the watermark; holds nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        behind = timerValues.getCurrentWatermarkInMs() * 1000
        for part in rows:
            late = part[(part["us"] <= behind) & (part["us"] != TIMELESS)]
            yield late[["driverID", "event_id", "carPlateNumber", "Time"]].assign(event_id=late["event_id"].astype("Int64"))

    def close(self) -> None:
        pass


LATE_SCHEMA = "driverID string, event_id long, carPlateNumber string, Time string"


def late_rows(stream: DataFrame, delay: str = "1 minute", salts: int = 64) -> DataFrame:
    """The rows that arrive behind the watermark, as they come (``run_append_sink(..., ordered=True)``). They are dealt
    by a hash of their event, so no plate or driver is hot. (Spark's own windows drop by the watermark of one batch before:
    they may still take rows of the first batch that is behind.)"""
    ship_package(stream.sparkSession)
    rows = _with_watermark(stream, delay).select("driverID", F.col("event_id").cast("string").alias("event_id"), "carPlateNumber", format_time("Time").alias("Time"), "us",
                                                 F.pmod(F.xxhash64("event_id", "Time"), F.lit(salts)).alias("salt"))
    return rows.groupBy("salt").transformWithStateInPandas(LateRows(), LATE_SCHEMA, "Append", "EventTime")


def heartbeat(spark: SparkSession, path: str, schema: T.StructType, time: str) -> None:
    """A row with nothing but ``Time`` in the source folder of T5 or T2: moves the watermark without being a record there."""
    row = spark.range(1).select(*[F.lit(time).cast(f.dataType).alias(f.name) if f.name == "Time" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    row.write.mode("append").parquet(path)


def replay_seconds(stream: DataFrame) -> DataFrame:
    """T4: sums per date, plate and second. Slices counted from whatever anchor are sums of whole seconds, so nothing has to
    be taken back when a date's earliest record arrives late."""
    rows = stream.filter(F.col("Time").isNotNull()).fillna({"isOverspeed": 0})
    return rows.groupBy(F.to_date("Time").alias("date"), "carPlateNumber", epoch_seconds("Time").alias("second")).agg(
        F.sum("Speed").alias("speed"), F.count("Speed").alias("n_speed"), F.count(F.lit(1)).alias("n_records"), F.sum("isOverspeed").alias("overspeed"))


def replay_anchors(stream: DataFrame) -> DataFrame:
    """T4: the earliest record of each date so far, learned from the stream."""
    return stream.filter(F.col("Time").isNotNull()).groupBy(F.to_date("Time").alias("date")).agg(F.min(epoch_seconds("Time")).alias("anchor"))


def slices_of_seconds(seconds: DataFrame, anchors: DataFrame, length: int = 30) -> DataFrame:
    """T4: every date's slices from its anchor as known now; a date whose anchor has moved is keyed anew."""
    placed = seconds.join(anchors, "date").withColumn("slice_no", F.floor((F.col("second") - F.col("anchor")) / F.lit(length)).cast("long"))
    start = F.timestamp_add("SECOND", F.col("anchor") + F.col("slice_no") * length, F.lit(_EPOCH).cast(T.TimestampNTZType()))
    return placed.groupBy("date", "anchor", "slice_no", "carPlateNumber").agg(
        (F.sum("speed") / F.nullif(F.sum("n_speed"), F.lit(0))).alias("avg_speed"), F.sum("n_records").alias("n_records"),
        F.sum("overspeed").cast("long").alias("overspeed_count")).select(
        F.date_format("date", "yyyy-MM-dd").alias("date"), "slice_no", format_time(start).alias("slice_start"), "carPlateNumber",
        "avg_speed", "n_records", "overspeed_count")


# --------------------------------------------------------------------------- sinks


def run_update_sink(stream: DataFrame, sink: str, checkpoint: str,
                    available_now: bool = True, processing_time: str | None = None,
                    fmt: str = "parquet"):
    """Run an update-mode query into ``sink`` through idempotent per-batch
    writes. ``available_now`` drains what exists and stops (replay);
    ``processing_time`` (e.g. "30 seconds") keeps a live query running.
    ``fmt="json"`` writes each updated row as one JSON object (S7)."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = f"{sink}/batch={batch_id}"
        if fmt == "json":
            alerts_to_json(batch).write.mode("overwrite").text(out)
        else:
            batch.write.mode("overwrite").parquet(out)

    writer = (stream.writeStream.outputMode("update").foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(processingTime=processing_time) if processing_time \
        else writer.trigger(availableNow=available_now)
    query = writer.start()
    if not processing_time:
        query.awaitTermination()
    return query


def read_latest(spark: SparkSession, sink: str, keys: list[str],
                json_schema: T.StructType | None = None) -> DataFrame:
    """Newest version of each key across the per-batch outputs (parquet, or
    JSON lines parsed with ``json_schema``)."""
    if json_schema is not None:
        df = spark.read.schema(T.StructType(json_schema.fields + [
            T.StructField("batch", T.LongType(), True)])).json(sink)
    else:
        df = spark.read.parquet(sink)
    values = [c for c in df.columns if c not in keys and c != "batch"]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch")).alias("v"))
    return latest.select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


#: State with lists and timers is kept in RocksDB.
_PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_append_sink(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                    available_now: bool = True, processing_time: str | None = None, ordered: bool = False):
    """Run an append-mode query into a file sink (exactly-once via its log); ``ordered`` for queries whose
    state has lists and timers."""
    writer = (stream.writeStream.outputMode("append").format(fmt)
              .option("path", sink).option("checkpointLocation", checkpoint))
    writer = writer.trigger(processingTime=processing_time) if processing_time \
        else writer.trigger(availableNow=available_now)
    conf, old = stream.sparkSession.conf, stream.sparkSession.conf.get(_PROVIDER[0])
    if ordered:
        conf.set(*_PROVIDER)
    try:
        query = writer.start()  # the query takes its settings here
    finally:
        conf.set(_PROVIDER[0], old)
    if not processing_time:
        query.awaitTermination()
    return query


def alerts_to_json(alerts: DataFrame) -> DataFrame:
    """S7 for streams: one JSON object per alert row."""
    return alerts.select(F.to_json(F.struct(*alerts.columns)).alias("value"))


# --------------------------------------------------------------------------- sources


def telemetry_stream(spark: SparkSession, path: str, schema: T.StructType,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet file stream of telemetry (new files are picked up as they land)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(path)


def raw_files_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """T7 source: ``(path)`` of the raw files as they arrive; their contents are not read here."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path).select("path")


CELLS_SCHEMA = "file string, block long, record long, cells array<string>"


def stage_raw(spark: SparkSession, raw_dir: str, staged: str, checkpoint: str, max_files_per_trigger: int | None = None) -> None:
    """First half of T7: the cleaned cells of every new raw file in ``staged/batch=<id>``, read in splits like any
    raw folder (S1). A batch that is run again replaces its own cells."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # the names of one trigger's files; the source holds them on the driver as well
        paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", r["path"]) for r in batch.collect()]
        if paths:
            clean_cells(read_records(spark, paths)).write.mode("overwrite").parquet(f"{staged}/batch={batch_id}")

    (raw_files_stream(spark, raw_dir, max_files_per_trigger).writeStream.foreachBatch(write)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def ingest_raw(spark: SparkSession, raw_dir: str, table: str, checkpoint: str,
               max_files_per_trigger: int | None = None):
    """Clean new raw files (P2) into a typed parquet table; restart-safe. The
    cells that do not parse are null there; ``files.rejected_cells`` lists them.

    Two streams, one after the other: raw files to staged cells (``checkpoint/cells``), and
    staged cells to the table through the exactly-once file sink. The second starts when
    the batches of the first are complete."""
    staged = f"{checkpoint.rstrip('/')}/cells"
    stage_raw(spark, raw_dir, staged, f"{checkpoint.rstrip('/')}/raw", max_files_per_trigger)
    spark.createDataFrame([], CELLS_SCHEMA).write.mode("append").parquet(f"{staged}/batch=-1")
    cells = spark.readStream.schema(CELLS_SCHEMA).parquet(f"{staged}/batch=*")
    return run_append_sink(typed_records(cells), table, f"{checkpoint.rstrip('/')}/table")
