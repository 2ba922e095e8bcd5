"""Stream forms against batch forms; watermark drops; restart safety."""

import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fleetscope.operators import behaviour as B
from fleetscope.operators import slices as S
from fleetscope.operators import trips as TR
from fleetscope.schema import FIELD_NAMES
from fleetscope.sources import files as FL
from fleetscope.sources.telemetry import load_telemetry
from fleetscope.streaming import board as SB
from tests.conftest import SF_SMALL
from tests.helpers import canon


def _dates_in_order(spark, tel, path, reverse=False):
    """Replay source: one append per date, in time order (or reversed)."""
    dates = sorted(r[0] for r in tel.select(F.to_date("Time")).distinct().collect())
    for d in (reversed(dates) if reverse else dates):
        tel.filter(F.to_date("Time") == F.lit(d)).coalesce(1).write.mode("append").parquet(path)
    return len(dates)


def test_multi_batch_windows_equal_batch(spark, tmp_dir):
    tel = load_telemetry(spark, SF_SMALL)
    src = f"{tmp_dir}/src"
    _dates_in_order(spark, tel, src)
    stream = SB.telemetry_stream(spark, src, tel.schema, max_files_per_trigger=1)
    SB.run_update_sink(SB.speed_windows(stream), f"{tmp_dir}/sink", f"{tmp_dir}/ckpt")
    got = SB.read_latest(spark, f"{tmp_dir}/sink", ["window_start", "window_end", "carPlateNumber"])
    assert canon(got.toPandas()) == canon(S.speed_by_window(tel).toPandas())
    batches = {int(n.split("=")[1]) for n in os.listdir(f"{tmp_dir}/sink") if n.startswith("batch=")}
    assert len(batches) >= 10


def test_multi_batch_distance_and_totals_equal_batch(spark, tmp_dir):
    tel = load_telemetry(spark, SF_SMALL)
    src = f"{tmp_dir}/src"
    _dates_in_order(spark, tel, src)
    stream = SB.telemetry_stream(spark, src, tel.schema, max_files_per_trigger=3)
    SB.run_update_sink(SB.running_totals(stream), f"{tmp_dir}/tot", f"{tmp_dir}/c2")
    tot = SB.read_latest(spark, f"{tmp_dir}/tot", ["carPlateNumber"])
    assert canon(tot.toPandas()) == canon(B.behaviour_by_plate(tel).toPandas())
    SB.heartbeat(spark, src, tel.schema, "2100-01-01 00:00:00")
    stream = SB.telemetry_stream(spark, src, tel.schema, max_files_per_trigger=2)
    SB.run_append_sink(SB.record_distance(stream), f"{tmp_dir}/dist", f"{tmp_dir}/c1", ordered=True)
    got = spark.read.parquet(f"{tmp_dir}/dist")
    assert got.filter("late").count() == 0
    want = TR.format_travel(TR.record_travel(tel))
    assert canon(got.drop("late").toPandas()) == canon(want.toPandas())


def test_late_rows_are_dropped_and_counted(spark, tmp_dir):
    tel = load_telemetry(spark, SF_SMALL)
    src = f"{tmp_dir}/src"
    n_dates = _dates_in_order(spark, tel, src, reverse=True)
    stream = SB.telemetry_stream(spark, src, tel.schema, max_files_per_trigger=1)
    q = SB.run_update_sink(SB.speed_windows(stream, delay="1 minute"), f"{tmp_dir}/sink",
                           f"{tmp_dir}/ckpt")
    got = SB.read_latest(spark, f"{tmp_dir}/sink", ["window_start", "window_end", "carPlateNumber"])
    kept = got.agg(F.sum("n_records")).first()[0]
    stream = SB.telemetry_stream(spark, src, tel.schema, max_files_per_trigger=1)
    SB.run_append_sink(SB.late_rows(stream), f"{tmp_dir}/late", f"{tmp_dir}/c1", ordered=True)
    late = spark.read.parquet(f"{tmp_dir}/late")
    dropped = late.count()
    # Newest date first: every older date arrives behind the watermark. The windows drop by the watermark
    # of one batch before, so they still take the second batch.
    newest = tel.agg(F.max(F.to_date("Time"))).first()[0]
    older = tel.filter(F.to_date("Time") < F.lit(newest))
    assert n_dates > 1 and sorted(late.select("event_id").collect()) == sorted(older.select("event_id").collect())
    assert tel.count() - dropped <= kept < tel.count()
    # Late records in the stateful distance stream are flagged, not stepped.
    stream = SB.telemetry_stream(spark, src, tel.schema, max_files_per_trigger=1)
    SB.run_append_sink(SB.record_distance(stream), f"{tmp_dir}/dist", f"{tmp_dir}/c2", ordered=True)
    dist = spark.read.parquet(f"{tmp_dir}/dist")
    assert sorted(r[0] for r in dist.filter("late").select("event_id").collect()) == sorted(r[0] for r in late.select("event_id").collect())
    assert dist.filter("late").count() > 0
    assert dist.filter("late AND distance IS NOT NULL").count() == 0


def test_ingest_restart_writes_no_row_twice(spark, tmp_dir):
    tel = load_telemetry(spark, SF_SMALL, clean=False)
    raw = f"{tmp_dir}/raw"
    half = tel.filter(F.col("event_id") < 500)
    FL.write_raw_csv(half, raw + "/a")
    table, ckpt = f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    SB.ingest_raw(spark, f"{raw}/*", table, ckpt)
    first = spark.read.parquet(table).count()
    # Restart with nothing new: no duplicates.
    SB.ingest_raw(spark, f"{raw}/*", table, ckpt)
    assert spark.read.parquet(table).count() == first == half.count()
    # New files arrive: only they are added.
    FL.write_raw_csv(tel.filter(F.col("event_id") >= 500), raw + "/b")
    SB.ingest_raw(spark, f"{raw}/*", table, ckpt)
    out = spark.read.parquet(table)
    assert out.count() == tel.count()
    assert out.filter(F.col("carPlateNumber").rlike("[^a-zA-Z0-9]")).count() == 0
    assert out.columns == FIELD_NAMES


def test_shuffled_arrival_leaves_in_order_and_state_holds_the_delay_only(spark, tmp_dir):
    """Arrival jumbled within an hour, two files a trigger: equal to the batch form, in order, out batch by batch."""
    rows = [(f"d{i % 3}", i, datetime(2017, 1, 1) + timedelta(seconds=97 * i), 10 + i % 50) for i in range(1200)]
    rows += [("d0", 5000 + i, rows[600][2], 7) for i in range(5)]  # ties
    tel = spark.createDataFrame(rows, "driverID string, event_id long, Time timestamp_ntz, Speed int")
    src, sink, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    rng = random.Random(3)
    arrival = sorted(rows, key=lambda r: r[2] + timedelta(seconds=rng.randint(0, 3600)))
    for k in range(0, len(arrival), 150):
        spark.createDataFrame(arrival[k:k + 150], tel.schema).coalesce(1).write.mode("append").parquet(src)
    waiting = []
    query = SB.run_append_sink(SB.record_distance(SB.telemetry_stream(spark, src, tel.schema, 2), "1 hour"), sink, ckpt, ordered=True)
    for p in query.recentProgress:
        waiting += [s.numRowsTotal for s in p.stateOperators]
    early = spark.read.schema(SB.TRAVEL_SCHEMA).parquet(sink).count()
    assert len(rows) * 0.8 < early < len(rows)
    SB.heartbeat(spark, src, tel.schema, "2100-01-01 00:00:00")
    SB.run_append_sink(SB.record_distance(SB.telemetry_stream(spark, src, tel.schema, 2), "1 hour"), sink, ckpt, ordered=True)
    got = spark.read.schema(SB.TRAVEL_SCHEMA).parquet(sink)
    assert got.filter("late").count() == 0
    want = TR.format_travel(TR.record_travel(tel, keep=["driverID", "event_id", "Time", "Speed"]))
    assert canon(got.drop("late").toPandas()) == canon(want.toPandas())


def test_null_times_ids_and_drivers_in_the_ordered_state(spark, tmp_dir):
    t = datetime(2017, 1, 1, 8)
    rows = [(None, 1, t, 5), (None, 2, t + timedelta(hours=1), 7), ("a", None, t, 3), ("a", 9007199254740993, None, 4), ("a", 4, t + timedelta(hours=2), None)]
    tel = spark.createDataFrame(rows, "driverID string, event_id long, Time timestamp_ntz, Speed int")
    src = f"{tmp_dir}/src"
    tel.coalesce(1).write.parquet(src)
    SB.heartbeat(spark, src, tel.schema, "2100-01-01 00:00:00")
    SB.run_append_sink(SB.record_distance(SB.telemetry_stream(spark, src, tel.schema, 1)), f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", ordered=True)
    got = {(r.driverID, r.event_id): (r.time_difference, r.distance, r.late) for r in spark.read.schema(SB.TRAVEL_SCHEMA).parquet(f"{tmp_dir}/sink").collect()}
    assert got == {(None, 1): (None, None, False), (None, 2): (1.0, 7.0, False), ("a", None): (None, None, False),
                   ("a", 9007199254740993): (None, None, False), ("a", 4): (2.0, None, False)}


def test_many_drivers_share_the_ordered_state(spark, tmp_dir):
    """State and calls are counted by buckets: 600 drivers in 4 buckets hold no more than arrivals and two values each."""
    rows = [(f"d{i % 600}", i, datetime(2017, 1, 1) + timedelta(seconds=7 * (i * 7919 % 1800)), None if i % 50 == 0 else i % 90) for i in range(1800)]
    tel = spark.createDataFrame(rows, "driverID string, event_id long, Time timestamp_ntz, Speed int")
    src = f"{tmp_dir}/src"
    for k in range(3):
        spark.createDataFrame(rows[k * 600:(k + 1) * 600], tel.schema).coalesce(1).write.mode("append").parquet(src)
    SB.heartbeat(spark, src, tel.schema, "2100-01-01 00:00:00")
    query = SB.run_append_sink(SB.record_distance(SB.telemetry_stream(spark, src, tel.schema, 1), "1 day", buckets=4),
                               f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", ordered=True)
    assert max(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators) <= 4 * 8
    got = spark.read.schema(SB.TRAVEL_SCHEMA).parquet(f"{tmp_dir}/sink")
    want = TR.format_travel(TR.record_travel(tel, keep=["driverID", "event_id", "Time", "Speed"]))
    assert got.filter("late").count() == 0 and canon(got.drop("late").toPandas()) == canon(want.toPandas())


def test_slices_follow_an_anchor_that_moves(spark, tmp_dir):
    """The date's earliest record arrives last; its slices are keyed anew."""
    tel = load_telemetry(spark, SF_SMALL)
    src = f"{tmp_dir}/src"
    first = tel.filter(F.hour("Time") >= 9)
    held = {}
    for part in (first, tel.subtract(first)):
        part.coalesce(2).write.mode("append").parquet(src)
        for name, build, keys in (("seconds", SB.replay_seconds, ["date", "carPlateNumber", "second"]), ("anchors", SB.replay_anchors, ["date"])):
            SB.run_update_sink(build(SB.telemetry_stream(spark, src, tel.schema)), f"{tmp_dir}/{name}", f"{tmp_dir}/c-{name}")
            held[name] = SB.read_latest(spark, f"{tmp_dir}/{name}", keys)
        so_far = spark.read.schema(tel.schema).parquet(src)
        got = SB.slices_of_seconds(held["seconds"], held["anchors"], 30)
        assert canon(got.toPandas()) == canon(S.replay_slices(so_far, 30).toPandas())
