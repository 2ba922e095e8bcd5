"""Edge fixtures: plates, blanks, ragged rows, quoting, ties, single records,
range edges, empty dates, constant columns, search terms, matrix text."""

import os

from fleetscope.functions.expr import clean_plate
from fleetscope.operators import behaviour as B
from fleetscope.operators import slices as S
from fleetscope.operators import stats as ST
from fleetscope.operators import trips as TR
from fleetscope.sources import files as FL
from tests.fixtures import frame, record
from tests.helpers import rows


def test_plate_cleaning_collapses_and_keeps_null(spark):
    df = spark.createDataFrame([("华AZ-1234",), ("AZ 1234",), ("---",), (None,)], "p string")
    got = [r[0] for r in df.select(clean_plate("p")).collect()]
    assert got == ["AZ1234", "AZ1234", "", None]


def test_behaviour_blank_is_zero_and_plates_merge(spark):
    df = frame(spark, [
        record(1, plate="AZ1234", isOverspeedFinished=1, overspeedTime=3.0),
        record(2, plate="AZ1234", isFatigueDriving=1, neutralSlideTime=2.5),
        record(3, plate="BX9"),
    ])
    got = {r["carPlateNumber"]: r for r in rows(B.behaviour_by_plate(df))}
    assert got["AZ1234"] == {"carPlateNumber": "AZ1234", "overspeed_count": 1,
                             "fatigue_driving_count": 1, "overspeed_time": 3.0,
                             "neutral_slide_time": 2.5}
    assert got["BX9"]["overspeed_count"] == 0 and got["BX9"]["overspeed_time"] == 0.0


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_ragged_rows_zero_all_measures(spark, tmp_dir):
    header = ",".join(FL.FIELD_NAMES)
    full = "d,P1,1,2,50,0,s,2017-01-01 08:00:05,,,,,4.5,1,1,7.0,1,,"
    # 17 fields: field 16 present -> measures parsed (fields 17, 18 missing).
    f17 = "d,P2,1,2,50,0,s,2017-01-01 08:00:05,,,,,4.5,1,1,7.0,1"
    # 16 fields: fields 12, 14, 15 present but field 16 missing -> all four zero.
    f16 = "d,P3,1,2,50,0,s,2017-01-01 08:00:05,,,,,4.5,1,1,7.0"
    f13 = "d,P4,1,2,50,0,s,2017-01-01 08:00:05,,,,"
    _write(tmp_dir, "a.csv", "\n".join([header, full, f17, f16, f13]) + "\n")
    _write(tmp_dir, "ignored.txt", header + "\nd,P9,1,2,50,0,s,2017-01-01 08:00:05\n")
    out = {r["carPlateNumber"]: r for r in rows(B.behaviour_by_plate(
        FL.text_measures(FL.read_rows_text(spark, tmp_dir))))}
    assert set(out) == {"P1", "P2", "P3", "P4"}
    assert (out["P1"]["overspeed_count"], out["P1"]["overspeed_time"],
            out["P1"]["neutral_slide_time"], out["P1"]["fatigue_driving_count"]) == (1, 7.0, 4.5, 1)
    assert out["P2"]["overspeed_time"] == 7.0
    for p in ("P3", "P4"):
        assert (out[p]["overspeed_count"], out[p]["fatigue_driving_count"],
                out[p]["overspeed_time"], out[p]["neutral_slide_time"]) == (0, 0, 0.0, 0.0)


def test_quoted_fields_round_trip(spark, tmp_dir):
    df = frame(spark, [record(1, plate="华AZ-1", siteName='Depot, "North"')])
    FL.write_raw_csv(df, tmp_dir + "/raw")
    back = FL.clean_records(FL.read_raw_csv(spark, tmp_dir + "/raw"))
    r = back.first()
    assert r["siteName"] == 'Depot, "North"' and r["carPlateNumber"] == "AZ1"
    FL.write_clean_csv(back, tmp_dir + "/clean")
    again = FL.read_clean_csv(spark, tmp_dir + "/clean").first()
    assert again["siteName"] == 'Depot, "North"' and again["Time"] == r["Time"]


def test_all_blank_flag_file_stays_int(spark, tmp_dir):
    _write(tmp_dir, "x.csv", ",".join(FL.FIELD_NAMES) + "\n"
           + "d,P,1,2,50,0,s,2017-01-01 08:00:05,,,,,,,,,,,\n")
    df = FL.read_clean_csv(spark, tmp_dir)
    assert dict(df.dtypes)["isOverspeed"] == "int"
    assert S.fill_overspeed(df).first()["isOverspeed"] == 0


def test_equal_times_use_tiebreak(spark):
    df = frame(spark, [
        record(1, speed=10, time="2017-01-01 08:00:00"),
        record(3, speed=30, time="2017-01-01 09:00:00"),
        record(2, speed=20, time="2017-01-01 09:00:00"),
    ])
    got = {r["event_id"]: r for r in rows(TR.record_travel(df))}
    assert got[1]["distance"] is None
    assert got[2]["time_difference"] == 1.0 and got[2]["distance"] == 20.0
    assert got[3]["time_difference"] == 0.0 and got[3]["distance"] == 0.0
    summ = rows(TR.driver_summary(df))[0]
    assert summ["total_distance"] == 20.0


def test_single_record_driver_has_null_distance(spark):
    df = frame(spark, [record(1, driver="solo"), record(2, driver="d2"),
                       record(3, driver="d2", time="2017-01-01 08:30:05", speed=60)])
    got = {r["driverID"]: r for r in rows(TR.driver_summary(df))}
    assert got["solo"]["total_distance"] is None
    assert got["solo"]["total_overspeed"] is None  # all-null sum stays null
    assert got["d2"]["total_distance"] == 30.0


def test_range_is_half_open(spark):
    df = frame(spark, [record(1, time="2017-01-01 08:00:05"),
                       record(2, time="2017-01-01 08:00:34"),
                       record(3, time="2017-01-01 08:00:35")])
    got = sorted(r["event_id"] for r in S.time_range(df, "2017-01-01 08:00:05", 30).collect())
    assert got == [1, 2]
    # empty start falls back to the default start.
    assert S.time_range(df, "", 30).count() == 2


def test_earliest_of_date_edges(spark):
    df = frame(spark, [record(1, time="2017-01-02 09:00:00"), record(2, time="2017-01-02 08:00:01")])
    assert rows(S.earliest_of_date(df, "2017-01-02")) == [{"timestamp": "2017-01-02 08:00:01"}]
    assert rows(S.earliest_of_date(df, "2017-01-05")) == [{"timestamp": None}]
    assert rows(S.earliest_of_date(df, "")) == []
    assert rows(S.earliest_of_date(df, "2017-01")) == [{"timestamp": "2017-01-02 08:00:01"}]


def test_correlation_constant_and_null_columns(spark):
    data = [("a", 1.0, 5.0, None), ("b", 2.0, 5.0, 1.0), ("c", 3.0, 5.0, 2.0), ("d", 4.0, 5.0, 4.0)]
    df = spark.createDataFrame(data, "k string, x double, c double, n double")
    m = {(r["row_measure"], r["col_measure"]): r["corr"]
         for r in ST.correlation_matrix(df, ["x", "c", "n"]).collect()}
    assert m[("x", "x")] == 1.0
    assert m[("x", "c")] is None and m[("c", "c")] is None
    # pairwise complete: x vs n uses rows b, c, d only
    import numpy as np
    want = round(float(np.corrcoef([2.0, 3.0, 4.0], [1.0, 2.0, 4.0])[0, 1]), 6)
    assert m[("x", "n")] == want == m[("n", "x")]


def test_search_terms(spark):
    table = spark.createDataFrame(
        [("AZ1234", 3, 0, 12.5, 0.0), ("BX.9", 0, 1, 10000000.0, 2.0), ("CX%", 1, 0, 0.0, 0.0)],
        "carPlateNumber string, overspeed_count bigint, fatigue_driving_count bigint, "
        "overspeed_time double, neutral_slide_time double")
    def plates(term):
        return sorted(r[0] for r in B.search(table, term).select("carPlateNumber").collect())
    assert plates("az") == ["AZ1234"]
    assert plates("AZ") == ["AZ1234"]
    assert plates(".") == ["AZ1234", "BX.9", "CX%"]  # every double prints with '.'
    assert plates("%") == ["CX%"]
    assert plates("10000000.0") == ["BX.9"]
    assert plates("") == ["AZ1234", "BX.9", "CX%"]
    tot = rows(B.search_totals(table, "x"))[0]
    assert tot == {"recordsTotal": 3, "recordsFiltered": 2}


def test_page_negative_length_means_all(spark):
    table = spark.range(10).withColumnRenamed("id", "carPlateNumber")
    assert B.page(table, 3, -1).count() == 7
    assert [r[0] for r in B.page(table, 3, 2).collect()] == [3, 4]


def test_matrix_text_with_crlf_and_padding(spark, tmp_dir):
    _write(tmp_dir, "m.txt", "1.000000 0.500000\r\n0.500000  1.000000 \r\n")
    got = sorted((r["row_idx"], r["col_idx"], r["corr"])
                 for r in FL.read_matrix_text(spark, tmp_dir).collect())
    assert got == [(0, 0, 1.0), (0, 1, 0.5), (1, 0, 0.5), (1, 1, 1.0)]


def test_union_of_no_frames_is_typed_and_empty(spark):
    empty = FL.union_frames([])
    assert empty.count() == 0 and "Time" in empty.columns


def test_nested_records_sorted_and_named(spark):
    df = frame(spark, [record(2, time="2017-01-01 08:00:20", speed=90, isOverspeed=1),
                       record(1, time="2017-01-01 08:00:10", speed=40)])
    r = S.with_records(df).first()
    assert [x["Speed"] for x in r["records"]] == [40.0, 90.0]
    assert r["records"][0].asDict().keys() == {"Time", "Speed", "isOverspeed"}
    assert r["overspeed_count"] == 1 and r["avg_speed"] == 65.0
    warn = rows(S.warning_counter(df))
    assert warn[0]["message"] == "Warning: Driver AZ1 is speeding (1 times) (90 km/h)"


def test_epoch_seconds_ignore_session_zone(spark):
    from fleetscope.functions.expr import epoch_seconds
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT TIMESTAMP_NTZ'2017-03-12 02:30:00' AS gap, "
                       "TIMESTAMP_NTZ'2017-07-01 00:00:00.9' AS summer")
        r = df.select(epoch_seconds("gap").alias("g"), epoch_seconds("summer").alias("s")).first()
        assert (r["g"], r["s"]) == (1489285800, 1498867200)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_date_prefixes_become_ranges(spark):
    df = frame(spark, [record(1, time="2016-12-31 23:59:59"), record(2, time="2017-01-01 00:00:00"),
                       record(3, time="2017-12-31 23:59:59"), record(4, time="2018-01-01 00:00:00")])
    def ids(p):
        return sorted(r[0] for r in S.date_filter(df, p).select("event_id").collect())
    assert ids("2017") == [2, 3]
    assert ids("2017-12") == [3]
    assert ids("2016-12-31") == [1]
    assert ids("2017-01-01 00") == [2]   # other prefixes: text test
    assert ids("2017-1") == [3] and ids("2016-12-3") == [1] and ids("9999") == ids("9999-12-31") == ids("2017-13") == []
    plan = S.date_filter(df.select("event_id", "Time"), "2017-12")._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "2017-12-01" in plan and "StartsWith" not in plan


def test_time_range_prunes_date_partitions(spark, tmp_dir):
    df = frame(spark, [record(1, time="2017-01-01 08:00:10"), record(2, time="2017-01-02 08:00:10")])
    FL.write_telemetry_table(df, tmp_dir + "/t")
    table = spark.read.parquet(tmp_dir + "/t")
    q = S.time_range(table, "2017-01-01 08:00:05", 30)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [IsNotNull(Time), GreaterThanOrEqual(Time" in plan
    assert [r["event_id"] for r in q.collect()] == [1]


def test_lookup_is_joined_without_a_hint(spark):
    from fleetscope.operators.joins import join_lookup
    facts = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    plan = join_lookup(facts, small, "k")._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower() and join_lookup(facts, small, "k").count() == 10


def test_plateless_rows_rejected_and_empty_plate_kept(spark, tmp_dir):
    header = ",".join(FL.FIELD_NAMES)
    _write(tmp_dir, "a.csv", "\n".join([
        header,
        "d,,1,2,50,0,s,2017-01-01 08:00:05,,,,,1.5,1,1,2.0,1,,",
        "lonely",
        "d,P1,1,2,50,0,s,2017-01-01 08:00:05,,,,,,,,,,,",
    ]) + "\n")
    read = FL.read_rows_text(spark, tmp_dir)
    assert [r["n_fields"] for r in FL.rejected_rows(read).collect()] == [1]
    out = {r["carPlateNumber"]: r for r in rows(B.behaviour_by_plate(FL.text_measures(read)))}
    assert set(out) == {"", "P1"}
    assert out[""]["overspeed_time"] == 2.0


def test_empty_folder_reads_as_empty(spark, tmp_dir):
    os.makedirs(tmp_dir + "/empty", exist_ok=True)
    _write(tmp_dir + "/empty", "notes.txt", "x\n")
    assert FL.read_clean_csv(spark, tmp_dir + "/empty").count() == 0


def test_schema_text_lists_fields(spark):
    df = frame(spark, [record(1)])
    text = FL.schema_text(df)
    assert text.startswith("root") and "|-- Time: timestamp_ntz" in text


def test_numbers_print_in_plain_decimals(spark):
    from pyspark.sql import types as ST
    from fleetscope.functions.expr import text_of
    values = [12345678.9, 0.0005, 45.5, 3.0, 1e15, 0.1234567890123456, -0.00012, 1e16, 1e-5, 123456789012345.6]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(text_of("v", ST.DoubleType())).collect()]
    assert got[:7] == [str(v) for v in values[:7]] and got[9] == str(values[9])
