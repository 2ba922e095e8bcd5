"""Oracle SQL (DuckDB dialect) for every registered query that SQL can express.

Each statement rebuilds the telemetry view from ``events`` with the same
adapter as ``fleetscope.sources.telemetry`` and then states the operator's
semantics directly, independent of the Spark implementation.
"""

from __future__ import annotations

from fleetscope.schema import FIELD_NAMES, MEASURES, REGRESSION_FEATURES, REGRESSION_LABEL

TELEMETRY_CTE = """
ev AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
         CAST(floor((epoch_us(ts) - 1704067200000000) / 300000000) AS BIGINT) AS el
  FROM events
),
telemetry AS (
  SELECT event_id,
    concat('driver', lpad(CAST(user_id AS VARCHAR), 6, '0')) AS driverID,
    regexp_replace(concat('华-AZ ', lpad(CAST(user_id // 2 AS VARCHAR), 5, '0')),
                   '[^a-zA-Z0-9]', '', 'g') AS carPlateNumber,
    30.0::DOUBLE + k / 100.0::DOUBLE AS Latitude,
    110.0::DOUBLE + (user_id % 100) / 100.0::DOUBLE AS Longitude,
    CAST(floor(least(value, 160.0::DOUBLE)) AS INT) AS Speed,
    CAST((k * 3) % 360 AS INT) AS Direction,
    concat('site ', CAST(user_id % 10 AS VARCHAR)) AS siteName,
    make_timestamp(1000000 * (1483257605 + (event_id % 10) * 86400 + el)) AS Time,
    CASE WHEN event_type = 'click' THEN 1 END AS isRapidlySpeedup,
    CASE WHEN event_type = 'view' THEN 1 END AS isRapidlySlowdown,
    CASE WHEN event_type = 'signup' THEN 1 END AS isNeutralSlide,
    CASE WHEN event_type = 'signup' AND k % 2 = 0 THEN 1 END AS isNeutralSlideFinished,
    CASE WHEN event_type = 'signup' AND k % 2 = 0 THEN CAST(k AS DOUBLE) END AS neutralSlideTime,
    CASE WHEN value > 80 THEN 1 END AS isOverspeed,
    CASE WHEN value > 100 THEN 1 END AS isOverspeedFinished,
    CASE WHEN value > 100 THEN CAST(k AS DOUBLE) END AS overspeedTime,
    CASE WHEN event_type = 'error' THEN 1 END AS isFatigueDriving,
    CASE WHEN event_type = 'purchase' AND k % 3 = 0 THEN 1 END AS isHthrottleStop,
    CASE WHEN event_type = 'purchase' AND k % 10 = 0 THEN 1 END AS isOilLeak
  FROM ev
)"""


def with_telemetry(body: str, *ctes: str) -> str:
    """Prefix a statement with the telemetry adapter (and optional extra CTEs)."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {TELEMETRY_CTE.strip()}{extra}\n{body.strip()}"


BEHAVIOUR_CTE = """behaviour AS (
  SELECT carPlateNumber,
    CAST(sum(coalesce(isOverspeedFinished, 0)) AS BIGINT) AS overspeed_count,
    CAST(sum(coalesce(isFatigueDriving, 0)) AS BIGINT) AS fatigue_driving_count,
    sum(coalesce(overspeedTime, 0.0)) AS overspeed_time,
    sum(coalesce(neutralSlideTime, 0.0)) AS neutral_slide_time
  FROM telemetry GROUP BY carPlateNumber
)"""

SQL: dict[str, str] = {}

SQL["a1_behaviour_by_plate"] = with_telemetry("SELECT * FROM behaviour", BEHAVIOUR_CTE)

TRAVEL_CTE = """travel AS (
  SELECT *, (epoch(Time)::BIGINT
             - epoch(lag(Time) OVER (PARTITION BY driverID ORDER BY Time, event_id))::BIGINT)
            AS dt_seconds
  FROM telemetry
)"""

SUMMARY_CTE = """summary AS (
SELECT driverID,
  CAST(sum(isRapidlySpeedup) AS BIGINT) AS total_rapid_accelerations,
  CAST(sum(isRapidlySlowdown) AS BIGINT) AS total_rapid_decelerations,
  CAST(sum(isNeutralSlide) AS BIGINT) AS total_neutral_slide,
  sum(neutralSlideTime) AS total_neutral_slide_duration,
  CAST(sum(isOverspeed) AS BIGINT) AS total_overspeed,
  sum(overspeedTime) AS total_overspeed_duration,
  CAST(sum(isFatigueDriving) AS BIGINT) AS total_fatigue_driving,
  CAST(sum(isHthrottleStop) AS BIGINT) AS total_hthrottle_stop,
  CAST(sum(isOilLeak) AS BIGINT) AS total_oil_leak,
  avg(Speed) AS average_speed,
  CAST(sum(Speed * dt_seconds) AS BIGINT) / 3600.0::DOUBLE AS total_distance
FROM travel GROUP BY driverID
)"""

SQL["a3_driver_summary"] = with_telemetry("SELECT * FROM summary", TRAVEL_CTE, SUMMARY_CTE)


SQL["w1_record_travel"] = with_telemetry("""
SELECT driverID, event_id, strftime(Time, '%Y-%m-%d %H:%M:%S') AS Time, Speed,
  dt_seconds / 3600.0::DOUBLE AS time_difference,
  Speed * (dt_seconds / 3600.0::DOUBLE) AS distance
FROM travel""", TRAVEL_CTE)

FMT = "'%Y-%m-%d %H:%M:%S'"
SLICE_WHERE = ("Time >= TIMESTAMP '2017-01-01 08:00:05' "
               "AND Time < TIMESTAMP '2017-01-01 08:00:35'")
SLICE_CTE = f"""slice AS (
  SELECT *, coalesce(isOverspeed, 0) AS ov FROM telemetry WHERE {SLICE_WHERE}
)"""
RECORDS_CTE = f"""records AS (
  SELECT strftime(Time, {FMT}) AS Time, CAST(Speed AS FLOAT) AS Speed,
         ov AS isOverspeed, carPlateNumber AS car_plate_number
  FROM slice
)"""
A2_CTE = """a2 AS (
  SELECT carPlateNumber, avg(Speed) AS avg_speed,
         CAST(sum(ov) AS BIGINT) AS overspeed_count, count(*) AS n_records
  FROM slice GROUP BY carPlateNumber
)"""

SQL["a2_speed_slice"] = with_telemetry("SELECT * FROM a2", SLICE_CTE, A2_CTE)
SQL["p9_slice_records"] = with_telemetry("SELECT * FROM records", SLICE_CTE, RECORDS_CTE)
SQL["p8_nested_records"] = with_telemetry(
    "SELECT car_plate_number, Time, Speed, isOverspeed FROM records", SLICE_CTE, RECORDS_CTE)
SQL["a8_plate_speed"] = with_telemetry("""
SELECT car_plate_number, sum(Speed) / count(*) AS speed, count(*) AS count
FROM records GROUP BY car_plate_number""", SLICE_CTE, RECORDS_CTE)
SQL["f4_overspeed_warnings"] = with_telemetry("""
SELECT carPlateNumber AS car_plate_number, overspeed_count FROM a2 WHERE overspeed_count > 0""",
                                              SLICE_CTE, A2_CTE)
SQL["a9_warning_counter"] = with_telemetry("""
SELECT carPlateNumber AS car_plate_number, count(*) AS overspeed_count,
  CAST(max(CASE WHEN rn = 1 THEN Speed END) AS FLOAT) AS speed,
  printf('Warning: Driver %s is speeding (%d times) (%d km/h)', carPlateNumber, count(*),
         max(CASE WHEN rn = 1 THEN Speed END)) AS message
FROM (SELECT *, row_number() OVER (PARTITION BY carPlateNumber ORDER BY Time, event_id) AS rn
      FROM slice WHERE ov = 1)
GROUP BY carPlateNumber""", SLICE_CTE)
SQL["a4_earliest_of_date"] = with_telemetry(f"""
SELECT strftime(min(Time), {FMT}) AS timestamp FROM telemetry
WHERE Time >= TIMESTAMP '2017-01-03 00:00:00' AND Time < TIMESTAMP '2017-01-04 00:00:00'""")
SQL["f2_earliest_of_month"] = with_telemetry(f"""
SELECT strftime(min(Time), {FMT}) AS timestamp FROM telemetry
WHERE starts_with(strftime(Time, {FMT}), '2017-01')""")
SQL["t1_speed_by_window"] = with_telemetry(f"""
SELECT strftime(b, {FMT}) AS window_start, strftime(b + INTERVAL 30 SECOND, {FMT}) AS window_end,
  carPlateNumber, avg(Speed) AS avg_speed, count(*) AS n_records,
  CAST(sum(coalesce(isOverspeed, 0)) AS BIGINT) AS overspeed_count
FROM (SELECT *, time_bucket(INTERVAL 30 SECOND, Time, TIMESTAMP '2017-01-01 08:00:05') AS b
      FROM telemetry)
GROUP BY b, carPlateNumber""")
SQL["t4_replay_slices"] = with_telemetry(f"""
SELECT strftime(d, '%Y-%m-%d') AS date, slice_no,
  strftime(anchor + to_seconds(slice_no * 30), {FMT}) AS slice_start,
  carPlateNumber, avg(Speed) AS avg_speed, count(*) AS n_records,
  CAST(sum(coalesce(isOverspeed, 0)) AS BIGINT) AS overspeed_count
FROM (SELECT t.*, a.d, a.anchor,
        (CAST(epoch(t.Time) AS BIGINT) - CAST(epoch(a.anchor) AS BIGINT)) // 30 AS slice_no
      FROM telemetry t JOIN (SELECT CAST(Time AS DATE) AS d, min(Time) AS anchor
                             FROM telemetry GROUP BY 1) a ON CAST(t.Time AS DATE) = a.d)
GROUP BY d, anchor, slice_no, carPlateNumber""")

MEASURE_NAMES = MEASURES


def _text(col: str) -> str:
    return f"lower(CAST({col} AS VARCHAR))"


_SEARCH = " OR ".join(f"contains({_text(c)}, '1')" for c in
                      ["carPlateNumber", "overspeed_count", "fatigue_driving_count",
                       "overspeed_time", "neutral_slide_time"])

SQL["f3_search_page"] = with_telemetry(f"""
SELECT * FROM behaviour WHERE {_SEARCH}
ORDER BY carPlateNumber LIMIT 25 OFFSET 25""", BEHAVIOUR_CTE)
SQL["a10_search_totals"] = with_telemetry(f"""
SELECT count(*) AS recordsTotal, count(*) FILTER (WHERE {_SEARCH}) AS recordsFiltered
FROM behaviour""", BEHAVIOUR_CTE)

_SUM = (TRAVEL_CTE, SUMMARY_CTE)
SQL["s9_driver_summary_table"] = with_telemetry("SELECT * FROM summary", *_SUM)
SQL["a12_overspeed_bars"] = with_telemetry(
    "SELECT driverID, avg(total_overspeed_duration) AS total_overspeed_duration "
    "FROM summary GROUP BY driverID", *_SUM)

SQL["a5_summary_stats"] = with_telemetry("\nUNION ALL\n".join(
    f"SELECT '{m}' AS measure, {i} AS measure_idx, round(avg({m}), 6) AS mean, "
    f"round(median({m}), 6) AS median, round(stddev_samp({m}), 6) AS std FROM summary"
    for i, m in enumerate(MEASURE_NAMES)), *_SUM)


def _corr_pairs() -> str:
    parts = []
    for i, a in enumerate(MEASURE_NAMES):
        for j, b in enumerate(MEASURE_NAMES):
            x, y = (a, b) if i <= j else (b, a)
            cond = f"{x} IS NOT NULL AND {y} IS NOT NULL"
            parts.append(
                f"SELECT '{a}' AS row_measure, '{b}' AS col_measure, {i} AS row_idx, "
                f"{j} AS col_idx, CASE WHEN stddev_samp({x}) FILTER (WHERE {cond}) > 0 "
                f"AND stddev_samp({y}) FILTER (WHERE {cond}) > 0 "
                f"AND corr({y}, {x}) IS NOT NULL "
                f"THEN round(greatest(least(corr({y}, {x}), 1.0), -1.0), 6) END AS corr "
                f"FROM summary")
    return "\nUNION ALL\n".join(parts)


SQL["a6_correlation_matrix"] = with_telemetry(_corr_pairs(), *_SUM)

BOX_CTE = """box AS (
  SELECT quantile_cont(total_rapid_accelerations, 0.25) AS q1,
         quantile_cont(total_rapid_accelerations, 0.5) AS q2,
         quantile_cont(total_rapid_accelerations, 0.75) AS q3
  FROM summary
)"""
SQL["a11_boxplot_accelerations"] = with_telemetry("""
SELECT round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
  round(min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1) THEN x END), 6)
    AS whisker_low,
  round(max(CASE WHEN x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1) THEN x END), 6)
    AS whisker_high,
  count(*) FILTER (WHERE x IS NOT NULL AND NOT (x >= q1 - 1.5 * (q3 - q1)
                                                AND x <= q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM (SELECT CAST(total_rapid_accelerations AS DOUBLE) AS x FROM summary), box
GROUP BY q1, q2, q3""", *_SUM, BOX_CTE)
SQL["a11_boxplot_outliers"] = with_telemetry("""
SELECT driverID, total_rapid_accelerations FROM summary, box
WHERE total_rapid_accelerations < q1 - 1.5 * (q3 - q1)
   OR total_rapid_accelerations > q3 + 1.5 * (q3 - q1)""", *_SUM, BOX_CTE)

_FIELDS = ", ".join(FIELD_NAMES)
WINDOWS_CTE = f"""windows AS (
  SELECT strftime(b, {FMT}) AS window_start, strftime(b + INTERVAL 30 SECOND, {FMT}) AS window_end,
    carPlateNumber, avg(Speed) AS avg_speed, count(*) AS n_records,
    CAST(sum(coalesce(isOverspeed, 0)) AS BIGINT) AS overspeed_count
  FROM (SELECT *, time_bucket(INTERVAL 30 SECOND, Time, TIMESTAMP '2017-01-01 08:00:05') AS b
        FROM telemetry)
  GROUP BY b, carPlateNumber
)"""
_ALERTS = ("SELECT window_start, window_end, carPlateNumber AS car_plate_number, "
           "overspeed_count, avg_speed FROM windows WHERE overspeed_count > 0")

SQL["t3_overspeed_alerts"] = with_telemetry(_ALERTS, WINDOWS_CTE)
SQL["s7_alert_json"] = with_telemetry(_ALERTS, WINDOWS_CTE)
# Cells of the messy raw files, as text; the plate cleaned.
MESSY_CTE = """messy AS (
  SELECT *, event_id % 11 = 0 AS short, event_id % 11 <> 0 AND event_id % 13 = 0 AS long,
    CASE WHEN event_id % 7 = 0 THEN strftime(Time, '%Y/%-m/%-d %-H:%M:%S') ELSE strftime(Time, '%Y-%m-%d %H:%M:%S') END AS time_text,
    Speed::VARCHAR || CASE WHEN event_id % 2 = 0 THEN '.50' ELSE '' END AS speed_text,
    siteName || CASE WHEN event_id % 17 = 0 THEN chr(10) || 'north, "old" wing' ELSE '' END AS site_text
  FROM telemetry
)"""
_CELLS = ["driverID", "carPlateNumber", "Latitude::VARCHAR", "Longitude::VARCHAR", "speed_text", "Direction::VARCHAR", "site_text", "time_text",
          *[f"coalesce({n}::VARCHAR, '')" for n in FIELD_NAMES[8:]]]
SQL["s1_raw_csv_round_trip"] = with_telemetry(f"""
SELECT array_to_string(cells, '|') AS record, len(cells) AS n_fields FROM (
  SELECT CASE WHEN short THEN all_cells[1:12] WHEN long THEN list_append(all_cells, 'extra') ELSE all_cells END AS cells
  FROM (SELECT *, [{", ".join(_CELLS)}] AS all_cells FROM messy))""", MESSY_CTE)
SQL["s1_rejected_cells"] = with_telemetry("""
SELECT 7 AS field, time_text AS text FROM messy WHERE event_id % 7 = 0 UNION ALL SELECT 19, 'extra' FROM messy WHERE long""", MESSY_CTE)
_STRAY = ["driverID", "carPlateNumber", "Latitude::VARCHAR", "Longitude::VARCHAR", "Speed::VARCHAR", "Direction::VARCHAR",
          """siteName || CASE WHEN event_id % 5 = 0 THEN ' "east" 7"' WHEN event_id % 7 = 0 THEN ', "old"x"y'
             WHEN event_id % 11 = 0 THEN chr(10) || chr(10) || '"gate", 2' ELSE '' END""",
          "strftime(Time, '%Y-%m-%d %H:%M:%S')", *[f"coalesce({n}::VARCHAR, '')" for n in FIELD_NAMES[8:]]]
SQL["s1_stray_quotes"] = with_telemetry(f"SELECT array_to_string([{', '.join(_STRAY)}], '|') AS record, 19 AS n_fields FROM telemetry")
SQL["s9_clean_then_analyze"] = with_telemetry("SELECT * EXCLUDE (total_distance) FROM summary", TRAVEL_CTE, SUMMARY_CTE)
_NULLED = {"Direction": "event_id % 4 = 2", "siteName": "event_id % 4 = 2", "isOilLeak": "event_id % 4 = 3", "Speed": "event_id % 40 = 3"}
SQL["s2_header_columns"] = with_telemetry("SELECT " + ", ".join(
    f"CASE WHEN NOT ({_NULLED[n]}) THEN {n} END::{'DOUBLE' if n == 'Speed' else 'VARCHAR' if n == 'siteName' else 'INT'} AS {n}" if n in _NULLED else n
    for n in FIELD_NAMES) + " FROM telemetry")
SQL["s2_rejected_cells"] = with_telemetry("""
SELECT 4 AS field, 'n/a' AS text, count(*) AS n FROM telemetry WHERE event_id % 40 = 3 HAVING count(*) > 0
UNION ALL SELECT 19, 'x', count(*) FROM telemetry WHERE event_id % 4 = 2 HAVING count(*) > 0""")
SQL["s3_csv_names"] = with_telemetry("""
SELECT ['in-order', 'reversed', 'fewer', 'blank'][event_id % 4 + 1] AS folder, count(*) AS n_rows FROM telemetry GROUP BY 1""")
SQL["p4_ragged_rows"] = with_telemetry("""
SELECT carPlateNumber, CAST(sum(CASE WHEN short THEN 0 ELSE coalesce(isOverspeedFinished, 0) END) AS BIGINT) AS overspeed_count,
  CAST(sum(CASE WHEN short THEN 0 ELSE coalesce(isFatigueDriving, 0) END) AS BIGINT) AS fatigue_driving_count,
  sum(CASE WHEN short THEN 0 ELSE coalesce(overspeedTime, 0.0) END) AS overspeed_time,
  sum(CASE WHEN short THEN 0 ELSE coalesce(neutralSlideTime, 0.0) END) AS neutral_slide_time
FROM messy GROUP BY carPlateNumber""", MESSY_CTE)
SQL["s5_outputs"] = with_telemetry("SELECT right(driverID, 1) AS source, count(*) AS n_rows, TRUE AS one_each FROM telemetry GROUP BY 1")
SQL["t7_stream_ingest"] = with_telemetry(f"""
SELECT driverID, carPlateNumber, Latitude, Longitude, speed_text::DOUBLE AS Speed, Direction, site_text AS siteName,
  CASE WHEN event_id % 7 <> 0 THEN Time END AS Time, {", ".join(FIELD_NAMES[8:12])},
  {", ".join(f"CASE WHEN NOT short THEN {n} END AS {n}" for n in FIELD_NAMES[12:])} FROM messy""", MESSY_CTE)
SQL["u1_union_files"] = with_telemetry(f"SELECT {_FIELDS} FROM telemetry")
SQL["s4_behaviour_from_rows"] = SQL["a1_behaviour_by_plate"]
SQL["s5_partitioned_table"] = with_telemetry(f"SELECT {_FIELDS} FROM telemetry")
SQL["s6_matrix_round_trip"] = SQL["a6_correlation_matrix"]
SQL["l2_preview"] = with_telemetry(f"""
SELECT event_id, driverID, carPlateNumber, strftime(Time, {FMT}) AS Time, Speed
FROM telemetry ORDER BY Time, event_id LIMIT 3""")

SQL["t1_stream_speed_windows"] = with_telemetry("SELECT * FROM windows", WINDOWS_CTE)
SQL["t3_stream_alerts"] = SQL["t3_overspeed_alerts"]
SQL["t6_stream_totals"] = SQL["a1_behaviour_by_plate"]
SQL["t5_stream_distance"] = SQL["w1_record_travel"]
SQL["t2_watermark_late_rows"] = with_telemetry("""
SELECT w.*, (SELECT count(*) FROM telemetry) - (SELECT sum(n_records) FROM kept) AS dropped_rows FROM kept w""", WINDOWS_CTE, """kept AS (
  SELECT * FROM windows WHERE window_start >= (SELECT strftime(max(Time), '%Y-%m-%d') FROM telemetry))""")
SQL["t2_late_rows"] = with_telemetry(f"""
SELECT driverID, event_id, carPlateNumber, strftime(Time, {FMT}) AS Time FROM telemetry
WHERE Time::DATE < (SELECT max(Time)::DATE FROM telemetry)""")
SQL["f2_prefix_partial_day"] = with_telemetry("""
SELECT strftime(min(Time), '%Y-%m-%d %H:%M:%S') AS timestamp FROM telemetry WHERE starts_with(strftime(Time, '%Y-%m-%d %H:%M:%S'), '2017-01-1')""")
SQL["f2_prefix_partial_month"] = SQL["f2_prefix_partial_day"].replace("2017-01-1", "2017-1")
SQL["a3_fractional_speed"] = with_telemetry("""
SELECT driverID, round(avg(v), 6) AS average_speed, round(sum(v * dt) / 3600.0, 2) AS total_distance, round(sum(v * (dt / 3600.0)), 2) AS record_distance
FROM (SELECT driverID, least(e.value, 160.0::DOUBLE) AS v, epoch(Time)::BIGINT - epoch(lag(Time) OVER (PARTITION BY driverID ORDER BY Time, t.event_id))::BIGINT AS dt
      FROM telemetry t JOIN events e ON e.event_id = t.event_id) GROUP BY driverID""")
SQL["t4_stream_replay_cursor"] = SQL["t4_replay_slices"]
SQL["t5_stream_distance_batches"] = SQL["w1_record_travel"]

SQL["s7_chart_payload"] = with_telemetry("""
SELECT a2.carPlateNumber AS car_plate_number, a2.avg_speed, a2.overspeed_count,
       r.Time, r.Speed AS speed, r.isOverspeed
FROM a2 JOIN records r ON r.car_plate_number = a2.carPlateNumber""",
                                         SLICE_CTE, A2_CTE, RECORDS_CTE)

SQL["m3_train_test_split"] = with_telemetry("""
SELECT driverID, ('0x' || substr(md5(driverID || ':42'), 1, 8))::BIGINT % 10000 < 2000 AS is_test FROM summary""", TRAVEL_CTE, SUMMARY_CTE)

_TEXTS = "event_id, driverID, carPlateNumber, siteName, strftime(Time, '%Y-%m-%d %H:%M:%S') AS Time"
SQL["f3_indexed_search"] = with_telemetry(f"""
SELECT * FROM (SELECT {_TEXTS} FROM telemetry)
WHERE contains(lower(concat_ws(chr(1), event_id, driverID, carPlateNumber, siteName, Time)), '03 08:')""")
SQL["l1_deep_page"] = with_telemetry(f"""
SELECT event_id, driverID, strftime(Time, {FMT}) AS Time, Speed FROM telemetry
ORDER BY Time, event_id LIMIT 25 OFFSET (SELECT count(*) * 3 // 4 FROM telemetry)""")


def _least_squares() -> list[str]:
    """Normal equations of the centred training rows, solved by elimination, one table per column; (i, v) are the coefficients."""
    p = len(REGRESSION_FEATURES)
    values = ", ".join(f"coalesce({f}, 0)::DOUBLE" for f in REGRESSION_FEATURES)
    ctes = [f"""flagged AS (
  SELECT *, ('0x' || substr(md5(driverID || ':42'), 1, 8))::BIGINT % 10000 < 2000 AS is_test, [{values}, {REGRESSION_LABEL}::DOUBLE] AS x FROM summary)""",
            f"""train AS (
  SELECT driverID, unnest(range({p + 1})) AS i, unnest(x) AS v FROM flagged WHERE NOT is_test AND {REGRESSION_LABEL} IS NOT NULL)""",
            "means AS (SELECT i, avg(v) AS mean FROM train GROUP BY i)",
            "centred AS (SELECT driverID, i, v - mean AS v FROM train JOIN means USING (i))",
            f"""m0 AS MATERIALIZED (
  SELECT a.i, b.i AS j, sum(a.v * b.v) AS v FROM centred a JOIN centred b USING (driverID) WHERE a.i < {p} GROUP BY a.i, b.i)"""]
    for k in range(p):
        ctes.append(f"""m{k + 1} AS MATERIALIZED (
  SELECT a.i, a.j, CASE WHEN a.i = {k} THEN a.v / d.v ELSE a.v - c.v * q.v / d.v END AS v
  FROM m{k} a JOIN m{k} q ON q.i = {k} AND q.j = a.j JOIN m{k} c ON c.i = a.i AND c.j = {k} JOIN m{k} d ON d.i = {k} AND d.j = {k})""")
    ctes.append(f"coefficients AS (SELECT i, v FROM m{p} WHERE j = {p})")
    ctes.append(f"""intercept AS (
  SELECT (SELECT mean FROM means WHERE i = {p}) - (SELECT sum(v * mean) FROM coefficients JOIN means USING (i)) AS v)""")
    return ctes


_NAMES = "[" + ", ".join(f"'{f}'" for f in REGRESSION_FEATURES) + "]"
SQL["m4_regression_coefficients"] = with_telemetry(f"""
SELECT {_NAMES}[i + 1] AS feature, round(v, 6) AS coefficient FROM coefficients
UNION ALL SELECT 'intercept', round(v, 6) FROM intercept""", TRAVEL_CTE, SUMMARY_CTE, *_least_squares())
_PREDICTED = f"""predicted AS (
  SELECT driverID, {REGRESSION_LABEL}, (SELECT v FROM intercept) + list_inner_product(x[1:{len(REGRESSION_FEATURES)}], (SELECT list(v ORDER BY i) FROM coefficients)) AS prediction
  FROM flagged WHERE is_test)"""
SQL["m5_regression_predictions"] = with_telemetry(f"""
SELECT driverID, {REGRESSION_LABEL}, round(prediction, 6) AS prediction FROM predicted""", TRAVEL_CTE, SUMMARY_CTE, *_least_squares(), _PREDICTED)
SQL["m5_regression_score"] = with_telemetry(f"""
SELECT count(*) AS n_test, round(1 - sum(({REGRESSION_LABEL} - prediction) ** 2) / nullif(var_pop({REGRESSION_LABEL}) * count(*), 0), 6) AS r2
FROM predicted""", TRAVEL_CTE, SUMMARY_CTE, *_least_squares(), _PREDICTED)

SQL["s7_live_records"] = with_telemetry(f"""
SELECT strftime(Time, {FMT}) AS Time, Speed::FLOAT AS Speed, coalesce(isOverspeed, 0)::INT AS isOverspeed, carPlateNumber AS car_plate_number FROM telemetry
WHERE Time >= TIMESTAMP '2017-01-01 08:00:05' AND Time < TIMESTAMP '2017-01-01 08:00:35'""")
SQL["s7_live_warnings"] = with_telemetry("""
SELECT carPlateNumber AS car_plate_number, sum(isOverspeed)::BIGINT AS overspeed_count FROM telemetry
WHERE Time >= TIMESTAMP '2017-01-01 08:00:05' AND Time < TIMESTAMP '2017-01-01 09:00:05' GROUP BY 1 HAVING sum(isOverspeed) > 0""")
SQL["f8_day_steps"] = with_telemetry("""
SELECT driverID, count(*) FILTER (WHERE Time::DATE = before::DATE) AS same_day, count(*) FILTER (WHERE Time::DATE <> before::DATE) AS other_day
FROM (SELECT driverID, Time, lag(Time) OVER (PARTITION BY driverID ORDER BY Time, event_id) AS before FROM telemetry)
WHERE before IS NOT NULL GROUP BY driverID""")
