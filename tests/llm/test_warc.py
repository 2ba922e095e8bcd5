import base64
import hashlib

from pyspark.sql import functions as F

from fleetscope.llm import warc
from fleetscope.llm.common import held
from fleetscope.llm.warc import VERSION_LINE, read_warc, warc_round_trip, write_warc
from fleetscope.session import scratch_path

SCHEMA = "page_id long, url string, html string, block string, row long, file string"
INNER = f"a {VERSION_LINE}WARC-Type: response\r\nContent-Length: 3\r\n\r\nxyz"
ROWS = [(1, "u\r\nx", INNER), (2, None, None), (3, "é", ""), (4, "u", VERSION_LINE), (5, "u", VERSION_LINE * 2 + "WAR" + VERSION_LINE + "\r\n\r\n"),
        (6, "u", "héllo\n"), (7, "u", VERSION_LINE), (None, "u", "q"), (8, "u", "long " * 40_000 + VERSION_LINE + "z")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "b", 1, "f") for r in rows], SCHEMA)


def expected(rows):
    by = {}
    for i, _, h in rows:
        by.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        top = max((x for x in by[h or ""] if x is not None), default=None)
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if i == top else "revisit", None if i == top else top))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_round_trip_with_version_lines_inside_payloads(spark):
    for parts in (1, 3):
        assert got(warc_round_trip(frame(spark, ROWS).repartition(parts))) == expected(ROWS)


def test_repeated_rows_are_all_written(spark):
    rows = [(1, "u", "x"), (1, "u", "x"), (2, "u", "x"), (2, "u", "x")]
    assert got(warc_round_trip(frame(spark, rows))) == expected(rows)


def test_empty_table(spark):
    assert warc_round_trip(frame(spark, ROWS).limit(0)).collect() == []


def test_payload_bytes_survive_and_broken_files_end_at_the_break(spark):
    path = scratch_path(spark, "t-warc")
    write_warc(frame(spark, ROWS[:2]).coalesce(1), path, compression="none")
    back = {r.record_id: bytes(r.payload).decode() for r in read_warc(spark, path).collect()}
    assert back == {"<urn:page:1>": INNER, "<urn:page:2>": ""}
    cut = scratch_path(spark, "t-cut")
    whole = spark.read.text(path, wholetext=True)
    whole.select(F.expr("substring(value, 1, length(value) - 20)")).coalesce(1).write.text(cut, lineSep="!")
    assert [r.record_id for r in read_warc(spark, cut).collect()] == ["<urn:page:1>"]


def test_longer_archives_take_no_more_jobs(spark):
    def jobs(n):
        path, group = scratch_path(spark, "t-long"), f"warc-of-{n}"
        write_warc(frame(spark, [(i, "u", f"page {i}") for i in range(n)]).coalesce(1), path)
        spark.sparkContext.setJobGroup(group, group)
        try:
            assert read_warc(spark, path).count() == n
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(2000) == jobs(20)


def test_a_chain_goes_on_over_more_segments_than_a_batch_holds(spark):
    decoy = f"{VERSION_LINE}Content-Length: 5\r\n\r\n"
    rows = [(1, "u", "first"), (2, "u", f"{VERSION_LINE}x" * 25_000 + decoy), (3, "u", INNER), (4, "u", "last")]
    assert got(warc_round_trip(frame(spark, rows).coalesce(1))) == expected(rows)


def test_tables_of_many_rows_are_merged(spark, monkeypatch):
    monkeypatch.setattr(warc, "SENT_ROWS", 1)
    assert got(warc_round_trip(frame(spark, ROWS).repartition(2))) == expected(ROWS)
    joined = spark.range(9).join(warc._unsent(held(spark.range(3), "t-many")), "id")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 3
