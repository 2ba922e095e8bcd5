r"""WARC archives: writing with revisit records, reading by boundary-chain verification.

Writing. Every page becomes one record. Pages of equal payload share one
``response`` record (the largest page id); the others are ``revisit`` records
that name it. The records go out through Spark's text sink: the record
separator CR LF CR LF is the sink's line separator, so each part file is one
archive.

Reading. Splitting an archive at every occurrence of the version line finds
all record starts, and also such lines inside payloads. Each task therefore
only notes *candidates*: sizes of the segment and its header, and the
Content-Length, which implies the offset of the successor. Starting with offset 0
of each file, one pass over its candidates in order, without their text, keeps
those that the chain of successors reaches; all others lie inside a payload. The
pass holds one offset and hands on the exceptions only. The pieces of a payload
that held a version line are joined again.

Defined results: a null payload is an empty one; a null page id is written as
``null`` and read back as null; rows that repeat a page id and payload are all
written, each as response if their id is the largest of the payload. A file
that does not start with a version line, or a chain that breaks (truncated
file), yields the records up to the break.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held, scratch_path, ship_package

#: Fixed values of the WARC 1.1 format.
VERSION_LINE = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Digits of conv() in base 32.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

#: A table of more rows is not sent through the driver to every task. Catalyst takes the size of
#: compressed files for the size in memory; ascending numbers and repeated digests take 100 times that.
SENT_ROWS = 1 << 18


def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of the SHA-1; 160 bits are four groups of 40 bits."""
    hex40 = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(hex40, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*groups)), CONV_DIGITS, BASE32_DIGITS)


def _unsent(table: DataFrame) -> DataFrame:
    """The held ``table``, to be joined by a merge if it has more than ``SENT_ROWS`` rows."""
    return table.hint("merge") if table.count() > SENT_ROWS else table


def with_revisits(pages: DataFrame, page_id: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """``pages`` as (page_id, uri-less) keys with digest, record type and the page referred to."""
    keyed = held(pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.octet_length(F.coalesce(F.col(payload), F.lit(""))).cast("long").alias("payload_bytes"),
        sha1_base32(F.coalesce(F.col(payload), F.lit("")).cast("binary")).alias("payload_digest")), "warc-keys")
    shared = (keyed.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
              .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    return held(keyed.join(shared, ["payload_digest", "payload_bytes"])
                .filter(~F.col("page_id").eqNullSafe(F.col("largest")))
                .select("page_id", "payload_digest", F.col("largest").alias("refers_to")).distinct(), "warc-revisits")


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", uri: str = "url", payload: str = "html",
               min_revisit_bytes: int = 0, compression: str = "gzip") -> None:
    """Write one record per row of ``pages`` under ``path``, one archive per task.

    Which pages are revisits is found on (id, digest) alone; that table is
    written first, so the join with the payloads is a broadcast only where its
    size on disk is below Spark's broadcast threshold and it has few rows."""
    revisits = with_revisits(pages, page_id, payload, min_revisit_bytes)
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(uri).cast("string").alias("uri"),
                     F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    p = p.withColumn("payload_digest", sha1_base32(F.col("payload").cast("binary")))
    r = _unsent(revisits.withColumnRenamed("page_id", "r_id").withColumnRenamed("payload_digest", "r_digest"))
    p = p.join(r, p.page_id.eqNullSafe(r.r_id) & (p.payload_digest == r.r_digest), "left")
    is_revisit = F.col("r_digest").isNotNull()
    block = F.when(is_revisit, F.lit("")).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("payload")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda k, v: F.concat(F.lit(k + ": "), v, F.lit("\r\n"))
    # a line break would end the header line
    safe_uri = F.regexp_replace("uri", "[\r\n]", "%0A")
    record = F.concat(
        F.lit(VERSION_LINE),
        line("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        F.when(F.col("uri").isNotNull(), line("WARC-Target-URI", safe_uri)).otherwise(F.lit("")),
        F.when(is_revisit, line("WARC-Refers-To", urn(F.col("refers_to")))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block)
    p.select(record.alias("value")).write.option("lineSep", RECORD_END).option("compression", compression).text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The text between version lines: file, order (block, row) within it, bytes, and the header's fields."""
    raw = spark.read.option("lineSep", VERSION_LINE).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value")
    header = F.substring_index("value", RECORD_END, 1)
    field = lambda k: F.nullif(F.regexp_extract(F.concat(F.lit("\r\n"), F.col("header")), rf"(?i)\r\n{k}:[ \t]*([^\r\n]*)", 1), F.lit(""))
    out = raw.withColumn("size", F.octet_length("value").cast("long")).withColumn("header", F.when(F.locate(RECORD_END, F.col("value")) > 0, header))
    return held(out.withColumn("head_size", F.octet_length("header").cast("long") + len(RECORD_END))
                .withColumn("content_length", field("Content-Length").try_cast("long")), "warc-segments")


def _exceptions(segments: DataFrame) -> DataFrame:
    """(row, record, k) of the segments that are not one whole true record: ``record`` is the offset of the true
    record whose payload was torn there and ``k`` the segment's place in its file; null and in no record else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, k, n, ahead, record, end = None, 0, len(VERSION_LINE), None, None, 0
        for batch in batches:
            rows, records, places = [], [], []
            for name, row, size, head, length in zip(*(batch.column(c).to_pylist() for c in ("file", "row", "size", "head_size", "content_length")), strict=True):
                if name != file:
                    file, k, ahead, record, end = name, 0, None, None, 0
                k += 1
                offset = ahead  # of the version line before the segment; the first has none
                ahead = size if offset is None else offset + n + size
                begins = offset is not None and offset == end and length is not None and length >= 0
                if begins:
                    record, end = offset, offset + n + head + length + len(RECORD_END)
                if not (begins and ahead >= end):
                    rows.append(row)
                    # after a break in the chain, what follows the last record belongs to nothing
                    records.append(record if record is not None and offset < end else None)
                    places.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (rows, records, places)], names=["row", "record", "k"])

    # the text itself does not move
    placed = segments.select("file", "block", "row", "size", "head_size", "content_length")
    return held(placed.repartition(F.col("file")).sortWithinPartitions("file", "block", "row")
                .mapInArrow(run, "row long, record long, k long"), "warc-exceptions")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All true records under ``path``: file, record_type, record_id, refers_to, uri,
    payload_digest (as the header states it), block (bytes) and payload (bytes after the HTTP head)."""
    ship_package(spark)
    segments = _segments(spark, path)
    # nearly every segment is one whole record, so the text moves only where a payload was torn
    odd = _exceptions(segments)
    texts = segments.select("file", "row", "value")
    whole = texts.join(_unsent(odd.select("row")), "row", "left_anti").select("file", "value")
    torn = (texts.join(_unsent(odd.filter("record is not null")), "row").groupBy("file", "record")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "value"))), lambda x: x.value), VERSION_LINE).alias("value"))
            .drop("record"))
    # records are whole only if their bytes are there up to the end that the header states
    rec = whole.unionByName(torn)
    rec = rec.withColumn("header", F.substring_index("value", RECORD_END, 1))
    field = lambda k: F.nullif(F.regexp_extract(F.concat(F.lit("\r\n"), F.col("header")), rf"(?i)\r\n{k}:[ \t]*([^\r\n]*)", 1), F.lit(""))
    bytes_ = F.col("value").cast("binary")
    rec = rec.withColumn("length", field("Content-Length").cast("int"))
    rec = rec.withColumn("block", F.substring(bytes_, F.octet_length("header") + len(RECORD_END) + 1, F.col("length")))
    rec = rec.filter(F.octet_length("block") == F.col("length"))
    text = F.col("block").cast("string")
    head = F.octet_length(F.substring_index(text, RECORD_END, 1)) + len(RECORD_END)
    return rec.select("file", field("WARC-Type").alias("record_type"),
                      field("WARC-Record-ID").alias("record_id"), field("WARC-Refers-To").alias("refers_to"),
                      field("WARC-Target-URI").alias("uri"), field("WARC-Payload-Digest").alias("payload_digest"), "block",
                      F.when(F.col("length") > 0, F.substring(F.col("block"), head + 1, F.col("length"))).otherwise(F.lit(b"")).alias("payload"))


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, r"<urn:page:(-?\d+)>", 1).try_cast("long")


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives, read them back, and describe every record by its page.

    Digest and size of a response come from the bytes read back; a revisit takes
    them from the response that it refers to."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path)
    rec = held(read_warc(spark, path).select(
        page_of(F.col("record_id")).alias("page_id"), "record_type", page_of(F.col("refers_to")).alias("refers_to"), "uri",
        F.octet_length("payload").cast("long").alias("own_bytes"), sha1_base32(F.col("payload")).alias("own_digest"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("stated")), "warc-records")
    source = rec.filter("record_type = 'response'").select(F.col("page_id").alias("refers_to"), F.col("own_digest").alias("stated"),
                                                           F.col("own_bytes").alias("far_bytes")).distinct()
    out = rec.filter("record_type = 'revisit'").join(source, ["refers_to", "stated"], "left").select(
        "page_id", F.col("far_bytes").alias("payload_bytes"), F.col("stated").alias("payload_digest"), "record_type", "refers_to", "uri")
    own = rec.filter("record_type = 'response'").select(
        "page_id", F.col("own_bytes").alias("payload_bytes"), F.col("own_digest").alias("payload_digest"), "record_type", "refers_to", "uri")
    return own.unionByName(out)
