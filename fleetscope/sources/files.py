"""File sources and sinks.

All scans are single multi-file scans with an explicit schema: no per-file
DataFrames, no schema inference pass. Sinks write under a caller-given path
(on a cluster: a shared filesystem).

CSV files are read as records of text cells (``records``), in splits: cleaning changes
the plate and nothing else, so fractional speeds, times in odd formats, ragged rows and
quoted line breaks all come out as they went in. Types are made only for the telemetry
table, with ``try_cast``; cells that do not parse are listed by ``rejected_cells``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.functions.expr import clean_plate, text_blank_to_zero
from fleetscope.schema import FIELD_NAMES, TELEMETRY, TIME_FORMAT
from fleetscope.sources.records import read_records

# Python's csv module quotes with '"' and doubles quotes inside a field.
CSV_OPTIONS = {"encoding": "UTF-8", "quote": '"', "escape": '"',
               "timestampNTZFormat": TIME_FORMAT, "timestampFormat": TIME_FORMAT}
#: Where ``write_cells`` puts one shard of an output: a folder named as the output, with shards named by the
#: byte of the input at which they begin.
_SHARD = r"/output=([^/]+)/shard=(\d+)/[^/]*$"


def input_name(file: Column, root: str) -> Column:
    """A file's path below ``root``."""
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    return F.substring_index(file, base, -1)


def read_cells(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(input, block, record, cells)``, the cells of every file below ``path`` as ``csv.reader`` gives them;
    nothing typed, padded or dropped. Files are read in splits; (block, record) is the order in a file."""
    return read_records(spark, path, glob).select(input_name(F.col("file"), path).alias("input"), "block", "record", "cells")


def input_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(input)``: every file below ``path`` that holds anything; no contents are read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return found.select(input_name(F.col("path"), path).alias("input"))


def clean_cells(cells: DataFrame) -> DataFrame:
    """P2 on field 1 of each record; every other cell, and the number of cells, unchanged."""
    return cells.withColumn("cells", F.transform("cells", lambda c, i: F.when(i == 1, clean_plate(c)).otherwise(c)))


def record_text(cells: Column) -> Column:
    """A record as ``csv.writer`` writes it: quotes only where a cell needs them."""
    quoted = F.transform(cells, lambda c: F.when(c.rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c))
    return F.when((F.size(cells) == 1) & (F.get(cells, F.lit(0)) == ""), F.lit('""')).otherwise(F.array_join(quoted, ","))


def write_cells(cells: DataFrame, path: str) -> None:
    """One output per input, a folder ``output=output_<input>.csv`` of shards, each from one block of the input.

    The shards' names sort as the blocks do, so that one after the other they are the whole output: the header line
    once, then the records in their order, ragged ones ragged. A task holds a block, never an input. A file of no bytes
    has no output, as Spark does not list it."""
    lines = cells.select("input", "block", "record", record_text(F.col("cells")).alias("value"))
    header = cells.select("input").distinct().select("input", F.lit(0).cast("long").alias("block"), F.lit(-1).cast("long").alias("record"), F.lit(",".join(FIELD_NAMES)).alias("value"))
    named = lines.unionByName(header).select(F.concat(F.lit("output_"), "input", F.lit(".csv")).alias("output"),
                                             F.lpad(F.col("block").cast("string"), 15, "0").alias("shard"), "record", "value")
    # sorted by the folders first, as the writer wants it, so that it keeps the order of records
    (named.repartition("output", "shard").sortWithinPartitions("output", "shard", "record").drop("record")
     .write.mode("overwrite").partitionBy("output", "shard").text(path))


def read_clean_cells(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S3: ``(input, shard, block, record, cells)`` of every output named ``*.csv`` below ``path``: single files and the
    sharded folders of ``write_cells``; the header is record 0 of block 0 of shard 0."""
    file = F.col("_metadata.file_path")
    found = read_records(spark, path, which=file.endswith(".csv") | (F.regexp_extract(file, _SHARD, 1).endswith(".csv")))
    folder = F.regexp_extract("file", _SHARD, 1)
    return found.select(F.when(folder == "", F.col("file")).otherwise(F.regexp_replace("file", _SHARD, "/output=$1")).alias("input"),
                        F.when(folder == "", F.lit(0)).otherwise(F.regexp_extract("file", _SHARD, 2).cast("long")).alias("shard"), "block", "record", "cells")


_HEADER = "shard = 0 AND block = 0 AND record = 0"


def data_cells(clean: DataFrame) -> DataFrame:
    """The records of ``read_clean_cells`` without the headers, by position."""
    return clean.filter(f"NOT ({_HEADER})")


def header_places(clean: DataFrame) -> DataFrame:
    """``(input, places)``, one row per input: where each of the 19 fields stands in its records (null: nowhere), then
    the places of its other columns. A header that names none of the fields counts as the fields in their order."""
    names = F.transform("cells", lambda c: F.trim(c))
    at = F.array(*[F.nullif(F.array_position(names, n), F.lit(0)).cast("int") - 1 for n in FIELD_NAMES])
    other = F.filter(F.sequence(F.lit(0), F.size(names) - 1), lambda i: ~F.array_contains(F.array(*[F.lit(n) for n in FIELD_NAMES]), F.get(names, i)))
    own = F.sequence(F.lit(0), F.greatest(F.size(names), F.lit(len(FIELD_NAMES))) - 1)
    known = F.arrays_overlap(names, F.array(*[F.lit(n) for n in FIELD_NAMES]))
    return clean.filter(_HEADER).select("input", F.size(names).alias("width"), F.when(known, F.concat(at, F.when(F.size(names) > 0, other).otherwise(F.array().cast("array<int>")))).otherwise(own).alias("places"))


def aligned_cells(clean: DataFrame) -> DataFrame:
    """S2 + U1: ``(input, shard, block, record, cells)`` of all outputs in one scan, every record's cells in the order of the
    19 fields whatever its file's header says (a missing column is null); other columns, and cells beyond the header,
    stand behind them. Empty lines are left out."""
    rows = data_cells(clean).filter(F.size("cells") > 0).join(header_places(clean), "input", "left")
    beyond = F.slice("cells", F.col("width") + 1, F.greatest(F.lit(0), F.size("cells") - F.col("width")))
    return rows.select("input", "shard", "block", "record", F.concat(F.transform("places", lambda i: F.get("cells", i)), beyond).alias("cells"))


def _typed_cell(i: int, f: T.StructField) -> Column:
    text = F.nullif(F.trim(F.get("cells", F.lit(i))), F.lit(""))
    if isinstance(f.dataType, T.StringType):
        return F.nullif(F.get("cells", F.lit(i)), F.lit(""))
    if isinstance(f.dataType, T.TimestampNTZType):
        return F.try_to_timestamp(text, F.lit(TIME_FORMAT)).cast("timestamp_ntz")
    return text.try_cast(f.dataType)


def typed_records(cells: DataFrame) -> DataFrame:
    """The 19 positional fields typed by the fixed schema; blank or unparsable cells
    are null, missing ones too, extra ones are left out (see ``rejected_cells``)."""
    return cells.select(*[_typed_cell(i, f).alias(f.name) for i, f in enumerate(TELEMETRY.fields)])


def rejected_cells(cells: DataFrame) -> DataFrame:
    """``(input, block, record, field, text)`` of cells that the typed table cannot hold: those
    that do not parse, and those beyond the 19th."""
    bad = F.array_compact(F.array(*[
        F.when((F.trim(F.get("cells", F.lit(i))) != "") & _typed_cell(i, f).isNull(), F.struct(F.lit(i).alias("field"), F.get("cells", F.lit(i)).alias("text")))
        for i, f in enumerate(TELEMETRY.fields) if not isinstance(f.dataType, T.StringType)]))
    extra = F.transform(F.slice("cells", F.lit(len(FIELD_NAMES) + 1), F.greatest(F.lit(0), F.size("cells") - len(FIELD_NAMES))),
                        lambda c, i: F.struct((i + len(FIELD_NAMES)).alias("field"), c.alias("text")))
    return cells.select("input", "block", "record", F.inline(F.concat(bad, extra)))


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """S1 + P1: headerless raw telemetry, every file below a folder, typed."""
    return typed_records(read_cells(spark, path))


def read_clean_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S2 + S3 + U1: all outputs named ``*.csv`` below a folder, typed by the fixed schema (no inference pass), each
    by its own header. No such output gives an empty table."""
    return typed_records(aligned_cells(read_clean_cells(spark, path)))


def read_rows_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S4 + P4: header CSVs read row-wise as text cells by position, each file's first record left out, ragged rows kept;
    ``n_fields`` counts the cells a row really has."""
    rows = data_cells(read_clean_cells(spark, path))
    return rows.select(*[F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(f) for i, f in enumerate(FIELD_NAMES)], F.size("cells").alias("n_fields"))


def text_measures(rows: DataFrame) -> DataFrame:
    """P3 + P4: the four behaviour measures from text cells.

    Blank is zero. A row without field 16 (16 fields or fewer) has all four
    measures zero even when some of them are present; the plate still counts.
    Rows without a plate field at all (fewer than 2 fields) are left out; see
    ``rejected_rows``.
    """
    rows = rows.filter(F.col("n_fields") >= 2)
    short = F.col("n_fields") <= 16
    m = {
        "isOverspeedFinished": text_blank_to_zero("isOverspeedFinished", "int"),
        "isFatigueDriving": text_blank_to_zero("isFatigueDriving", "int"),
        "overspeedTime": text_blank_to_zero("overspeedTime", "double"),
        "neutralSlideTime": text_blank_to_zero("neutralSlideTime", "double"),
    }
    zero = {"int": F.lit(0), "double": F.lit(0.0)}
    # A present but empty plate cell is the plate '' (the CSV reader gives null).
    return rows.select(
        F.coalesce(F.col("carPlateNumber"), F.lit("")).alias("carPlateNumber"),
        *[F.when(short, zero["int" if k.startswith("is") else "double"]).otherwise(v).alias(k)
          for k, v in m.items()])


def rejected_rows(rows: DataFrame) -> DataFrame:
    """Rows too short to carry a plate (fewer than 2 fields)."""
    return rows.filter(F.col("n_fields") < 2)


def clean_records(df: DataFrame) -> DataFrame:
    """P2 applied to field 1 only; every other cell unchanged."""
    return df.withColumn("carPlateNumber", clean_plate("carPlateNumber"))


def write_raw_csv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Raw form: headerless CSV of the 19 fields (one folder per source when
    ``partition_by`` names a source column)."""
    cols = FIELD_NAMES + ([partition_by] if partition_by else [])
    w = df.select(*cols).write.mode("overwrite").options(**CSV_OPTIONS).option("header", False)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)


def write_clean_csv(df: DataFrame, path: str) -> None:
    """Typed records as header CSV (one output per input: ``write_cells``)."""
    df.select(*FIELD_NAMES).write.mode("overwrite").options(**CSV_OPTIONS).option("header", True).csv(path)


def write_telemetry_table(df: DataFrame, path: str) -> None:
    """Default sink: parquet partitioned by record date, so date and time-range
    filters prune whole folders and push the rest into the scan."""
    (df.withColumn("event_date", F.to_date("Time"))
       .write.mode("overwrite").partitionBy("event_date").parquet(path))


def union_frames(frames: list[DataFrame], schema: T.StructType = TELEMETRY) -> DataFrame:
    """UNION ALL of frames that already exist; duplicates kept; no frames
    give an empty DataFrame of ``schema``. (Files are better read as one scan.)"""
    if not frames:
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b), frames)


def write_matrix_text(matrix: DataFrame, path: str, decimals: int = 6) -> None:
    """Matrix sink: whitespace-separated fixed-point text, one line per row.

    The matrix is measures x measures (121 cells), so it is written as one
    ordered file; missing cells print as ``nan``.
    """
    cell = F.when(F.col("corr").isNull() | F.isnan("corr"), F.lit("nan")) \
        .otherwise(F.format_string(f"%.{decimals}f", F.col("corr")))
    lines = matrix.groupBy("row_idx").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("col_idx", cell.alias("c")))),
                                 lambda x: x["c"]), " ").alias("value"))
    lines.orderBy("row_idx").coalesce(1).select("value").write.mode("overwrite").text(path)


def read_matrix_text(spark: SparkSession, path: str, labels: list[str] | None = None) -> DataFrame:
    """Whitespace-separated headerless numeric matrix, labelled by position.

    Read whole (a matrix file is tiny) so that line order gives the row index;
    CRLF and repeated blanks are tolerated; ``nan`` cells become null.
    """
    text = spark.read.text(path, wholetext=True)
    lines = text.select(F.posexplode(F.filter(F.split(F.col("value"), "\\R"),
                                              lambda s: F.trim(s) != "")).alias("row_idx", "line"))
    cells = lines.select("row_idx", F.posexplode(F.filter(F.split(F.trim("line"), "\\s+"),
                                                          lambda s: s != "")).alias("col_idx", "tok"))
    value = F.when(F.lower("tok") == "nan", F.lit(None)).otherwise(F.col("tok").try_cast("double"))
    out = cells.select("row_idx", "col_idx", value.alias("corr"))
    if labels:
        names = F.array(*[F.lit(x) for x in labels])
        out = out.select(F.element_at(names, F.col("row_idx") + 1).alias("row_measure"),
                         F.element_at(names, F.col("col_idx") + 1).alias("col_measure"),
                         "row_idx", "col_idx", "corr")
    return out


def to_json_lines(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """S7 + P14: each row as one JSON object, keys renamed (e.g. to snake_case)."""
    renames = renames or {}
    fields = [F.col(c).alias(renames.get(c, c)) for c in df.columns]
    return df.select(F.to_json(F.struct(*fields)).alias("value"))


def write_json_lines(df: DataFrame, path: str) -> None:
    """S7 batch sink: JSON lines."""
    df.write.mode("overwrite").text(path)


def schema_text(df: DataFrame) -> str:
    """The schema tree ``printSchema`` shows (metadata only, no job)."""
    return df.schema.treeString()


def preview(df: DataFrame, n: int = 3, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-k, not a sort)."""
    return df.orderBy(*(order or df.columns)).limit(n)
