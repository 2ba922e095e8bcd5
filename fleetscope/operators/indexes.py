"""Stored indexes for the behaviour table's service: substring search (F3) and deep pages (L1).

Both are tables in the shared scratch folder, built once for many requests. A request reads
the files that its filter names and no others: postings are sorted by trigram, so Parquet's
bounds rule files out; pages are cut into ranges, one folder each, so the partition filter does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.functions.expr import any_column_contains, text_of
from fleetscope.session import scratch_path

#: Letters of an indexed piece of text.
GRAM = 3


@dataclass
class TextIndex:
    """Rows with a number, the numbers by trigram, and how many rows each trigram has."""

    rows: DataFrame
    postings: DataFrame
    sizes: DataFrame
    columns: list[str]


def _row_texts(table: DataFrame) -> F.Column:
    """The lower-case text of each column, as the search compares it."""
    return F.array(*[F.coalesce(F.lower(text_of(f.name, f.dataType)), F.lit("")) for f in table.schema.fields])


def build_text_index(table: DataFrame, buckets: int | None = None) -> TextIndex:
    """Index every column's text by its trigrams. ``buckets``: files of postings and of rows (default: shuffle partitions)."""
    spark = table.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = scratch_path(spark, "text-rows")
    table.withColumn("_row", F.monotonically_increasing_id()).write.parquet(at)  # numbers that stay
    numbered = spark.read.parquet(at)
    grams = F.transform(_row_texts(table), lambda t: F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length(t) - (GRAM - 1))), lambda i: F.substr(t, i, F.lit(GRAM))))
    pairs = numbered.select("_row", F.explode(F.array_distinct(F.flatten(grams))).alias("gram")).filter(F.char_length("gram") == GRAM)
    held, sizes = scratch_path(spark, "text-postings"), scratch_path(spark, "text-sizes")
    # sorted by trigram and row: a frequent trigram spreads over files, and no task holds its whole list
    pairs.repartitionByRange(n, "gram", "_row").sortWithinPartitions("gram", "_row").write.parquet(held)
    postings = spark.read.parquet(held)
    postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).write.parquet(sizes)
    rows = scratch_path(spark, "text-table")
    numbered.repartitionByRange(n, "_row").sortWithinPartitions("_row").write.parquet(rows)
    return TextIndex(spark.read.parquet(rows), postings, spark.read.parquet(sizes), table.columns)


def search_index(index: TextIndex, term: str | None, rarest: int = 3) -> DataFrame:
    """the rows of ``search`` for the same term. Terms of three letters or more are looked up by their ``rarest``
    trigrams, and the rows found are compared in full; shorter ones are in no posting list and scan the rows."""
    text = (term or "").lower()
    rows = index.rows
    hit = any_column_contains(rows.select(*index.columns).schema, term)
    if len(text) < GRAM:
        return rows.filter(hit).select(*index.columns)
    grams = sorted({text[i:i + GRAM] for i in range(len(text) - GRAM + 1)})
    sizes = {r["gram"]: r["n"] for r in index.sizes.filter(F.col("gram").isin(grams)).collect()}  # a row per trigram of the term
    if len(sizes) < len(grams):
        return rows.filter(F.lit(False)).select(*index.columns)
    few = sorted(grams, key=lambda g: (sizes[g], g))[:rarest]
    found = index.postings.filter(F.col("gram").isin(few)).groupBy("_row").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(few))
    return rows.join(found.select("_row"), "_row", "left_semi").filter(hit).select(*index.columns)


@dataclass
class PageIndex:
    """A table in ranges of its order, with the rows of each range."""

    path: str
    counts: list[int]
    order: list[str]
    columns: list[str]
    table: DataFrame


def build_page_index(table: DataFrame, order: list[str], rows_per_range: int = 1_000_000) -> PageIndex:
    """Cut ``table`` into ranges of about ``rows_per_range`` rows in ``order`` (then by all other columns, so that no two
    pages overlap); the driver keeps one number per range."""
    spark = table.sparkSession
    order = [*order, *(c for c in table.columns if c not in order)]
    n = max(1, -(-table.count() // rows_per_range))
    path = scratch_path(spark, "page-ranges")
    (table.repartitionByRange(n, *order).withColumn("range_no", F.spark_partition_id())
     .write.partitionBy("range_no").parquet(path))
    stored = spark.read.schema(T.StructType([*table.schema.fields, T.StructField("range_no", T.IntegerType())])).parquet(path)
    counts = {r["range_no"]: r["count"] for r in stored.groupBy("range_no").count().collect()}
    return PageIndex(path, [counts.get(i, 0) for i in range(max(counts, default=-1) + 1)], order, table.columns, stored)


def ranges_of(index: PageIndex, start: int, length: int) -> tuple[list[int], int]:
    """(the ranges that rows ``[start, start + length)`` lie in, rows to pass over in the first of them)."""
    found, passed, skip = [], 0, 0
    for i, n in enumerate(index.counts):
        if n and passed < start + length and passed + n > start:
            skip = max(0, start - passed) if not found else skip
            found.append(i)
        passed += n
    return found, skip


def indexed_page(index: PageIndex, start: int, length: int) -> DataFrame:
    """L1: rows ``[start, start + length)`` of the order, from the ranges they lie in."""
    found, skip = ranges_of(index, start, length)
    rows = index.table.filter(F.col("range_no").isin(found) if found else F.lit(False)).select(*index.columns)
    return rows.orderBy(*index.order).offset(skip).limit(length)
