"""Helpers shared by the corpus operators: tables, scratch tables, Arrow chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.session import scratch_path, ship_package

__all__ = ["CHUNK_BYTES", "SPACE_PATTERN", "WORD_PATTERN", "emptied", "held", "rows_of", "scratch_tables", "settled", "scratch_path",
           "ship_package", "table", "text_chunks", "words_in"]

#: A word is a run of bytes outside \x20 and \x09-\x0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"

#: Texts are handled in chunks of about so many bytes, whatever Arrow's batch size is;
#: a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Paths of the scratch tables written since the innermost ``scratch_tables`` of this thread began.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch_tables() -> Iterator[list[str]]:
    """The paths of the tables that ``held`` writes inside."""
    made: list[str] = []
    before = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(before)


def emptied(spark: SparkSession, paths: list[str]) -> None:
    """Remove the files of tables that are read no more; overwriting does so on any file system."""
    for path in paths:
        spark.createDataFrame([], "gone int").write.mode("overwrite").parquet(path)


def held(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written once as Parquet in the shared scratch folder and read back.

    Cuts the lineage and survives lost executors; later readers see the file
    sizes, so Catalyst picks joins by real sizes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    if (made := _MADE.get()) is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The result of ``make()``, held; the scratch tables it made on the way are emptied, also if it fails."""
    spark, kept = SparkSession.getActiveSession(), None
    with scratch_tables() as made:
        try:
            out = held(make(), name)
            spark, kept = out.sparkSession, made[-1]
        finally:
            emptied(spark, [p for p in made if p != kept])
    if (outer := _MADE.get()) is not None:
        outer.append(kept)
    return out


def words_in(text: Column) -> Column:
    """Number of words of a text; null and empty give 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow string column into (first, end, bytes, offsets) without copying.

    ``offsets`` has ``end - first + 1`` entries relative to ``bytes``. A null is an
    empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    n = len(texts)
    if n == 0:
        return
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def rows_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch of the given numpy columns or lists, cast to ``schema``."""
    return pa.RecordBatch.from_arrays(
        [x if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type) for f in schema], schema=schema)
