"""Scalar column functions re-expressing the reference's per-row helpers.

All of them compose built-in ``pyspark.sql.functions`` so that Catalyst can
fold, prune and push them down, and whole-stage codegen compiles them.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.schema import TIME_FORMAT

# Fixed value: characters kept in a number plate (everything else is removed).
PLATE_STRIP_PATTERN = "[^a-zA-Z0-9]"

def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_plate(c: str | Column) -> Column:
    """Delete every character that is not an ASCII letter or digit.

    Null stays null; a plate made only of symbols becomes the empty string.
    """
    return F.regexp_replace(_c(c), PLATE_STRIP_PATTERN, "")


def blank_to_zero(c: str | Column, dtype: str = "int") -> Column:
    """Typed value with blank (null or empty text) read as zero.

    Text input goes through ``try_cast`` so that one bad cell does not abort
    the whole job; typed input is just ``coalesce(c, 0)``.
    """
    col = _c(c)
    zero = F.lit(0).cast(dtype)
    return F.coalesce(col.try_cast(dtype), zero)


def text_blank_to_zero(c: str | Column, dtype: str = "int") -> Column:
    """P3 on raw text cells: '' and null are zero, else the parsed value."""
    col = _c(c)
    return F.coalesce(F.nullif(F.trim(col), F.lit("")).try_cast(dtype), F.lit(0).cast(dtype))


def epoch_seconds(c: str | Column) -> Column:
    """Whole seconds since the epoch (floored) of a zone-less timestamp, read
    as UTC wall clock; for a zone-aware timestamp, of the instant.

    ``CAST(timestamp_ntz AS BIGINT)`` is not allowed, and ``timestamp_diff``
    routes zone-less values through the session time zone (a wall-clock time
    inside a daylight-saving gap moves by an hour); ``unix_timestamp`` on a
    zone-less value does not.
    """
    return F.unix_timestamp(_c(c))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """P7a core: whole-second difference ``floor(end) - floor(start)``."""
    return epoch_seconds(end) - epoch_seconds(start)


def format_time(c: str | Column) -> Column:
    """P10: timestamp to ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(_c(c), TIME_FORMAT)


def parse_time_literal(value: str | datetime) -> Column:
    """P10/F7 for a parameter: validate in Python, then a zone-less literal.

    A parameter is a scalar, so it is parsed once on the driver; Catalyst
    folds the cast and the bound reaches the scan as a pushed filter.
    """
    if isinstance(value, datetime):
        dt = value
    else:
        dt = datetime.strptime(str(value), "%Y-%m-%d %H:%M:%S")
    return F.lit(dt.strftime("%Y-%m-%d %H:%M:%S")).cast(T.TimestampNTZType())


def same_day(a: str | Column, b: str | Column) -> Column:
    """F8: both instants fall on the same calendar day."""
    return F.to_date(_c(a)) == F.to_date(_c(b))


def text_of(c: str | Column, dtype: T.DataType) -> Column:
    """How a cell prints as text, lower-cased.

    Doubles between 1e-4 and 1e16 print in plain decimals, whole ones as
    ``<integer>.0`` (Spark would switch to an exponent below 1e-3 and from 1e7 on);
    other values use Spark's own rendering.
    """
    col = _c(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        size = F.abs(col)
        whole = (col == F.floor(col)) & (size < F.lit(1e16))
        plain = (size >= F.lit(1e-4)) & (size < F.lit(1e16))
        # the shortest digits as Spark prints them, without the exponent
        decimal = F.regexp_replace(col.cast("string").try_cast("decimal(38,21)").cast("string"), "0+$", "")
        rendered = F.when(whole, F.concat(col.cast("bigint").cast("string"), F.lit(".0"))) \
            .when(plain, decimal).otherwise(col.cast("string"))
        return F.lower(rendered)
    return F.lower(col.cast("string"))


def row_text(schema: T.StructType, columns: list[str] | None = None) -> list[Column]:
    """P16 for a whole row: one lower-cased text per column."""
    names = columns or [f.name for f in schema.fields]
    types = {f.name: f.dataType for f in schema.fields}
    return [text_of(n, types[n]) for n in names]


def any_column_contains(schema: T.StructType, term: str | None,
                        columns: list[str] | None = None) -> Column:
    """case-insensitive literal substring search across columns.

    An empty or missing term keeps every row. The term is literal text
    (``contains``), so ``.`` and ``%`` have no special meaning.
    """
    if not term:
        return F.lit(True)
    needle = F.lit(term.lower())
    tests = [F.coalesce(t.contains(needle), F.lit(False)) for t in row_text(schema, columns)]
    return reduce(lambda a, b: a | b, tests)
