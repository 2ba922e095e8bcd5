"""Per-plate behaviour table and its search/paging service.

A1 is one hash aggregate with map-side partial aggregation, so a plate that
holds a large share of all rows is pre-summed in every input task before the
shuffle; the shuffle carries at most one row per plate per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.expr import any_column_contains, blank_to_zero

BEHAVIOUR_COLUMNS = ["carPlateNumber", "overspeed_count", "fatigue_driving_count",
                     "overspeed_time", "neutral_slide_time"]


def behaviour_by_plate(telemetry: DataFrame) -> DataFrame:
    """A1: per plate, totals of finished overspeed episodes, fatigue flags,
    overspeed seconds and neutral-slide seconds; blank cells count as zero.

    ``overspeed_count`` here counts *finished* episodes (isOverspeedFinished);
    the live board's ``overspeed_count`` counts overspeed *records* instead.
    """
    return telemetry.groupBy("carPlateNumber").agg(
        F.sum(blank_to_zero("isOverspeedFinished", "int")).alias("overspeed_count"),
        F.sum(blank_to_zero("isFatigueDriving", "int")).alias("fatigue_driving_count"),
        F.sum(blank_to_zero("overspeedTime", "double")).alias("overspeed_time"),
        F.sum(blank_to_zero("neutralSlideTime", "double")).alias("neutral_slide_time"),
    )


def search(table: DataFrame, term: str | None) -> DataFrame:
    """rows where any column's text contains ``term`` (case-insensitive)."""
    return table.filter(any_column_contains(table.schema, term))


def page(table: DataFrame, start: int, length: int, order: list[str] | None = None) -> DataFrame:
    """L1: rows ``[start, start+length)`` in a total order; negative length = all.

    The order defaults to every column, so ties cannot make pages overlap.
    Spark plans offset+limit as a top-k (TakeOrderedAndProject) when the
    page is small, so no full sort is shuffled to one task.
    """
    cols = order or table.columns
    ordered = table.orderBy(*cols)
    if start > 0 and (length is None or length < 0):
        # all rows but the first few: offset() alone would gather the sorted table in one task
        return table.exceptAll(ordered.limit(start)).orderBy(*cols)
    if start > 0:
        ordered = ordered.offset(start)
    if length is not None and length >= 0:
        ordered = ordered.limit(length)
    return ordered


def search_page(table: DataFrame, term: str | None, start: int, length: int) -> DataFrame:
    """F3 + L1: one page of the search result."""
    return page(search(table, term), start, length)


def search_totals(table: DataFrame, term: str | None) -> DataFrame:
    """A10: ``recordsTotal`` and ``recordsFiltered`` in one pass."""
    hit = any_column_contains(table.schema, term)
    return table.agg(
        F.count(F.lit(1)).alias("recordsTotal"),
        F.count_if(hit).alias("recordsFiltered"),
    )
