"""Telemetry from the test tables.

The test data ships no vehicle records, only an ``events`` table. This adapter
maps each event onto one telemetry record, fully in Spark expressions, so the
same rows can be rebuilt by an independent SQL engine. It is a narrow
projection of one parquet scan: no shuffle, and Catalyst prunes the scan to
the six event columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetscope.functions.expr import PLATE_STRIP_PATTERN
from fleetscope.schema import FIELD_NAMES
from fleetscope.session import table_path

# Fixed values of the adapter: event epoch, replay origin, folding step.
EVENTS_EPOCH = "2024-01-01 00:00:00"
REPLAY_ORIGIN = "2017-01-01 08:00:05"
FOLD_SECONDS = 300
DAY_SECONDS = 86400
DAYS = 10


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _adapter_sql(clean: bool) -> list[str]:
    """The adapter as SQL expressions over ``events`` (one parse per use)."""
    k = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
    slot = (f"FLOOR((unix_timestamp(CAST(ts AS TIMESTAMP_NTZ)) - "
            f"unix_timestamp(TIMESTAMP_NTZ'{EVENTS_EPOCH}')) / {FOLD_SECONDS})")
    plate = "concat('华-AZ ', lpad(CAST(FLOOR(user_id / 2) AS STRING), 5, '0'))"
    if clean:
        plate = f"regexp_replace({plate}, '{PLATE_STRIP_PATTERN}', '')"
    time = (f"timestampadd(SECOND, CAST((event_id % {DAYS}) * {DAY_SECONDS} + "
            f"CAST({slot} AS BIGINT) AS INT), TIMESTAMP_NTZ'{REPLAY_ORIGIN}')")
    cols = {
        "driverID": "concat('driver', lpad(CAST(user_id AS STRING), 6, '0'))",
        "carPlateNumber": plate,
        "Latitude": f"30.0D + {k} / 100.0D",
        "Longitude": "110.0D + (user_id % 100) / 100.0D",
        "Speed": "CAST(FLOOR(least(value, 160.0D)) AS INT)",
        "Direction": f"CAST(({k} * 3) % 360 AS INT)",
        "siteName": "concat('site ', CAST(user_id % 10 AS STRING))",
        "Time": time,
        "isRapidlySpeedup": "CASE WHEN event_type = 'click' THEN 1 END",
        "isRapidlySlowdown": "CASE WHEN event_type = 'view' THEN 1 END",
        "isNeutralSlide": "CASE WHEN event_type = 'signup' THEN 1 END",
        "isNeutralSlideFinished": f"CASE WHEN event_type = 'signup' AND {k} % 2 = 0 THEN 1 END",
        "neutralSlideTime":
            f"CASE WHEN event_type = 'signup' AND {k} % 2 = 0 THEN CAST({k} AS DOUBLE) END",
        "isOverspeed": "CASE WHEN value > 80 THEN 1 END",
        "isOverspeedFinished": "CASE WHEN value > 100 THEN 1 END",
        "overspeedTime": f"CASE WHEN value > 100 THEN CAST({k} AS DOUBLE) END",
        "isFatigueDriving": "CASE WHEN event_type = 'error' THEN 1 END",
        "isHthrottleStop": f"CASE WHEN event_type = 'purchase' AND {k} % 3 = 0 THEN 1 END",
        "isOilLeak": f"CASE WHEN event_type = 'purchase' AND {k} % 10 = 0 THEN 1 END",
    }
    return ["event_id"] + [f"{cols[n]} AS `{n}`" for n in FIELD_NAMES]


def events_to_telemetry(events: DataFrame, clean: bool = True) -> DataFrame:
    """Map ``events`` rows to telemetry rows (19 fields plus ``event_id``).

    ``event_id`` is kept as the tie-breaker for equal times of one driver.
    With ``clean`` the plate goes through P2 (as the cleaned table would).
    Written as SQL expressions: one parse, and Catalyst folds the repeated
    ``k`` extraction into one projection.
    """
    return events.selectExpr(*_adapter_sql(clean))


def load_telemetry(spark: SparkSession, sf_dir: str, clean: bool = True) -> DataFrame:
    """The telemetry fact table of a scale-factor folder (adapter over ``events``)."""
    return events_to_telemetry(read_table(spark, sf_dir, "events"), clean=clean)
