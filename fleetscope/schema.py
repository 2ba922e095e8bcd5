"""The telemetry fact table and the fixed names the results must carry."""

from __future__ import annotations

from pyspark.sql import types as T

# Positional field names of a raw telemetry record, in file order.
FIELD_NAMES = [
    "driverID",
    "carPlateNumber",
    "Latitude",
    "Longitude",
    "Speed",
    "Direction",
    "siteName",
    "Time",
    "isRapidlySpeedup",
    "isRapidlySlowdown",
    "isNeutralSlide",
    "isNeutralSlideFinished",
    "neutralSlideTime",
    "isOverspeed",
    "isOverspeedFinished",
    "overspeedTime",
    "isFatigueDriving",
    "isHthrottleStop",
    "isOilLeak",
]

_TYPES = {
    "driverID": T.StringType(),
    "carPlateNumber": T.StringType(),
    "Latitude": T.DoubleType(),
    "Longitude": T.DoubleType(),
    "Speed": T.DoubleType(),
    "Direction": T.IntegerType(),
    "siteName": T.StringType(),
    "Time": T.TimestampNTZType(),
    "neutralSlideTime": T.DoubleType(),
    "overspeedTime": T.DoubleType(),
}

# Explicit schema, no inference: flags stay nullable ints, blanks read as null.
TELEMETRY = T.StructType([
    T.StructField(name, _TYPES.get(name, T.IntegerType()), True) for name in FIELD_NAMES
])

# The eleven per-driver summary measures, in matrix order.
MEASURES = [
    "total_rapid_accelerations",
    "total_rapid_decelerations",
    "total_neutral_slide",
    "total_neutral_slide_duration",
    "total_overspeed",
    "total_overspeed_duration",
    "total_fatigue_driving",
    "total_hthrottle_stop",
    "total_oil_leak",
    "average_speed",
    "total_distance",
]

# Regression inputs and label.
REGRESSION_FEATURES = [
    "total_neutral_slide",
    "total_neutral_slide_duration",
    "total_overspeed",
    "total_overspeed_duration",
    "total_fatigue_driving",
    "total_hthrottle_stop",
    "total_oil_leak",
]
REGRESSION_LABEL = "average_speed"

# Fixed value: the board's overspeed warning text (plate, count, speed in km/h).
WARNING_FORMAT = "Warning: Driver %s is speeding (%d times) (%s km/h)"

# Default replay start and slice length of the live board.
DEFAULT_START = "2017-01-01 08:00:05"
SLICE_SECONDS = 30
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
