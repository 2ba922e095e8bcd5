"""Small hand-made telemetry literals for edge cases."""

from datetime import datetime

from pyspark.sql import types as T

from fleetscope.schema import FIELD_NAMES, TELEMETRY

SCHEMA = T.StructType([T.StructField("event_id", T.LongType(), True)] + TELEMETRY.fields)


def ts(s: str) -> datetime:
    return datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


def record(event_id, driver="d1", plate="AZ1", speed=50, time="2017-01-01 08:00:05", **kw):
    base = {n: None for n in FIELD_NAMES}
    base.update(driverID=driver, carPlateNumber=plate, Speed=float(speed), Time=ts(time),
                Latitude=30.0, Longitude=110.0, Direction=0, siteName="s")
    base.update(kw)
    return (event_id, *[base[n] for n in FIELD_NAMES])


def frame(spark, records):
    return spark.createDataFrame(records, SCHEMA)
