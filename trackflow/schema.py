"""Row types of the pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, DOUBLE, TEXT, FLAG = (
    T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
)


def row(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names and types of every message.
RAW_CSV = row(taxi_id=INT, timestamp=TEXT, longitude=DOUBLE, latitude=DOUBLE)
RAW_MESSAGE = row(
    taxi_id=INT, timestamp=TEXT, longitude=DOUBLE, latitude=DOUBLE, trip_status=TEXT,
    sent_at_utc_ms=LONG,
)
RECORD = row(
    taxi_id=INT, longitude=DOUBLE, latitude=DOUBLE, timestamp=TEXT, sent_at_utc_ms=LONG,
    trip_status=TEXT, received_at_utc_ms=LONG, speed=DOUBLE, is_valid_speed=FLAG, avg_speed=DOUBLE,
    total_distance_km=DOUBLE, distance_from_forbidden_city_km=DOUBLE, is_in_range=FLAG,
)
PROCESSED_MESSAGE = T.StructType([*RECORD.fields, T.StructField("processed_at_utc_ms", LONG)])
ALERT_MESSAGE = row(
    taxi_id=INT, latitude=DOUBLE, longitude=DOUBLE, timestamp=TEXT, trip_status=TEXT,
    distance_km=DOUBLE, speed=DOUBLE, alert_type=TEXT,
)
_COUNT = row(count=LONG, change_from_last_hour=DOUBLE)
FLEET_MESSAGE = row(
    active_taxis=_COUNT, inactive_taxis=_COUNT, trip_ended_taxis=_COUNT,
    total_distance=row(distance=DOUBLE, change_from_last_hour=DOUBLE), in_transit_taxis=_COUNT,
)
