"""JSON messages in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackflow.functions.numbers import three_to_two_decimals
from trackflow.schema import RAW_MESSAGE

CORRUPT = "_corrupt"


def event_text(event_s: Column) -> Column:
    return F.date_format(F.timestamp_seconds(event_s), "yyyy-MM-dd HH:mm:ss")


def event_seconds(text: Column) -> Column:
    """Whole seconds of a timestamp string; null where it does not parse."""
    return F.unix_seconds(F.try_to_timestamp(text))


def parse_json(value: Column, schema: T.StructType) -> Column:
    """Struct of the message; null fields where the text is empty or not JSON."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(value, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})


def parse_messages(
    raw: DataFrame, schema: T.StructType = RAW_MESSAGE, received_ms: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejects): one parse, split by whether the text was valid JSON."""
    rest = [c for c in raw.columns if c != "value"]
    parsed = raw.withColumn("_m", parse_json(F.col("value"), schema))
    broken = F.col("_m").isNull() | F.col(f"_m.{CORRUPT}").isNotNull()
    clock = received_ms if received_ms is not None else F.unix_millis(F.current_timestamp())
    rows = parsed.where(~broken).select(
        *rest, *[F.col(f"_m.{f.name}") for f in schema.fields], clock.alias("received_at_utc_ms")
    )
    return rows, parsed.where(broken).select(*rest, "value")


def raw_messages(cleaned: DataFrame, time_text: Column) -> DataFrame:
    """Outgoing raw message: key is the taxi id, value the JSON text."""
    value = F.to_json(
        F.struct(
            "taxi_id", time_text.alias("timestamp"), "longitude", "latitude", "trip_status",
            "sent_at_utc_ms",
        )
    )
    return cleaned.select(
        F.col("taxi_id").cast("string").alias("key"), value.alias("value"),
        *[c for c in ("seq",) if c in cleaned.columns],
    )


def processed_columns(processed: DataFrame) -> DataFrame:
    """The processed message's fields, metrics with two decimals."""
    return processed.select(
        "taxi_id", "longitude", "latitude", event_text(F.col("event_s")).alias("timestamp"),
        "sent_at_utc_ms", "trip_status",
        F.round("speed", 2).alias("speed"),
        "is_valid_speed",
        F.round("avg_speed", 2).alias("avg_speed"),
        three_to_two_decimals(F.col("total_distance_km")).alias("total_distance_km"),
        F.round("distance_from_forbidden_city_km", 2).alias("distance_from_forbidden_city_km"),
        "is_in_range", "processed_at_utc_ms",
        *[c for c in ("received_at_utc_ms",) if c in processed.columns],
    )


def _texts(fields: DataFrame, key: Column) -> DataFrame:
    return fields.select(key.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def processed_messages(processed: DataFrame) -> DataFrame:
    return _texts(processed_columns(processed), F.col("taxi_id"))


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alert events; the field of the other kind of alert is absent from the text."""
    fields = alerts.select(
        "taxi_id", "latitude", "longitude", event_text(F.col("event_s")).alias("timestamp"),
        "trip_status", "distance_km", "speed", "alert_type",
    )
    return _texts(fields, F.col("taxi_id"))


def fleet_messages(nested: DataFrame) -> DataFrame:
    """Fleet events from the nested rows."""
    return _texts(nested.drop("seq"), F.lit("fleet"))


def complete_fleet_messages(parsed: DataFrame) -> DataFrame:
    """Fleet events that may become the current state."""
    return parsed.where(F.col("active_taxis").isNotNull() & F.col("trip_ended_taxis").isNotNull())
