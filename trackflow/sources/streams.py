"""Streaming sources and sinks: Kafka topics, or files with the same options."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from trackflow.config import DEFAULTS, Settings


def topic_list(topics: str) -> list[str]:
    names = [t.strip() for t in topics.split(",") if t.strip()]
    if not names:
        raise ValueError("at least one topic is required")
    return names


def flush_options(cfg: Settings) -> dict[str, str]:
    """A micro-batch closes by size or by time."""
    return {"minOffsetsPerTrigger": str(cfg.flush_rows), "maxTriggerDelay": f"{cfg.flush_s}s"}


def kafka_stream(
    spark: SparkSession, servers: str, topics: str, group: str = "", max_per_trigger: int = 1_000_000,
    cfg: Settings = DEFAULTS,
) -> DataFrame:
    """Values of the topics from the earliest offset, with (topic, partition, offset).

    ``seq`` is the offset: the arrival order where there is one partition. Those of several get theirs
    from ``streaming.arrival``."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topic_list(topics)))
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_per_trigger)
        .options(**flush_options(cfg))
    )
    if group:
        reader = reader.option("groupIdPrefix", group)
    return reader.load().select(
        F.col("value").cast("string").alias("value"), "topic", "partition", "offset", F.col("offset").alias("seq")
    )


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet",
    pattern: str | None = None, files_per_trigger: int | None = 1000,
) -> DataFrame:
    reader = spark.readStream.format(kind).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def sink(
    stream: DataFrame, checkpoint: str, kind: str = "parquet", every: str | None = "1 second",
    **options: str,
) -> DataStreamWriter:
    """Append sink; without an interval it takes what is available and stops."""
    writer = stream.writeStream.format(kind).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).options(**options)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def batch_sink(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None],
    every: str | None = "1 second",
) -> DataStreamWriter:
    """Sink that hands each micro-batch to ``write`` once per attempt, with its id."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def as_kafka_values(messages: DataFrame) -> DataFrame:
    """Key and JSON value, as a Kafka sink expects them."""
    return messages.select("key", "value")
