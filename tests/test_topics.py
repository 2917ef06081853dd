"""Topics as logs: offsets, flush by size or by time, three sinks, restart, replay after failures."""

import time

import pytest
from helpers import PING, random_pings
from pyspark.sql import functions as F
from test_streaming import same

from trackflow.config import Settings
from trackflow.functions import messages as messages_fn
from trackflow.operators import alerts
from trackflow.plans.chain import process
from trackflow.sources import streams, tables, topiclog
from trackflow.streaming import arrival, pipeline

CFG = Settings(source_topics="raw", processed_topic="done", alerts_topic="alerts", fleet_topic="fleet")


def texts(spark, rows):
    return spark.createDataFrame(rows, "key string, value string")


def test_log(spark, tmp_path):
    path = str(tmp_path)
    topiclog.append_to_topic(texts(spark, [("a", "1"), ("b", None), (None, "é\n")]).coalesce(1), path, "t", 3)
    topiclog.append_to_topic(texts(spark, [("a", "2")]), path, "t", 3, batch=7)
    topiclog.append_to_topic(texts(spark, [("a", "2")]), path, "t", 3, batch=7)  # the same batch again
    rows = topiclog.read_topic(spark, path, "t").collect()
    assert sorted((r.key or "", r.value or "") for r in rows) == [("", "é\n"), ("a", "1"), ("a", "2"), ("b", "")]
    of_a = sorted((r.offset, r.value) for r in rows if r.key == "a")
    assert [v for _, v in of_a] == ["1", "2"] and of_a[0][0] < of_a[1][0]
    assert not list((tmp_path / topiclog.ASIDE).iterdir())
    assert topiclog.read_topic(spark, path, "none").count() == 0


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path)
    bad = texts(spark, [("a", "1")]).withColumn("value", F.when(F.rand() < 2, F.raise_error("no")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="no"):
        topiclog.append_to_topic(bad, path, "t")
    assert topiclog.read_topic(spark, path, "t").count() == 0


def test_flush_by_size_or_time(spark, tmp_path):
    path, seen = str(tmp_path / "log"), []
    topiclog.append_to_topic(texts(spark, [("a", "0")]), path, "t")
    stream = topiclog.topic_stream(spark, path, "t", flush_rows=10, flush_seconds=12)
    writer = stream.writeStream.foreachBatch(lambda df, i: seen.append((time.monotonic(), df.count())))
    query = writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="100 milliseconds").start()

    def wait(n):
        limit = time.monotonic() + 60
        while sum(c for _, c in seen) < n and time.monotonic() < limit:
            time.sleep(0.1)
        assert sum(c for _, c in seen) == n

    try:
        wait(1)
        topiclog.append_to_topic(texts(spark, [("a", str(i)) for i in range(3)]), path, "t")
        began = time.monotonic()
        wait(4)  # too few: closed by time
        assert seen[-1][0] - began > 9 and seen[-1][1] == 3
        began = time.monotonic()
        topiclog.append_to_topic(texts(spark, [("a", str(i)) for i in range(10)]), path, "t")
        wait(14)  # enough: closed at once
        assert seen[-1][0] - began < 10
    finally:
        query.stop()


def raw_texts(spark, rows):
    text = messages_fn.raw_messages(rows, messages_fn.event_text(F.col("event_s")))
    return text.select("key", "value")


def test_job_from_topic_to_topics(spark, tmp_path):
    """Two partitions in, three topics out, over a restart and a failed batch: nothing lost, repeats told by id."""
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    rows = spark.createDataFrame(random_pings(200, 3), PING).where("event_s is not null")
    parts = [rows.where("seq < 300"), rows.where("seq >= 300")]
    cfg = Settings(**{**CFG.__dict__, "source_partitions": 2})
    publish, failures = topiclog.topic_publisher(path), [1]

    def failing(messages, topic, batch_id):
        publish(messages, topic, batch_id)
        if topic == "alerts" and batch_id == 1 and failures:
            failures.pop()
            raise RuntimeError("broker away")

    def source():
        raw = topiclog.topic_stream(spark, path, "raw").withColumn("seq", F.col("offset"))
        return pipeline.pings_from_messages(raw.drop("key"))

    topiclog.append_to_topic(raw_texts(spark, parts[0]), path, "raw", 2)
    pipeline.start(source(), out, cfg, every=None, publish=failing).awaitTermination()
    topiclog.append_to_topic(raw_texts(spark, parts[1]), path, "raw", 2)
    with pytest.raises(Exception, match="broker away"):
        pipeline.start(source(), out, cfg, every=None, publish=failing).awaitTermination()
    pipeline.take_all(source(), out, cfg, publish=failing)
    sent = topiclog.read_topic(spark, path, "raw").withColumn("seq", F.col("offset"))
    pings = arrival.in_arrival_order(pipeline.pings_from_messages(sent.drop("key")))
    want = process(pings.drop("topic", "partition", "offset")).cache()
    got = tables.read_batches(spark, f"{out}/processed")
    names = [c for c in want.columns if c not in ("processed_at_utc_ms", "received_at_utc_ms")]
    same(got.select(*[c for c in names if c in got.columns]), want.select(*[c for c in names if c in got.columns]))
    # Messages of a batch that was done again are appended once.
    assert topiclog.read_topic(spark, path, "done").count() == want.count()
    assert topiclog.read_topic(spark, path, "alerts").count() == alerts.all_alerts(want).count()
    assert topiclog.read_topic(spark, path, "fleet").count() == want.count()


def test_stream_sink_and_repeats(spark, tmp_path):
    """The log as a streaming sink; a consumer that drops repeats by id."""
    path = str(tmp_path / "log")
    rows = texts(spark, [(str(i % 4), f'{{"id": {i}}}') for i in range(40)])
    topiclog.append_to_topic(rows, path, "in", 2)
    topiclog.append_to_topic(rows.where("key = '1'"), path, "in", 2)  # sent twice
    for _ in range(2):
        stream = topiclog.topic_stream(spark, path, "in")
        once = stream.withColumn("id", F.get_json_object("value", "$.id")).dropDuplicates(["id"])
        writer = once.select("key", "value").writeStream.format(topiclog.FORMAT).option("path", path).option("topic", "once")
        writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert topiclog.read_topic(spark, path, "once").count() == 40


def test_kafka_flush_options():
    assert streams.flush_options(Settings(flush_rows=7, flush_s=3)) == {"minOffsetsPerTrigger": "7", "maxTriggerDelay": "3s"}
    assert Settings.from_env({"KAFKA_REDIS_CONSUMER_BATCH_SIZE_LIMIT": "9"}).flush_rows == 9
    with pytest.raises(ValueError):
        Settings(flush_rows=0)
