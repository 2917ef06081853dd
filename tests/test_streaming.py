"""Streams give the rows of their batch forms, over several micro-batches and restarts."""

import time

import pytest
from helpers import PING, random_pings
from pyspark.sql import functions as F

from trackflow.config import Settings
from trackflow.operators import alerts, fleet, inactivity, state
from trackflow.plans.chain import moving, ordered_pings, process
from trackflow.functions import messages as messages_fn
from trackflow.schema import FLEET_MESSAGE, LONG, TEXT, row
from trackflow.sources import streams, tables
from trackflow.streaming import inactivity as watch
from trackflow.streaming import pipeline


@pytest.fixture(scope="module")
def rows(spark):
    pipeline.use_rocksdb(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark.createDataFrame(random_pings(600, 11), PING).cache()
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def feed(rows, path, parts, first=0, last=None):
    """One file per part, in arrival order; rows inside a file are shuffled."""
    bounds = [rows.agg(F.max("seq")).first()[0] * i // parts for i in range(parts)] + [None]
    for i in range(first, parts if last is None else last):
        part = rows.where(F.col("seq") > bounds[i]) if i else rows.where(F.col("seq") >= 0)
        if bounds[i + 1] is not None:
            part = part.where(F.col("seq") <= bounds[i + 1])
        part.orderBy(F.xxhash64("seq")).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.05)  # file order is by modification time


def same(got, want):
    names = sorted(want.columns)
    assert set(names) <= set(got.columns)
    got, want = got.select(*names), want.select(*names)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def take(spark, rows, path, out, **kwargs):
    source = streams.file_stream(spark, path, rows.schema, files_per_trigger=1)
    pipeline.start(source, out, every=None, **kwargs).awaitTermination()


def take_in_two_runs(spark, rows, path, out, batches, **kwargs):
    feed(rows, path, batches, 0, -(-batches // 2))
    take(spark, rows, path, out, **kwargs)
    if batches > 1:
        feed(rows, path, batches, -(-batches // 2))
        take(spark, rows, path, out, **kwargs)  # goes on from the checkpoint


@pytest.mark.parametrize(("batches", "cfg"), [(1, Settings()), (3, Settings(max_group_rows=40)), (8, Settings())])
def test_pipeline_equals_batch_with_restart(spark, rows, tmp_path, batches, cfg):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    take_in_two_runs(spark, rows, path, out, batches, cfg=cfg)
    want = process(rows).cache()
    same(tables.read_batches(spark, f"{out}/processed"), want)
    same(tables.read_log(spark, f"{out}/incidents"), alerts.incident_log(alerts.all_alerts(want)))
    same(tables.read_latest(spark, f"{out}/latest"), state.latest_per_taxi(want))
    same(tables.read_batches(spark, f"{out}/fleet"), fleet.fleet_rows(moving(ordered_pings(rows))))


def test_published_messages(spark, rows, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    some = rows.where("seq < 300")
    feed(some, path, 1)
    cfg = Settings(source_topics="raw", processed_topic="done", alerts_topic="alerts", fleet_topic="fleet")

    def publish(messages, topic, batch_id):
        tables.write_batch(messages, f"{out}/{topic}_topic", batch_id)

    with pytest.raises(ValueError):
        pipeline.PipelineSink(out, Settings(), publish=publish)
    source = streams.file_stream(spark, path, rows.schema)
    pipeline.start(source, out, cfg, every=None, publish=publish).awaitTermination()
    want = process(some).cache()
    done = tables.read_batches(spark, f"{out}/done_topic")
    assert done.count() == want.count()
    raised = tables.read_batches(spark, f"{out}/alerts_topic").collect()
    assert len(raised) == alerts.all_alerts(want).count()
    assert all(('"speed":' in r.value) != ('"distance_km":' in r.value) for r in raised)
    parsed = tables.read_batches(spark, f"{out}/fleet_topic").select(
        messages_fn.parse_json(F.col("value"), FLEET_MESSAGE).alias("m")).select("m.*")
    assert messages_fn.complete_fleet_messages(parsed).count() == want.count()
    assert parsed.agg(F.max("total_distance.distance")).first()[0] > 0


def test_repeated_batch_replaces_its_files(spark, tmp_path):
    for value in (1, 2):
        tables.write_batch(spark.createDataFrame([(value,)], "v int"), str(tmp_path / "t"), 0)
    assert [r.v for r in tables.read_batches(spark, str(tmp_path / "t")).collect()] == [2]


def test_from_messages(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, '{"taxi_id":1,"timestamp":"2008-02-02 15:00:00","longitude":116.4,"latitude":39.9,"trip_status":"active","sent_at_utc_ms":1}'),
         (2, "broken"),
         (3, '{"taxi_id":1,"timestamp":"2008-02-02 15:01:00","longitude":116.4,"latitude":39.91,"trip_status":"active","sent_at_utc_ms":2}')],
        row(seq=LONG, value=TEXT))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = streams.file_stream(spark, str(tmp_path / "in"), rows.schema)
    pipeline.start(pipeline.pings_from_messages(source), str(tmp_path / "out"), every=None).awaitTermination()
    got = tables.read_batches(spark, str(tmp_path / "out" / "processed")).orderBy("seq").collect()
    assert [(r.seq, r.speed) for r in got] == [(1, 0.0), (3, 66.72)]
    assert got[1].speed_alert


def test_job_from_messages(spark, tmp_path):
    """Rejects, carried receiving times, the clock at the chain's end, points read by time."""
    text = '{"taxi_id":1,"timestamp":"2008-02-02 15:0%d:00","longitude":116.4,"latitude":39.9,"trip_status":"active","sent_at_utc_ms":1}'
    rows = spark.createDataFrame([(1, text % 0), (2, "broken"), (3, text % 1), (4, "")], row(seq=LONG, value=TEXT))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = streams.file_stream(spark, str(tmp_path / "in"), rows.schema)
    out, before = str(tmp_path / "out"), pipeline.wall_clock_ms()
    for job in pipeline.start_from_messages(source, out, every=None):
        job.awaitTermination()
    got = tables.read_batches(spark, f"{out}/processed").orderBy("seq").collect()
    assert [r.seq for r in got] == [1, 3]
    assert all(before <= r.received_at_utc_ms <= r.processed_at_utc_ms <= pipeline.wall_clock_ms() for r in got)
    assert [(r.seq, r.value) for r in spark.read.parquet(f"{out}/rejects").orderBy("seq").collect()] == [(2, "broken"), (4, "")]
    points = tables.read_points(spark, f"{out}/points/taxi_metrics", before)
    assert points.count() == 2 and tables.read_points(spark, f"{out}/points/taxi_metrics", stop_ms=before).count() == 0


def test_silence_timers_equal_batch(spark, rows, tmp_path):
    # Timers go by event time, so this input has no late rows.
    on_time = rows.where("event_s is not null").withColumn("event_s", F.lit(1_201_910_400) + F.col("seq") * 7)
    feed(on_time, str(tmp_path / "in"), 3)
    source = streams.file_stream(spark, str(tmp_path / "in"), on_time.schema, files_per_trigger=1)
    stream = watch.inactive_stream(source, Settings(inactivity_timeout_s=60))
    streams.sink(stream, str(tmp_path / "cp"), every=None, path=str(tmp_path / "out")).start().awaitTermination()
    want = inactivity.inactive_trips(ordered_pings(on_time), Settings(inactivity_timeout_s=60))
    same(spark.read.parquet(str(tmp_path / "out")), want.select(*watch.NAMES))


def test_kafka_options():
    assert streams.topic_list(" a, b ,,c ") == ["a", "b", "c"]
    with pytest.raises(ValueError):
        streams.topic_list(" , ")
