"""Tables that change while they are read, arrival order, complete windows, trends and log at rest."""

import pytest
from helpers import PING, random_pings
from pyspark.sql import functions as F
from test_streaming import feed, same, take

from trackflow.config import Settings
from trackflow.operators import alerts, fleet, points, state, trends
from trackflow.plans.chain import moving, ordered_pings, process
from trackflow.session import Held
from trackflow.sources import streams, tables
from trackflow.sources.versions import Folder, Versioned
from trackflow.streaming import arrival, pipeline, windows


@pytest.fixture(scope="module")
def rows(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark.createDataFrame(random_pings(600, 12), PING).cache()
    spark.conf.set("spark.sql.shuffle.partitions", "4")


# -- versioned tables ----------------------------------------------------------------------


def test_versions(spark, tmp_path):
    """100 writes: few folders, each version readable while it is kept, the last row of each key wins."""
    table = Versioned(spark, str(tmp_path / "t"), "k", most_parts=4, keep_versions=6)
    assert table.read() is None
    want, seen = {}, {}
    for v in range(100):
        changes = [(k, v * 10 + k) for k in range(v % 7, 40, 7 + v % 3)]
        table.upsert(spark.createDataFrame(changes, "k int, x int").coalesce(1), v)
        want |= dict(changes)
        seen[v] = dict(want)
        manifest = table.manifest()
        assert manifest.version == v and len(manifest.parts) <= 5
        assert len(table.folders.names()) <= 6 * 5 + 6 and len(table.manifests.names()) <= 6
    for v in (95, 99):
        assert {r.k: r.x for r in table.read(v).collect()} == seen[v]
    rewritten = sum(n for _, n in table.manifest().parts)
    assert rewritten <= 3 * len(want)


def test_a_reader_keeps_its_version(spark, tmp_path):
    table = Versioned(spark, str(tmp_path / "t"), "k", most_parts=1)
    one = spark.createDataFrame([(1, "a")], "k int, x string")
    table.upsert(one, 0)
    reader = table.read()
    for v in range(1, 5):
        table.upsert(spark.createDataFrame([(1, f"b{v}"), (v + 1, "c")], "k int, x string"), v)
    assert [tuple(r) for r in reader.collect()] == [(1, "a")]
    # A repeated write starts from the version before and takes the place of its former attempt.
    table.upsert(spark.createDataFrame([(9, "d")], "k int, x string"), 4)
    assert {(r.k, r.x) for r in table.read().collect()} == {(1, "b3"), (2, "c"), (3, "c"), (4, "c"), (9, "d")}


def test_a_half_written_version_is_not_seen(spark, tmp_path):
    table = Versioned(spark, str(tmp_path / "t"), "k")
    table.upsert(spark.createDataFrame([(1, 1)], "k int, x int"), 0)
    table._write(spark.createDataFrame([(1, 2)], "k int, x int"), 1)  # the writer dies before the manifest
    assert table.read().first().x == 1
    table.upsert(spark.createDataFrame([(1, 3)], "k int, x int"), 1)
    assert table.read().first().x == 3


def test_folder(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "f"))
    assert folder.names() == []
    folder.write("a", "é\n")
    with pytest.raises(Exception):
        folder.write("a", "again")
    assert folder.read("a") == "é\n" and folder.names() == ["a"]


# -- arrival order -------------------------------------------------------------------------


def messages(rows):
    """Two partitions of one topic and one of another; sending times jump back within a partition."""
    source = F.col("taxi_id") % 3
    jump = F.when(F.col("seq") % 11 == 0, -2500).otherwise(0)
    return rows.withColumns(
        {
            "topic": F.when(source == 2, "b").otherwise("a"),
            "partition": (source % 2).cast("int"),
            "offset": F.col("seq") * 2,
            "sent_at_utc_ms": F.col("sent_at_utc_ms") + jump,
        }
    ).drop("seq")


def test_arrival_order(spark, rows):
    got = arrival.in_arrival_order(messages(rows)).orderBy("seq").collect()
    assert len({r.seq for r in got}) == len(got) == 600
    want, latest = [], {}
    for r in sorted(got, key=lambda r: r.offset):
        key = (r.topic, r.partition)
        latest[key] = max(latest.get(key, 0), r.sent_at_utc_ms)
        want.append((latest[key], r.topic, r.partition, r.offset))
    assert [(r.topic, r.partition, r.offset) for r in got] == [w[1:] for w in sorted(want)]


def test_too_many_messages_in_a_millisecond_fail(spark, monkeypatch):
    monkeypatch.setattr(arrival, "PLACES", 3)
    rows = spark.range(4).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit(7).alias("sent_at_utc_ms"))
    assert arrival.in_arrival_order(rows.limit(3)).count() == 3
    with pytest.raises(Exception, match="within a millisecond"):
        arrival.in_arrival_order(rows).collect()


@pytest.mark.parametrize("ahead", [0, 400])
def test_partitions_merge_into_the_batch_result(spark, rows, tmp_path, ahead):
    """Interleaved sending times, one partition far ahead of the others: the job gives the batch rows."""
    sent = messages(rows)
    due = F.col("offset") - F.when(F.col("topic") == "b", 2 * ahead).otherwise(0)
    order = sent.withColumn("_due", due).orderBy("_due", "offset").drop("_due").collect()
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(4):
        part = spark.createDataFrame(order[i * 150 : (i + 1) * 150], sent.schema)
        part.coalesce(1).write.mode("append").parquet(path)
        import time

        time.sleep(1.05)  # file order is by modification time
    cfg = Settings(source_partitions=3, inactivity_timeout_s=5)  # no allowance for silent partitions
    source = streams.file_stream(spark, path, sent.schema, files_per_trigger=1)
    pipeline.take_all(source, out, cfg)
    want = arrival.in_arrival_order(sent).drop("topic", "partition", "offset").cache()
    same(tables.read_batches(spark, f"{out}/processed"), process(want))
    same(tables.read_batches(spark, f"{out}/fleet"), fleet.fleet_rows(moving(ordered_pings(want))))
    with pytest.raises(ValueError, match="has ended"):
        pipeline.start(source, out, cfg, every=None)


def step(spark, merged, out, batch_id, rows, end=False):
    schema = "topic string, partition int, offset bigint, sent_at_utc_ms bigint"
    held = Held(spark, out)
    got = merged.release(spark.createDataFrame(rows, schema), batch_id, held, end).orderBy("seq").collect()
    held.release()
    return [(r.topic, r.partition, r.offset) for r in got]


def test_release(spark, tmp_path):
    out = str(tmp_path)
    merged = arrival.Arrival(out, partitions=2)
    # Nothing before both partitions have been seen; then what both have passed.
    assert step(spark, merged, out, 0, [("t", 0, 0, 10), ("t", 0, 1, 20)]) == []
    assert step(spark, merged, out, 1, [("t", 1, 0, 15)]) == [("t", 0, 0)]
    # A repeated micro-batch gives the same.
    assert step(spark, merged, out, 1, [("t", 1, 0, 15)]) == [("t", 0, 0)]
    # A message sent before others of its partition keeps its place behind them.
    assert step(spark, merged, out, 2, [("t", 1, 1, 5), ("t", 1, 2, None), ("t", 0, 2, 30), ("t", 1, 3, 25)]) == [
        ("t", 1, 0), ("t", 1, 1), ("t", 1, 2), ("t", 0, 1)
    ]
    assert step(spark, merged, out, 3, []) == []
    # A partition that was not expected arrives at the released time.
    assert step(spark, merged, out, 4, [("u", 0, 0, 1)]) == []
    assert step(spark, merged, out, 5, [], end=True) == [("t", 1, 3), ("u", 0, 0), ("t", 0, 2)]
    assert merged.last_batch(spark) == 5


def test_silent_partitions_are_not_waited_for(spark, tmp_path):
    out = str(tmp_path)
    merged = arrival.Arrival(out, partitions=2, idle_s=1)
    step(spark, merged, out, 0, [("t", 0, 0, 10), ("t", 1, 0, 12)])
    import time

    time.sleep(1.2)
    assert step(spark, merged, out, 1, [("t", 1, 1, 50), ("t", 1, 2, 60)]) == [("t", 0, 0), ("t", 1, 0), ("t", 1, 1)]
    # It comes back with an old message, which arrives now.
    assert step(spark, merged, out, 2, [("t", 0, 1, 11), ("t", 0, 2, 70), ("t", 1, 3, 80)]) == [("t", 0, 1), ("t", 1, 2)]


# -- windows -------------------------------------------------------------------------------


def test_windows_are_complete_and_late_rows_counted(spark, tmp_path):
    def batch(*seconds):
        return spark.createDataFrame(
            [(i, 1, s, 0, 5) for i, s in enumerate(seconds)],
            "seq bigint, taxi_id int, event_s bigint, sent_at_utc_ms bigint, processed_at_utc_ms bigint",
        )

    sink = windows.Windows(str(tmp_path / "w"), windows.counts(), seconds=10, lateness_s=5)
    sink.close(spark)  # nothing has come yet
    sink(batch(1, 3, 12, None), 0)
    sink(batch(4, 16), 1)  # the watermark was 7, so 4 is in time; now it is 11
    sink(batch(5, 31), 2)  # 5 is late
    sink(batch(5, 31), 2)  # repeated
    sink.close(spark)
    got = {(r.window_start, r.window_end, r.pings, r.latency_sum_ms) for r in sink.closed(spark).collect()}
    assert got == {(0, 10, 3, 15), (10, 20, 2, 10), (30, 40, 1, 5)}
    assert [(r.event_s, r.window_start) for r in sink.late(spark).collect()] == [(5, 0)]


def test_latest_per_window(spark, rows, tmp_path):
    on_time = rows.where("event_s is not null").withColumn("event_s", F.lit(1_201_910_400) + F.col("seq"))
    sink = windows.Windows(str(tmp_path / "w"), windows.latest(on_time.columns), 60)
    for i in range(3):
        sink(on_time.where(F.col("seq").between(i * 600, i * 600 + 599)), i)
    sink.close(spark)
    same(sink.closed(spark), state.latest_per_tumbling(on_time, 60))


# -- trends and log at rest ----------------------------------------------------------------


def test_trends_of_parts(spark, rows, tmp_path):
    """Trends kept per micro-batch are those of all points; a repeated batch counts once."""
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    feed(rows, path, 3)
    take(spark, rows, path, out)
    want = process(rows).cache()
    whole = fleet.fleet_rows(moving(ordered_pings(rows)))
    parts = tables.read_batches(spark, f"{out}/trends/fleet_metrics")
    same(trends.fleet_trend_of_parts(parts), trends.fleet_metrics_trend(points.fleet_points(whole)))
    parts = tables.read_batches(spark, f"{out}/trends/alerts")
    raised = points.alert_points(alerts.all_alerts(want))
    for taxi in (None, "1"):
        same(trends.incident_trend_of_parts(parts, taxi_id=taxi), trends.incident_trend(raised, taxi_id=taxi))
    assert len(Folder(spark, f"{out}/_work").names()) == 0
    log = tables.newest_log_rows(spark, f"{out}/incidents", 5)
    same(alerts.last_incidents(log, 5), alerts.last_incidents(alerts.incident_log(alerts.all_alerts(want)), 5))


def test_newest_rows_of_the_log(spark, tmp_path):
    """Only the folders that can hold the newest rows are read; days and arrival need not agree."""
    path = str(tmp_path / "log")
    for batch in range(30):
        day = f"2008-02-{1 + batch // 2:02d} 10:00:00" if batch != 20 else "2008-02-01 00:00:00"
        rows = [(batch * 10 + i, "SPEED_VIOLATION", day) for i in range(10)]
        tables.write_log_batch(spark.createDataFrame(rows, "seq bigint, alert_type string, updated_at string").coalesce(1), path, batch)
    tables.write_log_batch(spark.createDataFrame([(295 + i, "X", None) for i in range(3)], "seq bigint, alert_type string, updated_at string"), path, 29)
    for n in (1, 3, 5, 25, 100, 1000):
        got = tables.newest_log_rows(spark, path, n)
        want = [r.seq for r in alerts.last_incidents(tables.read_log(spark, path), n).collect()]
        assert [r.seq for r in alerts.last_incidents(got, n).collect()] == want
        if n <= 25:
            assert len(got.inputFiles()) <= 6 and tables.read_log(spark, path).count() == 293
    with pytest.raises(ValueError):
        Settings(source_partitions=0)
