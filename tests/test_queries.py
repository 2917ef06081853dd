"""State, points, trends, benchmark and quality on small inputs; a sample of queries against SQL."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from __spark_entry__ import entry, oracle_sql, queries
from conftest import SMALL
from oracle import ORACLE
from trackflow.config import Settings
from trackflow.functions import geo
from trackflow.functions.numbers import nullable_percent_change, safe_percent_change
from trackflow.operators import benchmark, fleet, points, quality, state, trends
from trackflow.operators.quantiles import percentiles
from trackflow.plans.queries import QUERIES
from trackflow.sources import tables


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_haversine_and_sql_function(spark):
    geo.register_sql(spark)
    r = spark.sql("SELECT haversine_km(39.9, 116.4, 40.9, 116.4) AS km, haversine_km(0, 0, 0, 180) AS half").first()
    assert r.km == pytest.approx(111.19492664, abs=1e-6)
    assert r.half == pytest.approx(np.pi * 6371, abs=1e-6)
    same = one(spark, d=geo.haversine_km(F.lit(39.9), F.lit(116.4), F.lit(39.9), F.lit(116.4)))
    assert same.d == 0.0


def test_percent_changes(spark):
    pairs = [(5, 4, 25.0, 25.0), (5, 0, 0.0, None), (0, 4, -100.0, -100.0)]
    for now, was, safe, strict in pairs:
        now, was = F.lit(float(now)), F.lit(float(was))
        r = one(spark, a=safe_percent_change(now, was), b=nullable_percent_change(now, was))
        assert (r.a, r.b) == (safe, strict)
    r = one(spark, b=nullable_percent_change(F.lit(1.0), F.lit(None).cast("double")))
    assert r.b is None


def test_labels(spark):
    def label(status, speed):
        return one(spark, v=geo.trip_label(F.lit(status), F.lit(speed).cast("double"))).v

    assert [label(*p) for p in (("active", 0.0), ("active", 3.0), ("active", None), ("inactive", 3.0),
                                ("end", 0.0), ("x", 1.0), (None, None))] == [
        "Connected", "In Transit", "Reconnecting...", "Reconnecting...", "Trip Complete",
        "Status Unknown", "Status Unknown"]
    zones = [one(spark, v=geo.performance_zone(F.lit(s))).v for s in (0.0, 1.0, 5.0, 10.0)]
    assert zones == ["excellent", "good", "acceptable", "poor"]
    bands = [one(spark, v=geo.distance_band(F.lit(k))).v for k in (10.0, 10.1, 15.0, 15.1)]
    assert bands == ["safe", "warn", "warn", "out"]


def test_latest_merge_and_display(spark):
    rows = spark.createDataFrame(
        [(1, 1, "active", 5.0, True, 3.0), (1, 3, "end", 0.0, True, 3.0), (2, 2, "active", 0.0, True, 16.0),
         (0, 4, "active", 1.0, True, 1.0), (3, 5, "active", 0.0, False, 1.0), (None, 6, "active", 1.0, True, 1.0)],
        "taxi_id int, seq bigint, trip_status string, speed double, is_valid_speed boolean,"
        " distance_from_forbidden_city_km double")
    latest = state.latest_per_taxi(rows)
    assert {(r.taxi_id, r.seq) for r in latest.collect()} == {(1, 3), (2, 2), (3, 5)}
    assert [r.taxi_id for r in state.taxi_ids(latest).collect()] == [1, 2, 3]

    def ids(**switches):
        return {r.taxi_id for r in state.displayed(latest, **switches).collect()}

    assert ids() == {1}
    assert ids(outside=True) == {1, 2}
    assert ids(outside=True, ended=False) == {2}
    assert ids(outside=True, stationary=False) == {1}
    update = spark.createDataFrame([(1, None, 9.0), (7, "active", 1.0)], "taxi_id int, trip_status string, speed double")
    merged = {r.taxi_id: (r.trip_status, r.speed, r.seq) for r in state.merge_latest(latest, update).collect()}
    assert merged == {1: ("end", 9.0, 3), 2: ("active", 0.0, 2), 3: ("active", 0.0, 5), 7: ("active", 1.0, None)}
    none = spark.createDataFrame([], "seq bigint, active_taxis_count bigint")
    now = state.fleet_now(latest, none).first()
    assert (now.active_taxis_count, now.current_taxi_fleet_size) == (None, 3)


@pytest.mark.parametrize("limit", [10_000, 5])
def test_percentiles(spark, limit):
    rng = np.random.default_rng(3)
    data = {g: rng.integers(-50, 50, n) for g, n in ((1, 1), (2, 2), (3, 101), (4, 400))}
    rows = [(g, int(v)) for g, values in data.items() for v in values]
    hist = spark.createDataFrame(rows, "g int, v bigint").groupBy("g", "v").agg(F.count("*").alias("c"))
    at = {"q0": 0.0, "q50": 0.5, "q95": 0.95, "q100": 1.0}
    for r in percentiles(hist, "g", "v", "c", at, limit).collect():
        assert (r["size"], r.total) == (len(data[r.g]), data[r.g].sum())
        for name, p in at.items():
            assert r[name] == pytest.approx(np.percentile(data[r.g], p * 100))


@pytest.mark.parametrize("limit", [10_000, 4])
def test_benchmark_windows(spark, limit):
    cfg = Settings(bench_window_ms=1000, max_group_rows=limit)
    rows = [(0, 1, 4900, 5000), (1, 2, 5000, 5400), (2, 1, 5900, 5400), (3, 3, 8000, 8100), (4, 1, 8000, 8100), (5, 2, 8000, 8100)]
    msgs = spark.createDataFrame(rows, "seq bigint, taxi_id int, sent_at_utc_ms bigint, processed_at_utc_ms bigint")
    windows = benchmark.latency_windows(msgs, cfg).orderBy("window_start_utc_ms").collect()
    assert [tuple(w)[:6] for w in windows] == [
        (5000, 6000, 2, 3, 250.0, 2), (6000, 7000, 2, 3, 0.0, 0), (7000, 8000, 2, 3, 0.0, 0), (8000, 9000, 3, 6, 100.0, 3)]
    numbered = benchmark.latency_per_message(msgs, cfg).orderBy("record_number").collect()
    assert [(r.record_number, r.latency_s) for r in numbered] == [(1, 0.1), (2, 0.4), (4, 0.1), (5, 0.1), (6, 0.1)]
    loads = benchmark.latency_windows(msgs, cfg)
    by_load = benchmark.latency_percentiles_by_load(msgs, loads, cfg).orderBy("cumulative_taxis").collect()
    assert [(r.cumulative_taxis, r.mean_latency_s, r.p95_latency_s) for r in by_load] == [(2, 0.25, 0.385), (3, 0.1, 0.1)]
    through = benchmark.throughput_vs_latency(msgs, loads, cfg).orderBy("window_start_utc_ms").collect()
    assert [(r.throughput_per_s, r.p95_latency_s, r.cumulative_taxis) for r in through] == [(3.0, 0.385, 2), (3.0, 0.1, 3)]
    assert benchmark.messages(msgs, 2).count() == 2


@pytest.mark.parametrize("limit", [10_000, 1])
def test_conflicts(spark, limit):
    rows = [(1, 1, 10, 39.0, 116.0), (2, 1, 10, 39.5, 116.0), (3, 1, 10, 39.7, 116.0), (4, 1, 11, 39.0, 116.0),
            (5, 1, 11, 39.0, 116.0), (6, 2, 10, 1.0, 1.0), (7, 2, 10, 1.0, 1.25), (8, 3, 10, None, 1.0), (9, 3, 10, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "seq bigint, taxi_id int, timestamp bigint, latitude double, longitude double")
    conflicts = quality.conflict_rows(df, Settings(max_group_rows=limit))
    assert sorted(r.seq for r in conflicts.collect()) == [1, 2, 3, 6, 7]
    assert {(r.taxi_id, r.lat_diff, r.lon_diff) for r in quality.conflict_diffs(conflicts).collect()} == {(1, 0.5, 0.0), (2, 0.0, 0.25)}
    assert tuple(quality.conflict_summary(conflicts).first()) == (2, 3, 3)
    assert [r.taxi_id for r in quality.taxis_with_count(conflicts, 3).collect()] == [1]
    described = {r.field: r for r in quality.describe_diffs(quality.conflict_diffs(conflicts)).collect()}
    assert (described["lat_diff"].q50, described["lat_diff"].std) == (0.25, 0.353553)
    none = quality.conflict_rows(df.where("taxi_id = 9"))
    assert none.columns == df.columns and none.count() == 0
    plan = quality.conflict_diffs(conflicts)._jdf.queryExecution().executedPlan().toString()
    # Only two rows per key are ranked.
    assert "WindowGroupLimit" in plan


def test_points_tables_and_report(spark, pings, tmp_path):
    processed = queries()["processed_stream"](spark, SMALL)
    path = str(tmp_path / "points")
    wide = points.taxi_points(processed)
    tables.write_points(wide, path)
    low, high = wide.agg(F.min("time_ms"), F.max("time_ms")).first()
    middle = (low + high) // 2
    got = tables.read_points(spark, path, middle, high)
    assert got.count() == wide.where(F.col("time_ms").between(middle, high - 1)).count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(point_date" in plan and "GreaterThanOrEqual(time_ms" in plan
    taxi = wide.first().taxi_id
    assert trends.taxi_speed_trend(wide, taxi).count() == wide.where(F.col("taxi_id") == taxi).count()
    msgs = benchmark.messages(processed)
    cfg = Settings(bench_window_ms=86_400_000)
    tables.write_report(benchmark.latency_windows(msgs, cfg), benchmark.run_summary(msgs, cfg), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report" / "time_series_data")).count() == 30


def test_fleet_message(spark):
    rows = queries()["fleet_latest"](spark, SMALL)
    message = fleet.as_message(rows).first()
    assert message.inactive_taxis["count"] == 0
    assert message.total_distance["distance"] == rows.first().total_distance_km


SAMPLE = [
    "clean_pings", "replay_schedule_actual", "propagate_300s", "processed_stream", "all_alerts",
    "trip_sessions", "inactive_trips", "fleet_metrics_rows", "incident_log", "taxi_incident_trend",
    "fleet_latency_summary_day", "throughput_vs_latency", "conflict_describe", "point_struct",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{SMALL}/events.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, db, name):
    got = queries()[name](spark, SMALL).toPandas()
    assert check.compare(got, db.sql(oracle_sql()[name]).df()) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).count() > 0
