"""Every operator as a named query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.config import DEFAULTS, Settings
from trackflow.functions import geo, messages
from trackflow.functions.numbers import latency_seconds
from trackflow.operators import (
    alerts,
    benchmark,
    cleaning,
    fleet,
    inactivity,
    motion,
    points,
    quality,
    state,
    trends,
)
from trackflow.operators.ordered import Ordered
from trackflow.plans import chain
from trackflow.plans.fixture import EPOCH_MS_2024_01_01, conflict_pings, load_pings, raw_pings, stream_pings
from trackflow.session import Held, cut, shared_dir
from trackflow.sources import files, streams, tables, topiclog
from trackflow.sources.versions import Versioned
from trackflow.streaming import inactivity as stream_inactivity
from trackflow.streaming import arrival, pipeline, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RECEIVED_MS = 1_704_067_200_000  # stands for the clock, so that results repeat
PING = ["seq", "taxi_id", "event_s", "latitude", "longitude", "trip_status"]
PROCESSED = [
    *PING, "sent_at_utc_ms", "processed_at_utc_ms", "speed", "is_valid_speed", "avg_speed",
    "total_distance_km", "distance_from_forbidden_city_km", "is_in_range",
]


def query(fn: Query) -> Query:
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Event times are naive; text and windows read them as UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = in_utc
    return fn


def _pings(spark: SparkSession, sf_dir: str) -> Ordered:
    return chain.ordered_pings(load_pings(spark, sf_dir))


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.process(load_pings(spark, sf_dir))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_per_taxi(_processed(spark, sf_dir))


def _fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.fleet_rows(chain.moving(_pings(spark, sf_dir)))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.all_alerts(_processed(spark, sf_dir))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.incident_log(_alerts(spark, sf_dir))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_pings(load_pings(spark, sf_dir))


def _conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.conflict_rows(conflict_pings(load_pings(spark, sf_dir)))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Read several times by each analysis, so written once.
    return cut(benchmark.messages(_processed(spark, sf_dir)))


# -- cleaning and replay -------------------------------------------------------------------


def _time_text(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query
def clean_pings(spark, sf_dir):
    return _time_text(cleaning.clean(_raw(spark, sf_dir)))


def _zips(spark: SparkSession, sf_dir: str) -> str:
    """The stand-in's raw rows as archives in the shared folder."""
    folder = f"{shared_dir(spark)}/zips-{uuid.uuid4().hex}"
    files.write_zips(_raw(spark, sf_dir), folder).agg(F.sum("files")).collect()
    return folder


@query
def zip_scan(spark, sf_dir):
    rows = files.read_zips(spark, _zips(spark, sf_dir)).drop("archive")
    return rows.withColumn("taxi_id", F.col("taxi_id").cast("string"))


@query
def zip_member(spark, sf_dir):
    return files.read_zips(spark, _zips(spark, sf_dir), "1.txt").drop("archive")


@query
def cleaned_table(spark, sf_dir):
    folder = f"{shared_dir(spark)}/cleaned-{uuid.uuid4().hex}"
    tables.write_cleaned(cleaning.clean(_raw(spark, sf_dir)), folder)
    return _time_text(files.read_table(spark, folder)).drop("event_date")


@query
def cleaned_in_time_order(spark, sf_dir):
    return _time_text(cleaning.in_time_order(cleaning.clean(_raw(spark, sf_dir))))


@query
def clean_sentinel_coords(spark, sf_dir):
    return cleaning.sentinel_coords(_raw(spark, sf_dir)).select("file", "line", "longitude", "latitude")


@query
def trip_status_mark(spark, sf_dir):
    marked = cleaning.mark_trip_status(cleaning.fill_and_parse(_raw(spark, sf_dir)))
    return marked.select("taxi_id", "file", "line", "trip_status")


@query
def distinct_rows(spark, sf_dir):
    rows = cleaning.distinct_rows(_raw(spark, sf_dir))
    return rows.withColumn("taxi_id", F.col("taxi_id").cast("string"))


@query
def file_limit(spark, sf_dir):
    return cleaning.limit_files(_raw(spark, sf_dir), 100).select("file", "line", "timestamp")


@query
def replay_batches(spark, sf_dir):
    batches = cleaning.second_batches(cleaning.clean(_raw(spark, sf_dir)))
    return batches.select(F.unix_seconds("batch_time").alias("batch_s"), "messages")


@query
def replay_schedule_actual(spark, sf_dir):
    cleaned = cleaning.clean(_raw(spark, sf_dir))
    return cleaning.replay_schedule(cleaned, Settings(replay_speed=2.0))


@query
def replay_schedule_simulated(spark, sf_dir):
    cleaned = cleaning.clean(_raw(spark, sf_dir))
    return cleaning.replay_schedule(cleaned, Settings(replay_mode="simulated", replay_speed=2.5))


def _sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.as_sent(cleaning.clean(_raw(spark, sf_dir)), RECEIVED_MS)


@query
def cleaned_pings(spark, sf_dir):
    return _time_text(_sent(spark, sf_dir))


@query
def cleaned_chain(spark, sf_dir):
    return chain.process(_sent(spark, sf_dir)).select(*[c for c in PROCESSED if c != "processed_at_utc_ms"])


@query
def cleaned_messages(spark, sf_dir):
    from trackflow.schema import RAW_MESSAGE

    sent = _sent(spark, sf_dir)
    texts = messages.raw_messages(sent, F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    parsed = texts.withColumn("_m", messages.parse_json(F.col("value"), RAW_MESSAGE))
    return parsed.select("key", "seq", "_m.*").drop(messages.CORRUPT)


# -- messages ------------------------------------------------------------------------------


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages as JSON text; some are cut short and are no longer JSON."""
    pings = load_pings(spark, sf_dir)
    texts = messages.raw_messages(pings, messages.event_text(F.col("event_s")))
    broken = pings.where(F.col("k") == 9).select(F.col("seq").alias("_bad"))
    texts = texts.join(broken, F.col("seq") == F.col("_bad"), "left")
    cut_short = F.when(F.col("_bad").isNotNull(), F.substring("value", 1, 12))
    return texts.withColumn("value", F.coalesce(cut_short, F.col("value"))).drop("_bad", "key")


@query
def parse_messages(spark, sf_dir):
    return messages.parse_messages(_texts(spark, sf_dir), received_ms=F.lit(RECEIVED_MS))[0]


@query
def rejected_messages(spark, sf_dir):
    return messages.parse_messages(_texts(spark, sf_dir))[1].select("seq", "value")


@query
def emit_messages(spark, sf_dir):
    from trackflow.schema import PROCESSED_MESSAGE

    received = (F.col("sent_at_utc_ms") + 3).alias("received_at_utc_ms")
    texts = messages.processed_messages(_processed(spark, sf_dir).select("*", received))
    parsed = texts.withColumn("_m", messages.parse_json(F.col("value"), PROCESSED_MESSAGE))
    return parsed.select("key", "_m.*").drop(messages.CORRUPT)


# -- scalar columns ------------------------------------------------------------------------


@query
def haversine_to_centre(spark, sf_dir):
    km = geo.distance_to_centre(F.col("latitude"), F.col("longitude"))
    return load_pings(spark, sf_dir).select("seq", "taxi_id", F.round(km, 6).alias("km"))


@query
def event_latency(spark, sf_dir):
    seconds = latency_seconds(F.col("processed_at_utc_ms"), F.col("sent_at_utc_ms"))
    return load_pings(spark, sf_dir).select("seq", seconds.alias("latency_s"))


@query
def perf_zone(spark, sf_dir):
    return event_latency(spark, sf_dir).withColumn("zone", geo.performance_zone(F.col("latency_s")))


@query
def status_class(spark, sf_dir):
    label = geo.trip_label(F.col("trip_status"), F.col("speed"))
    return _processed(spark, sf_dir).select("seq", "trip_status", "speed", label.alias("label"))


@query
def speed_band(spark, sf_dir):
    band = geo.speed_band(F.col("trip_status"), F.col("speed"))
    return _processed(spark, sf_dir).select("seq", "trip_status", "speed", band.alias("band"))


@query
def distance_band(spark, sf_dir):
    km = F.col("distance_from_forbidden_city_km")
    return _processed(spark, sf_dir).select("seq", km, geo.distance_band(km).alias("band"))


@query
def marker_class(spark, sf_dir):
    names = ("is_in_range", "trip_status", "speed", "is_valid_speed")
    marker = geo.marker_class(*[F.col(n) for n in names])
    return _processed(spark, sf_dir).select("seq", "taxi_id", marker.alias("marker"))


# -- keyed chain ---------------------------------------------------------------------------


@query
def trip_segments(spark, sf_dir):
    return motion.trip_segments(_pings(spark, sf_dir)).rows().select(*PING, "seg")


@query
def dedup_same_ts(spark, sf_dir):
    return motion.dedup_same_timestamp(_pings(spark, sf_dir)).rows().select(*PING)


@query
def propagate_5s(spark, sf_dir):
    rows = motion.dedup_same_timestamp(_pings(spark, sf_dir))
    return motion.downsample(rows, 5).rows().select(*PING)


@query
def propagate_300s(spark, sf_dir):
    rows = motion.dedup_same_timestamp(_pings(spark, sf_dir))
    return motion.downsample(rows, 300).rows().select(*PING)


@query
def latest_per_tumbling_5s(spark, sf_dir):
    pings = load_pings(spark, sf_dir).select(*PING)
    return state.latest_per_tumbling(pings, DEFAULTS.emit_interval_s)


@query
def speed(spark, sf_dir):
    rows = motion.downsample(motion.dedup_same_timestamp(_pings(spark, sf_dir)))
    return motion.speed(rows).rows().select(*PING, "speed", "is_valid_speed")


@query
def avg_speed(spark, sf_dir):
    rows = chain.averaged(_pings(spark, sf_dir)).rows()
    return rows.select(*PING, "speed", "is_valid_speed", "avg_speed")


@query
def total_distance(spark, sf_dir):
    return chain.moving(_pings(spark, sf_dir)).rows().select(*PING, "total_distance_km")


@query
def geofence(spark, sf_dir):
    return _processed(spark, sf_dir).select(
        *PING, "distance_from_forbidden_city_km", "is_in_range", "geofence_alert"
    )


@query
def geofence_alerts(spark, sf_dir):
    return alerts.geofence_alerts(_processed(spark, sf_dir))


@query
def speed_alerts(spark, sf_dir):
    return alerts.speed_alerts(_processed(spark, sf_dir))


@query
def all_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir)


@query
def processed_stream(spark, sf_dir):
    return _processed(spark, sf_dir).select(*PROCESSED)


@query
def inactive_trips(spark, sf_dir):
    return inactivity.inactive_trips(_pings(spark, sf_dir)).select(*PING)


@query
def trip_sessions(spark, sf_dir):
    return inactivity.trip_sessions(load_pings(spark, sf_dir))


# -- fleet ---------------------------------------------------------------------------------


@query
def fleet_metrics_rows(spark, sf_dir):
    return _fleet(spark, sf_dir)


@query
def fleet_metrics_seconds(spark, sf_dir):
    return fleet.fleet_seconds(_fleet(spark, sf_dir))


@query
def fleet_latest(spark, sf_dir):
    return fleet.fleet_latest(_fleet(spark, sf_dir))


# -- latest state --------------------------------------------------------------------------


@query
def latest_taxis(spark, sf_dir):
    return _latest(spark, sf_dir).select(
        *PING, "speed", "is_valid_speed", "avg_speed", "total_distance_km",
        "distance_from_forbidden_city_km", "is_in_range", "processed_at_utc_ms",
    )


@query
def fleet_size(spark, sf_dir):
    rows = _fleet(spark, sf_dir).drop("taxi_id", "event_s", "processed_at_utc_ms")
    return state.fleet_now(_latest(spark, sf_dir), rows)


@query
def taxi_ids(spark, sf_dir):
    return state.taxi_ids(_latest(spark, sf_dir))


@query
def fleet_snapshot(spark, sf_dir):
    latest = _latest(spark, sf_dir).select("taxi_id", "trip_status", "speed")
    return state.fleet_snapshot(latest)


@query
def merge_latest(spark, sf_dir):
    raw = state.latest_per_taxi(load_pings(spark, sf_dir).select(*PING))
    update = _latest(spark, sf_dir).select("taxi_id", "trip_status", "latitude", "speed")
    return state.merge_latest(raw, update)


@query
def display_filter(spark, sf_dir):
    shown = state.displayed(_latest(spark, sf_dir))
    return shown.select("taxi_id", "trip_status", "speed", "distance_from_forbidden_city_km")


@query
def display_filter_strict(spark, sf_dir):
    latest = _latest(spark, sf_dir)
    shown = state.displayed(latest, stationary=False, ended=False, outside=True)
    return shown.select("taxi_id", "trip_status", "speed", "distance_from_forbidden_city_km")


# -- incidents -----------------------------------------------------------------------------


@query
def incident_log(spark, sf_dir):
    return _log(spark, sf_dir)


@query
def incident_counts(spark, sf_dir):
    return alerts.incident_counts(_log(spark, sf_dir))


@query
def last_50_incidents(spark, sf_dir):
    return alerts.last_incidents(_log(spark, sf_dir))


@query
def incidents_newest_first(spark, sf_dir):
    return alerts.newest_first(_log(spark, sf_dir)).select("seq", "taxi_id", "alert_type")


@query
def incidents_by_update(spark, sf_dir):
    return alerts.by_update(_log(spark, sf_dir)).select("incident_id", "updated_at")


@query
def incident_taxi_lookup(spark, sf_dir):
    processed = _processed(spark, sf_dir)
    log = alerts.incident_log(alerts.all_alerts(processed)).select("incident_id", "taxi_id")
    return alerts.with_latest_taxi(log, state.latest_per_taxi(processed))


# -- points and trends ---------------------------------------------------------------------


@query
def points_taxi(spark, sf_dir):
    return points.taxi_points(_processed(spark, sf_dir))


@query
def points_fleet(spark, sf_dir):
    return points.fleet_points(_fleet(spark, sf_dir))


@query
def points_alerts(spark, sf_dir):
    return points.alert_points(_alerts(spark, sf_dir))


POINT_IDS = ["seq", "taxi_id", "trip_status", "time_ms"]


@query
def points_unpivot(spark, sf_dir):
    return points.to_fields(points_taxi(spark, sf_dir), POINT_IDS, points.TAXI_FIELDS)


@query
def points_pivot(spark, sf_dir):
    return points.from_fields(points_unpivot(spark, sf_dir), POINT_IDS, points.TAXI_FIELDS)


@query
def fleet_metrics_trend(spark, sf_dir):
    return trends.fleet_metrics_trend(points_fleet(spark, sf_dir))


def _as_of(processed: DataFrame) -> int:
    return processed.agg(F.max("processed_at_utc_ms")).first()[0] + 1


@query
def fleet_latency_summary(spark, sf_dir):
    processed = _processed(spark, sf_dir)
    return trends.latency_summary(processed, _as_of(load_pings(spark, sf_dir)))


@query
def fleet_latency_summary_day(spark, sf_dir):
    as_of = _as_of(load_pings(spark, sf_dir))
    return trends.latency_summary(_processed(spark, sf_dir), as_of, long_s=86400 * 7, short_s=86400)


@query
def fleet_incident_trend(spark, sf_dir):
    return trends.incident_trend(points_alerts(spark, sf_dir))


@query
def taxi_incident_trend(spark, sf_dir):
    return trends.incident_trend(points_alerts(spark, sf_dir), per_taxi=True)


@query
def taxi_speed_trend(spark, sf_dir):
    return trends.taxi_speed_trend(points_taxi(spark, sf_dir))


@query
def taxi_avg_speed_trend(spark, sf_dir):
    return trends.taxi_average_speed_trend(points_taxi(spark, sf_dir))


@query
def taxi_latency_trend(spark, sf_dir):
    return trends.taxi_latency_trend(points_taxi(spark, sf_dir))


# -- the same with keys cut into many chunks -----------------------------------------------

CUT = Settings(max_group_rows=40)


@query
def propagate_cut(spark, sf_dir):
    pings = chain.ordered_pings(load_pings(spark, sf_dir), CUT)
    return motion.downsample(motion.dedup_same_timestamp(pings), CUT.emit_interval_s).rows().select(*PING)


@query
def processed_cut(spark, sf_dir):
    return chain.process(load_pings(spark, sf_dir), CUT).select(*PROCESSED)


@query
def fleet_cut(spark, sf_dir):
    pings = chain.ordered_pings(load_pings(spark, sf_dir), CUT)
    return fleet.fleet_rows(chain.moving(pings, CUT), CUT)


# -- benchmark analysis --------------------------------------------------------------------


@query
def processed_rescan(spark, sf_dir):
    return benchmark.messages(_processed(spark, sf_dir), DEFAULTS.bench_max_rows)


@query
def latency_per_message(spark, sf_dir):
    return benchmark.latency_per_message(_messages(spark, sf_dir))


@query
def latency_windows(spark, sf_dir):
    return benchmark.latency_windows(_messages(spark, sf_dir))


@query
def latency_windows_day(spark, sf_dir):
    cfg = Settings(bench_window_ms=86_400_000)
    return benchmark.latency_windows(_messages(spark, sf_dir), cfg)


@query
def latency_percentiles_by_load(spark, sf_dir):
    cfg = Settings(bench_window_ms=3_600_000)
    msgs = _messages(spark, sf_dir)
    return benchmark.latency_percentiles_by_load(msgs, benchmark.latency_windows(msgs, cfg), cfg)


@query
def throughput_vs_latency(spark, sf_dir):
    cfg = Settings(bench_window_ms=3_600_000)
    msgs = _messages(spark, sf_dir)
    return benchmark.throughput_vs_latency(msgs, benchmark.latency_windows(msgs, cfg), cfg)


@query
def run_summary(spark, sf_dir):
    return benchmark.run_summary(_messages(spark, sf_dir))


# -- data quality --------------------------------------------------------------------------


@query
def conflict_rows(spark, sf_dir):
    return _conflicts(spark, sf_dir)


@query
def conflict_counts_taxi(spark, sf_dir):
    return quality.conflict_counts(_conflicts(spark, sf_dir), "taxi_id")


@query
def conflict_counts_time(spark, sf_dir):
    return quality.conflict_counts(_conflicts(spark, sf_dir), "taxi_id", "timestamp")


@query
def conflict_summary(spark, sf_dir):
    return quality.conflict_summary(_conflicts(spark, sf_dir))


@query
def conflict_taxis_at_count(spark, sf_dir):
    return quality.taxis_with_count(_conflicts(spark, sf_dir), 2)


@query
def conflict_diffs(spark, sf_dir):
    diffs = quality.conflict_diffs(_conflicts(spark, sf_dir))
    return diffs.withColumns({c: F.round(c, 9) for c in ("lat_diff", "lon_diff")})


@query
def conflict_describe(spark, sf_dir):
    return quality.describe_diffs(quality.conflict_diffs(_conflicts(spark, sf_dir)))


@query
def null_ratio(spark, sf_dir):
    raw = _raw(spark, sf_dir).select("taxi_id", "timestamp", "longitude", "latitude")
    return quality.null_ratio(raw)


@query
def coord_range(spark, sf_dir):
    return quality.coord_range(load_pings(spark, sf_dir))


@query
def point_struct(spark, sf_dir):
    rows = quality.with_point(load_pings(spark, sf_dir))
    return rows.select("seq", F.col("point.latitude").alias("y"), F.col("point.longitude").alias("x"))


# -- streaming: the given events as a stream, taken until nothing is left --------------------


def _run(spark: SparkSession, stream: DataFrame) -> DataFrame:
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    query = streams.sink(stream, f"{out}/checkpoint", every=None, path=f"{out}/rows").start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def _run_pipeline(spark: SparkSession, sf_dir: str, fleet: bool) -> str:
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    pipeline.start(stream_pings(spark, sf_dir), out, every=None, fleet=fleet).awaitTermination()
    return out


@query
def stream_chain(spark, sf_dir):
    rows = tables.read_batches(spark, _run_pipeline(spark, sf_dir, False) + "/processed")
    return rows.drop("received_at_utc_ms")


@query
def stream_incidents(spark, sf_dir):
    return tables.read_log(spark, _run_pipeline(spark, sf_dir, False) + "/incidents")


@query
def stream_latest(spark, sf_dir):
    latest = tables.read_latest(spark, _run_pipeline(spark, sf_dir, False) + "/latest")
    return latest.select("taxi_id", "seq", "trip_status", "speed", "avg_speed", "total_distance_km")


@query
def stream_fleet(spark, sf_dir):
    return tables.read_batches(spark, _run_pipeline(spark, sf_dir, True) + "/fleet")


def _run_windows(spark: SparkSession, sf_dir: str, aggregates: windows.Aggregates, seconds: int) -> DataFrame:
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    sink = windows.Windows(out, aggregates, seconds)
    streams.batch_sink(stream_pings(spark, sf_dir), f"{out}/checkpoint", sink, every=None).start().awaitTermination()
    sink.close(spark)
    return sink.closed(spark)


@query
def stream_window_counts(spark, sf_dir):
    return _run_windows(spark, sf_dir, windows.counts(), 300)


@query
def stream_window_latest(spark, sf_dir):
    rows = _run_windows(spark, sf_dir, windows.latest(PING), DEFAULTS.emit_interval_s)
    return rows.select(*latest_per_tumbling_5s(spark, sf_dir).columns)


SLICES = 4  # micro-batches of the queries that hand the given table to a sink slice by slice


def _slices(rows: DataFrame, order: str = "seq") -> list[DataFrame]:
    top = rows.agg(F.max(order)).first()[0] or 0
    part = F.col(order) * SLICES
    return [rows.where((part > top * i if i else F.lit(True)) & (part <= top * (i + 1))) for i in range(SLICES)]


@query
def late_rows(spark, sf_dir):
    """Rows of windows that were final when they came: a tenth of the taxis sends 2,000 messages late."""
    sink = windows.Windows(f"{shared_dir(spark)}/late-{uuid.uuid4().hex}", windows.counts())
    rows = load_pings(spark, sf_dir).select(*PING, "sent_at_utc_ms", "processed_at_utc_ms")
    due = F.col("seq") + F.when(F.col("taxi_id") % 10 == 0, 2000).otherwise(0)
    for i, part in enumerate(_slices(rows.withColumn("_due", due), "_due")):
        sink(part, i)
    return sink.late(spark).select("seq", "taxi_id", "event_s", "window_start")


def _partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pings as messages of three partitions of two topics, offsets in sending order."""
    source = F.col("taxi_id") % 3
    rows = load_pings(spark, sf_dir).select(
        F.col("seq").alias("ping"), "taxi_id", "sent_at_utc_ms",
        F.when(source == 2, "b").otherwise("a").alias("topic"), (source % 2).cast("int").alias("partition"),
    )
    return rows.withColumn("offset", F.col("ping"))


@query
def arrival_order(spark, sf_dir):
    return arrival.in_arrival_order(_partitioned(spark, sf_dir)).select("ping", "topic", "partition", "seq")


@query
def stream_arrival_order(spark, sf_dir):
    """The same over micro-batches in which one partition runs ahead of the others."""
    out = f"{shared_dir(spark)}/arrival-{uuid.uuid4().hex}"
    rows = _partitioned(spark, sf_dir)
    merged = arrival.Arrival(out, partitions=3)
    ahead = F.when(F.col("topic") == "b", F.col("ping") - 500).otherwise(F.col("ping"))
    parts = [p.drop("_due") for p in _slices(rows.withColumn("_due", ahead), "_due")]
    for i, part in enumerate([*parts, rows.limit(0)]):
        held = Held(spark, out)
        tables.write_batch(merged.release(part, i, held, end=i == len(parts)), f"{out}/released", i)
        held.release()
    return tables.read_batches(spark, f"{out}/released").select("ping", "topic", "partition", "seq")


@query
def latest_versions(spark, sf_dir):
    """The latest state after upserts, merged while it grew."""
    table = Versioned(spark, f"{shared_dir(spark)}/latest-{uuid.uuid4().hex}", "taxi_id", most_parts=2)
    for i, part in enumerate(_slices(cut(_processed(spark, sf_dir)))):
        table.upsert(state.latest_per_taxi(part), i)
    return table.read().select("taxi_id", "seq", "trip_status", "speed", "avg_speed", "total_distance_km")


@query
def stored_fleet_trend(spark, sf_dir):
    parts = tables.read_batches(spark, _run_pipeline(spark, sf_dir, True) + "/trends/fleet_metrics")
    return trends.fleet_trend_of_parts(parts)


@query
def stored_incident_trend(spark, sf_dir):
    parts = tables.read_batches(spark, _run_pipeline(spark, sf_dir, False) + "/trends/alerts")
    return trends.incident_trend_of_parts(parts)


@query
def stored_last_50(spark, sf_dir):
    path = f"{shared_dir(spark)}/log-{uuid.uuid4().hex}"
    for i, part in enumerate(_slices(cut(_log(spark, sf_dir)))):
        tables.write_log_batch(part, path, i)
    return alerts.last_incidents(tables.newest_log_rows(spark, path, 50))


@query
def stored_points(spark, sf_dir):
    """Points of one week, read back from the table by day."""
    path = f"{shared_dir(spark)}/points-{uuid.uuid4().hex}"
    tables.write_points(points_taxi(spark, sf_dir), path)
    week = 7 * 86_400_000
    return tables.read_points(spark, path, EPOCH_MS_2024_01_01 + week, EPOCH_MS_2024_01_01 + 2 * week)


@query
def topic_messages(spark, sf_dir):
    """Processed messages appended to a topic in three partitions, and read back."""
    from trackflow.schema import PROCESSED_MESSAGE

    received = (F.col("sent_at_utc_ms") + 3).alias("received_at_utc_ms")
    texts = messages.processed_messages(_processed(spark, sf_dir).select("*", received))
    path = f"{shared_dir(spark)}/topics-{uuid.uuid4().hex}"
    topiclog.append_to_topic(texts, path, "processed", partitions=3, batch=0)
    parsed = topiclog.read_topic(spark, path, "processed").withColumn("_m", messages.parse_json(F.col("value"), PROCESSED_MESSAGE))
    return parsed.select("key", "_m.*").drop(messages.CORRUPT)


@query
def benchmark_report(spark, sf_dir):
    path = f"{shared_dir(spark)}/report-{uuid.uuid4().hex}"
    msgs = _messages(spark, sf_dir)
    series = benchmark.latency_windows(msgs, Settings(bench_window_ms=86_400_000))
    tables.write_report(series, benchmark.run_summary(msgs), path)
    return tables.read_report(spark, path, series.schema)


@query
def stream_inactive_trips(spark, sf_dir):
    pipeline.use_rocksdb(spark)
    return _run(spark, stream_inactivity.inactive_stream(stream_pings(spark, sf_dir)))
