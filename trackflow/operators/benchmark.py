"""Latency and throughput analysis of processed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.config import DEFAULTS, Settings
from trackflow.functions.geo import performance_zone
from trackflow.functions.numbers import half_up_ratio, int_div, latency_seconds
from trackflow.operators.ordered import Ordered
from trackflow.operators.quantiles import percentiles

TIME = "processed_at_utc_ms"


def messages(processed: DataFrame, limit: int | None = None) -> DataFrame:
    """Complete messages, the first ``limit`` by processed time if a limit is asked for."""
    rows = processed.where(F.col(TIME).isNotNull() & F.col("taxi_id").isNotNull())
    rows = rows.select("seq", "taxi_id", "sent_at_utc_ms", TIME)
    return rows if limit is None else rows.orderBy(TIME, "seq").limit(limit)


def _latency_ms():
    ms = F.col(TIME) - F.col("sent_at_utc_ms")
    return F.when(ms >= 0, ms)


def latency_per_message(msgs: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Position of each message in processed-time order and its latency, if not negative.

    Numbered in two steps without a global window: the number of messages before each millisecond,
    plus the place within it.
    """
    counts = msgs.groupBy(F.col(TIME).alias("_ms")).agg(F.count(F.lit(1)).alias("_n"))
    before = Ordered.globally(counts, "_ms", cfg.max_group_rows).sum_since(None, _upto=F.col("_n"))
    before = before.rows().select("_ms", (F.col("_upto") - F.col("_n")).alias("_before"))
    rows = Ordered.by_key(msgs, TIME, "seq", cfg.max_group_rows)
    rows = rows.sum_since(None, _place=F.lit(1).cast("bigint")).rows()
    rows = rows.join(before, F.col(TIME) == F.col("_ms"))
    seconds = latency_seconds(F.col(TIME), F.col("sent_at_utc_ms"))
    return rows.where(_latency_ms().isNotNull()).select(
        (F.col("_before") + F.col("_place")).alias("record_number"),
        seconds.alias("latency_s"),
        performance_zone(seconds).alias("zone"),
        F.date_format(F.timestamp_millis(TIME), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("processed_at"),
    )


def _windows(msgs: DataFrame, cfg: Settings) -> DataFrame:
    """One row per window from the first to the last message, with its own counts."""
    width = cfg.bench_window_ms
    window = int_div(F.col(TIME), width)
    zero = F.lit(0).cast("bigint")
    own = msgs.groupBy(window.alias("w")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.count(_latency_ms()).alias("samples"),
        F.coalesce(F.sum(_latency_ms()), zero).alias("latency_ms"),
    )
    first_seen = msgs.groupBy("taxi_id").agg(F.min(TIME).alias(TIME))
    taxis = first_seen.groupBy(window.alias("w")).agg(F.count(F.lit(1)).alias("new_taxis"))
    first, last = msgs.agg(F.min(window), F.max(window)).first()
    spine = msgs.sparkSession.range(first or 0, (last + 1) if last is not None else 0)
    parts = spine.select(F.col("id").alias("w"))
    for part in (own, taxis):
        parts = parts.unionByName(part, allowMissingColumns=True)
    names = ["messages", "samples", "latency_ms", "new_taxis"]
    return parts.groupBy("w").agg(*[F.coalesce(F.sum(n), zero).alias(n) for n in names])


def latency_windows(msgs: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Per window, empty ones included: taxis and messages so far, mean latency, samples."""
    rows = Ordered.globally(_windows(msgs, cfg), "w", cfg.max_group_rows)
    rows = rows.sum_since(
        None, cumulative_taxi_count=F.col("new_taxis"), total_messages=F.col("messages")
    ).rows()
    start = F.col("w") * cfg.bench_window_ms
    hundredths = half_up_ratio(F.col("latency_ms") * 100, F.col("samples"))
    return rows.select(
        start.alias("window_start_utc_ms"),
        (start + cfg.bench_window_ms).alias("window_end_utc_ms"),
        "cumulative_taxi_count", "total_messages",
        F.when(F.col("samples") > 0, hundredths / 100.0).otherwise(0.0).alias("mean_latency_ms"),
        F.col("samples").alias("latency_samples"),
        F.concat(
            F.date_format(F.timestamp_millis(start), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")
        ).alias("timestamp_utc"),
    )


def _latency_histogram(msgs: DataFrame, cfg: Settings) -> DataFrame:
    """Messages per (window, latency in ms): combined before the exchange, bounded per window."""
    window = int_div(F.col(TIME), cfg.bench_window_ms)
    known = msgs.select(window.alias("w"), _latency_ms().alias("ms")).where(F.col("ms").isNotNull())
    return known.groupBy("w", "ms").agg(F.count(F.lit(1)).alias("n"))


def _taxis_so_far(windows: DataFrame, cfg: Settings) -> DataFrame:
    sampled = windows.where(F.col("latency_samples") > 0)
    w = int_div(F.col("window_start_utc_ms"), cfg.bench_window_ms)
    return sampled.select(w.alias("_w"), F.col("cumulative_taxi_count").alias("cumulative_taxis"))


def latency_percentiles_by_load(
    msgs: DataFrame, windows: DataFrame, cfg: Settings = DEFAULTS
) -> DataFrame:
    """Mean, p50, p95 and p99 latency for each number of taxis seen so far."""
    loads = _taxis_so_far(windows, cfg)
    counts = _latency_histogram(msgs, cfg).join(loads, F.col("w") == F.col("_w"))
    by_load = counts.groupBy("cumulative_taxis", "ms").agg(F.sum("n").alias("c"))
    at = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    out = percentiles(by_load, "cumulative_taxis", "ms", "c", at, cfg.max_group_rows)
    mean = half_up_ratio(F.col("total") * 1000, F.col("size")) / 1000000.0
    return out.select(
        "cumulative_taxis", mean.alias("mean_latency_s"),
        *[F.round(F.col(p) / 1000, 6).alias(f"{p}_latency_s") for p in at],
    )


def throughput_vs_latency(
    msgs: DataFrame, windows: DataFrame, cfg: Settings = DEFAULTS
) -> DataFrame:
    """Per window with samples: messages per second, mean and p95 latency, taxis so far."""
    window = int_div(F.col(TIME), cfg.bench_window_ms)
    load = msgs.groupBy(window.alias("_m")).agg(F.count(F.lit(1)).alias("messages"))
    stats = percentiles(
        _latency_histogram(msgs, cfg), "w", "ms", "n", {"p95": 0.95}, cfg.max_group_rows
    )
    rows = stats.join(load, F.col("w") == F.col("_m"))
    rows = rows.join(_taxis_so_far(windows, cfg), F.col("w") == F.col("_w"))
    return rows.select(
        (F.col("w") * cfg.bench_window_ms).alias("window_start_utc_ms"),
        F.round(F.col("messages") / (cfg.bench_window_ms / 1000.0), 6).alias("throughput_per_s"),
        (half_up_ratio(F.col("total") * 1000, F.col("size")) / 1000000.0).alias("mean_latency_s"),
        F.round(F.col("p95") / 1000, 6).alias("p95_latency_s"),
        "cumulative_taxis",
    )


def run_summary(msgs: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    first = int_div(F.min(TIME), cfg.bench_window_ms)
    last = int_div(F.max(TIME), cfg.bench_window_ms)

    def text(window):
        at = F.timestamp_millis(window * cfg.bench_window_ms)
        return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))

    return msgs.agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count_distinct("taxi_id").alias("total_unique_taxis"),
        F.lit(cfg.bench_window_ms).cast("bigint").alias("window_size_ms"),
        (last - first + 1).alias("total_windows"),
        text(first).alias("first_window_utc"),
        text(last).alias("last_window_utc"),
    )
