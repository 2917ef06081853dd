"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
import uuid
from datetime import datetime

from pyspark.sql import SparkSession

HEADLINE = [
    "clean_pings", "dedup_same_ts", "propagate_5s", "speed", "processed_stream", "all_alerts",
    "fleet_metrics_rows", "latest_taxis", "fleet_metrics_trend", "fleet_incident_trend",
    "taxi_speed_trend", "latency_windows", "latency_percentiles_by_load", "conflict_diffs",
    "replay_schedule_actual",
]


def session(cpus: str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trackflow")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stream_run(spark: SparkSession, folder: str, batches: int = 8) -> dict:
    """The whole streaming job over the events in several micro-batches: rows per second, and how
    long rows take from the start of their micro-batch until all its tables are written."""
    from trackflow.plans.fixture import events_to_pings
    from trackflow.session import shared_dir
    from trackflow.sources.streams import file_stream
    from trackflow.streaming import pipeline

    out = f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}"
    events = spark.read.parquet(f"{folder}/events.parquet")
    events.repartitionByRange(batches, "event_id").write.parquet(f"{out}/in")
    stream = file_stream(spark, f"{out}/in", events.schema, files_per_trigger=1)
    job = pipeline.start(events_to_pings(stream, events), f"{out}/tables", every=None, clock=pipeline.wall_clock_ms)
    job.awaitTermination()
    done = sorted((p["durationMs"]["triggerExecution"], p["numInputRows"]) for p in job.recentProgress if p["numInputRows"])
    rows, upto, at = sum(n for _, n in done), 0, {}
    for ms, n in done:
        upto += n
        at |= {q: ms / 1000 for q in (50, 95, 99) if q not in at and upto * 100 >= q * rows}
    return {
        "batches": len(done),
        "rows_per_s": round(rows / (sum(ms for ms, _ in done) / 1000)),
        **{f"p{q}_latency_s": v for q, v in at.items()},
    }


def paced_run(spark: SparkSession, folder: str, rate: int, seconds: int = 30) -> dict:
    """The job at the published load: so many rows a second, one file each. A row's latency is from its
    file's appearance until all tables of its micro-batch are written; the first, cold batch is apart."""
    import pyarrow.parquet as pq

    from trackflow.plans.fixture import events_to_pings
    from trackflow.session import shared_dir
    from trackflow.sources.streams import file_stream
    from trackflow.streaming import pipeline

    out = f"{shared_dir(spark)}/paced-{uuid.uuid4().hex}"
    events = spark.read.parquet(f"{folder}/events.parquet")
    table = pq.read_table(f"{folder}/events.parquet").slice(0, rate * (seconds + 1))
    os.makedirs(f"{out}/in")
    appeared = []

    def send(i: int) -> None:
        pq.write_table(table.slice(i * rate, rate), f"{out}/part-{i}")
        os.rename(f"{out}/part-{i}", f"{out}/in/part-{i:04d}.parquet")
        appeared.append(time.time())

    send(0)
    stream = file_stream(spark, f"{out}/in", events.schema)
    job = pipeline.start(events_to_pings(stream, events), f"{out}/tables", every="0 seconds", clock=pipeline.wall_clock_ms)
    while not any(p["numInputRows"] for p in job.recentProgress):
        time.sleep(0.1)
    began = time.time()
    for i in range(1, seconds + 1):
        time.sleep(max(began + i - time.time(), 0))
        send(i)
    job.processAllAvailable()
    done = []
    for p in job.recentProgress:
        if p["numInputRows"]:
            start = datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")).timestamp()
            done.append((p["numInputRows"] // rate, start + p["durationMs"]["triggerExecution"] / 1000))
    job.stop()
    latency, at = [], 0
    for files, end in done:
        latency += [end - t for t in appeared[at : at + files]]
        at += files
    warm = sorted(latency[done[0][0] :])
    shares = {f"p{q}_latency_s": round(warm[min(len(warm) * q // 100, len(warm) - 1)], 3) for q in (50, 95, 99)}
    return {"rows_per_s": rate, "batches": len(done), "cold_s": round(latency[0], 3), **shares}


def main() -> None:
    from trackflow.plans.queries import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    # Warm up the JVM and the code generator on the smallest plan of the chain.
    QUERIES["processed_stream"](spark, folder).write.format("noop").mode("overwrite").save()
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rsplit("sf", 1)[-1],
                "events": events,
                "chain_events_per_s": round(events / times["processed_stream"]),
                "stream": stream_run(spark, folder),
                "stream_paced": [paced_run(spark, folder, rate) for rate in (40, 120)],
            }
        )
    )


if __name__ == "__main__":
    main()
