"""Streaming jobs: processed pings, alerts, latest state, fleet metrics, window counts."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trackflow.config import DEFAULTS, Settings
from trackflow.functions.messages import (
    alert_messages,
    event_seconds,
    fleet_messages,
    parse_messages,
    processed_messages,
)
from trackflow.operators import points
from trackflow.operators.alerts import all_alerts, incident_log
from trackflow.operators.fleet import as_differences, as_message, closing_rows, fleet_totals
from trackflow.operators.state import latest_per_taxi
from trackflow.operators.trends import fleet_parts, incident_parts
from trackflow.session import Held
from trackflow.sources.streams import batch_sink, kafka_stream, sink
from trackflow.sources.tables import write_batch, write_log_batch, write_point_batch
from trackflow.sources.versions import Folder, Versioned
from trackflow.streaming.arrival import Arrival
from trackflow.streaming.chain import PRIVATE, ChainStep

Publish = Callable[[DataFrame, str, int], None]
TASK_ROWS = 10_000  # rows of a micro-batch that are worth a task
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State of many taxis lives on disk, with only changes written at each checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def pings_from_messages(raw: DataFrame) -> DataFrame:
    """Typed pings of a stream of JSON texts with their arrival order in ``seq``."""
    rows, _ = parse_messages(raw)
    return rows.withColumns(
        {"event_s": event_seconds(F.col("timestamp")), "processed_at_utc_ms": F.col("received_at_utc_ms")}
    )


def start_rejects(raw: DataFrame, out: str, every: str | None = "1 second") -> StreamingQuery:
    """A table of the texts that are not JSON, with their place in the stream."""
    _, rejects = parse_messages(raw)
    return sink(rejects, f"{out}/_rejects_checkpoint", every=every, path=f"{out}/rejects").start()


def wall_clock_ms() -> int:
    return time.time_ns() // 1_000_000


def together(spark: SparkSession, *steps: Callable[[], object]) -> None:
    """Run independent jobs of a micro-batch side by side: each is small, and most of its time is waiting."""
    sessions = spark._jvm.org.apache.spark.sql.classic.SparkSession

    def run(step: Callable[[], object]) -> object:
        # A new thread knows nothing of the query's session, where data sources are looked up.
        sessions.setActiveSession(spark._jsparkSession)
        return step()

    with ThreadPoolExecutor(len(steps)) as pool:
        # Threads inherit the query's job group, so that stopping it stops their jobs.
        for done in [pool.submit(inheritable_thread_target(spark)(run), step) for step in steps]:
            done.result()


class FleetSink:
    """Fleet rows per micro-batch; the closing rows of one batch open the next.

    Totals need one global order, which micro-batches already are: rows of a later batch come
    after all rows of an earlier one.
    """

    def __init__(self, out: str, cfg: Settings = DEFAULTS):
        self.out, self.cfg = out, cfg

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        held = Held(batch.sparkSession, self.out)
        rows, closing = self.rows(batch, batch_id, held)
        write_batch(closing, f"{self.out}/fleet_state", batch_id)
        write_batch(rows, f"{self.out}/fleet", batch_id)
        held.release()

    def rows(self, batch: DataFrame, batch_id: int, hold: Held) -> tuple[DataFrame, DataFrame]:
        """(fleet rows of the batch, rows that open the next one)."""
        spark = batch.sparkSession
        rows, opening = batch, None
        if batch_id > 0:
            opening = spark.read.parquet(f"{self.out}/fleet_state/batch={batch_id - 1}")
            rows = batch.select(*_slim(batch)).unionByName(as_differences(opening))
        totals = hold(fleet_totals(rows, self.cfg, with_state=True, hold=hold))
        own = totals if opening is None else totals.join(
            F.broadcast(opening.select("seq")), "seq", "left_anti"
        )
        return own.drop("_base", "active", "ended", "transit", "metres"), closing_rows(totals)


def _slim(batch: DataFrame) -> list[str]:
    return ["seq", "taxi_id", "event_s", "processed_at_utc_ms", *PRIVATE]


class PipelineSink:
    """The chain and all its tables for each micro-batch; repeating a batch replaces its files.

    With ``publish(messages, topic, batch_id)`` the three kinds of events also leave as messages,
    at least once. With a ``clock`` the processed time is read when the chain has computed the
    batch, so that latency covers the processing.
    """

    def __init__(
        self, out: str, cfg: Settings = DEFAULTS, fleet: bool = True, publish: Publish | None = None,
        clock: Callable[[], int] | None = None,
    ):
        self.out, self.cfg, self.publish, self.clock = out, cfg, publish, clock
        self.chain = ChainStep(out, cfg)
        self.fleet = FleetSink(out, cfg) if fleet else None
        if publish is not None:
            cfg.require_topics()

    def __call__(self, pings: DataFrame, batch_id: int) -> None:
        spark, held = pings.sparkSession, Held(pings.sparkSession, self.out)
        names = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
        before = {n: spark.conf.get(n) for n in names}
        pings = pings.persist()  # counted, then computed: the source is read once
        # Planning anew between stages costs more than it gives in batches of a trigger's size; the
        # number of tasks is chosen at the start instead, by the rows that there are.
        tasks = min(int(before[names[1]]), max(self.chain.size(pings, batch_id) // TASK_ROWS, 1))
        spark.conf.set(names[0], "false")
        spark.conf.set(names[1], str(tasks))
        try:
            self._tables(pings, batch_id, held)
        finally:
            for name, value in before.items():
                spark.conf.set(name, value)
            pings.unpersist()
        held.release()

    def _tables(self, pings: DataFrame, batch_id: int, held: Held) -> None:
        spark = pings.sparkSession
        batch, states = self.chain.rows(pings, batch_id, held)
        if self.clock is not None:  # the rows have just been computed and written
            batch = batch.withColumn("processed_at_utc_ms", F.lit(self.clock()).cast("bigint"))
        shown = batch.drop(*PRIVATE)
        raised = all_alerts(shown)
        latest = latest_per_taxi(shown)
        steps = [
            lambda: self.chain.close(states, batch_id),
            lambda: write_batch(shown, f"{self.out}/processed", batch_id),
            lambda: write_log_batch(incident_log(raised), f"{self.out}/incidents", batch_id),
            lambda: Versioned(spark, f"{self.out}/latest", "taxi_id").upsert(latest, batch_id),
            lambda: write_point_batch(points.taxi_points(shown), f"{self.out}/points/taxi_metrics", batch_id),
            lambda: write_point_batch(points.alert_points(raised), f"{self.out}/points/alerts", batch_id),
            lambda: write_batch(incident_parts(points.alert_points(raised), self.cfg), f"{self.out}/trends/alerts", batch_id),
        ]
        if self.fleet is not None:
            steps.append(lambda: self._fleet(batch, batch_id, held))
        if self.publish is not None:
            steps.append(lambda: self.publish(processed_messages(shown), self.cfg.processed_topic, batch_id))
            steps.append(lambda: self.publish(alert_messages(raised), self.cfg.alerts_topic, batch_id))
        together(spark, *steps)

    def _fleet(self, batch: DataFrame, batch_id: int, held: Held) -> None:
        rows, closing = self.fleet.rows(batch, batch_id, held)
        metrics = points.fleet_points(rows)
        steps = [
            lambda: write_batch(closing, f"{self.out}/fleet_state", batch_id),
            lambda: write_batch(rows, f"{self.out}/fleet", batch_id),
            lambda: write_point_batch(metrics, f"{self.out}/points/fleet_metrics", batch_id),
            lambda: write_batch(fleet_parts(metrics, self.cfg), f"{self.out}/trends/fleet_metrics", batch_id),
        ]
        if self.publish is not None:
            steps.append(lambda: self.publish(fleet_messages(as_message(rows)), self.cfg.fleet_topic, batch_id))
        together(batch.sparkSession, *steps)


class MergedSink:
    """The job over messages of several partitions (topic, partition, offset): one arrival order first."""

    def __init__(self, arrival: Arrival, tables: PipelineSink):
        self.arrival, self.tables = arrival, tables

    def __call__(self, pings: DataFrame, batch_id: int, end: bool = False) -> None:
        held = Held(pings.sparkSession, self.tables.out)
        self.tables(held(self.arrival.release(pings, batch_id, held, end)), batch_id)
        held.release()

    def close(self, spark: SparkSession) -> None:
        """Hand on what waits for other partitions, as a last batch: the input has ended."""
        last = self.arrival.last_batch(spark)
        if last >= 0:
            self(self.arrival.nothing(spark, last), last + 1, end=True)


def kafka_publisher(servers: str) -> Publish:
    def publish(messages: DataFrame, topic: str, batch_id: int) -> None:
        writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
        writer.option("topic", topic).save()

    return publish


CLOSED = "closed"


def job_sink(
    out: str, cfg: Settings = DEFAULTS, fleet: bool = True, publish: Publish | None = None,
    clock: Callable[[], int] | None = None,
) -> PipelineSink | MergedSink:
    tables = PipelineSink(out, cfg, fleet, publish, clock)
    if cfg.source_partitions == 1:
        return tables
    return MergedSink(Arrival(out, cfg.source_partitions, cfg.source_idleness_s()), tables)


def start(
    pings: DataFrame, out: str, cfg: Settings = DEFAULTS, every: str | None = "1 second",
    fleet: bool = True, publish: Publish | None = None, clock: Callable[[], int] | None = None,
) -> StreamingQuery:
    """The whole job over a stream of typed pings; those of several partitions have topic, partition, offset."""
    if CLOSED in Folder(pings.sparkSession, out).names():
        raise ValueError(f"the input of {out} has ended")
    return batch_sink(pings, f"{out}/_checkpoint", job_sink(out, cfg, fleet, publish, clock), every).start()


def take_all(pings: DataFrame, out: str, cfg: Settings = DEFAULTS, **kwargs) -> None:
    """The whole job over a bounded input, to its end: nothing waits any more, and the job cannot go on."""
    start(pings, out, cfg, every=None, **kwargs).awaitTermination()
    sink = job_sink(out, cfg, **kwargs)
    if isinstance(sink, MergedSink):
        sink.close(pings.sparkSession)
    Folder(pings.sparkSession, out).write(CLOSED, "")


def start_from_messages(
    raw: DataFrame, out: str, cfg: Settings = DEFAULTS, every: str | None = "1 second",
    publish: Publish | None = None,
) -> list[StreamingQuery]:
    """The whole job over a stream of JSON texts: the chain with its tables, and the reject table."""
    pings = pings_from_messages(raw)
    return [start(pings, out, cfg, every, publish=publish, clock=wall_clock_ms), start_rejects(raw, out, every)]


def run(spark: SparkSession, cfg: Settings, servers: str, out: str) -> list[StreamingQuery]:
    """From settings to topics and tables: source, parse, chain, sinks."""
    cfg.require_topics()
    use_rocksdb(spark)
    raw = kafka_stream(spark, servers, cfg.source_topics, cfg=cfg)
    return start_from_messages(raw, out, cfg, publish=kafka_publisher(servers))
