"""Topics as logs in a shared folder: a data source and sink for jobs without a broker.

A topic has partitions, a partition is a row of segments named by their first offset and their size.
Writers put segments aside in tasks and give them their offsets when all tasks are done, so a failed
attempt leaves nothing in the log. A micro-batch that is committed twice is appended once; if the
committing process dies half way, its messages may be there twice: consumers tell repeats by their id.

The reader closes a micro-batch when enough messages wait, or when the oldest has waited long enough
(options ``flush_rows``, ``flush_seconds``), as a consumer does that flushes by size or by time.

The folder must be reachable as files by the driver and all executors.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    DataSourceStreamWriter,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "topiclog"
MESSAGE = "key string, value string, topic string, partition int, offset bigint"
ASIDE, COMMITS = ".aside", ".commits"


class Topic:
    """The log of one topic."""

    def __init__(self, path: str, name: str):
        self.folder = Path(path) / name

    def partitions(self) -> list[int]:
        return sorted(int(p.name) for p in self.folder.glob("[0-9]*")) if self.folder.exists() else []

    def segments(self, partition: int) -> list[tuple[int, int, Path]]:
        """(first offset, messages, file), in order."""
        found = [(*map(int, f.stem.split("-")), f) for f in (self.folder / str(partition)).glob("*-*.jsonl")]
        return sorted(found)

    def end(self, partition: int) -> int:
        segments = self.segments(partition)
        return segments[-1][0] + segments[-1][1] if segments else 0

    def append(self, partition: int, aside: Path, size: int) -> None:
        home = self.folder / str(partition)
        home.mkdir(parents=True, exist_ok=True)
        aside.rename(home / f"{self.end(partition):020d}-{size}.jsonl")

    def read(self, partition: int, start: int, stop: int) -> Iterator[tuple]:
        for first, size, file in self.segments(partition):
            if first + size <= start or first >= stop:
                continue
            with file.open(encoding="utf-8") as lines:
                for offset, line in enumerate(lines, first):
                    if start <= offset < stop:
                        key, value = json.loads(line)
                        yield key, value, self.folder.name, partition, offset


@dataclass
class Slice(InputPartition):
    topic: str
    partition: int
    start: int
    stop: int


class _Reading:
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.topics = [t.strip() for t in options["topics"].split(",") if t.strip()]
        self.flush_rows = int(options.get("flush_rows", "1"))
        self.flush_seconds = float(options.get("flush_seconds", "0"))

    def ends(self) -> dict[str, int]:
        logs = {t: Topic(self.path, t) for t in self.topics}
        return {f"{t}/{p}": log.end(p) for t, log in logs.items() for p in log.partitions()}

    def slices(self, start: dict[str, int], stop: dict[str, int]) -> list[Slice]:
        found = []
        for name, end in sorted(stop.items()):
            topic, partition = name.rsplit("/", 1)
            if end > start.get(name, 0):
                found.append(Slice(topic, int(partition), start.get(name, 0), end))
        return found

    def read(self, part: Slice | None) -> Iterator[tuple]:
        if part is None:  # there are no partitions
            return iter(())
        return Topic(self.path, part.topic).read(part.partition, part.start, part.stop)


class BatchReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Slice]:
        return self.slices({}, self.ends())


class StreamReader(_Reading, DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.taken: dict[str, int] | None = None  # what the last micro-batch ends with
        self.waiting_since: float | None = None

    def initialOffset(self) -> dict[str, int]:
        return {}

    def latestOffset(self) -> dict[str, int]:
        ends = self.ends()
        taken = self.taken or {}
        waiting = sum(end - taken.get(name, 0) for name, end in ends.items())
        now = time.monotonic()
        if waiting and self.waiting_since is None:
            self.waiting_since = now
        # The first look after a (re)start cannot tell how long messages have been waiting.
        due = self.taken is None or waiting >= self.flush_rows
        due = due or (waiting > 0 and now - self.waiting_since >= self.flush_seconds)
        if due:
            self.taken, self.waiting_since = ends, None
        return dict(self.taken)

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Slice]:
        return self.slices(start, end)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int, str, int]]  # topic, partition, file set aside, messages


class _Writing:
    def __init__(self, options: dict[str, str], names: list[str]):
        self.path, self.topic = options["path"], options.get("topic")
        self.width = int(options.get("partitions", "1"))
        self.batch, self.names = options.get("batch"), names

    def write(self, rows: Iterator) -> Written:
        aside = Path(self.path) / ASIDE
        aside.mkdir(parents=True, exist_ok=True)
        name, sinks, sizes = uuid.uuid4().hex, {}, {}
        key_at, value_at = self.names.index("key"), self.names.index("value")
        for row in rows:
            key, value = row[key_at], row[value_at]
            partition = zlib.crc32((key or "").encode()) % self.width
            if partition not in sinks:
                sinks[partition] = (aside / f"{name}-{partition}").open("w", encoding="utf-8")
            sinks[partition].write(json.dumps([key, value]) + "\n")
            sizes[partition] = sizes.get(partition, 0) + 1
        for sink in sinks.values():
            sink.close()
        return Written([(self.topic, p, f"{name}-{p}", n) for p, n in sorted(sizes.items())])

    def append(self, messages: list[Written | None], batch: str | None) -> None:
        done = Path(self.path) / COMMITS / f"{self.topic}-{batch}"
        aside = Path(self.path) / ASIDE
        if batch is not None and done.exists():
            self.forget(messages)
            return
        for topic, partition, file, size in (f for m in messages if m for f in m.files):
            Topic(self.path, topic).append(partition, aside / file, size)
        if batch is not None:
            done.parent.mkdir(parents=True, exist_ok=True)
            done.touch()

    def forget(self, messages: list[Written | None]) -> None:
        for _, _, file, _ in (f for m in messages if m for f in m.files):
            (Path(self.path) / ASIDE / file).unlink(missing_ok=True)


class BatchWriter(_Writing, DataSourceWriter):
    def commit(self, messages: list[Written | None]) -> None:
        self.append(messages, self.batch)

    def abort(self, messages: list[Written | None]) -> None:
        self.forget(messages)


class StreamWriter(_Writing, DataSourceStreamWriter):
    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.append(messages, str(batchId))

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.forget(messages)


class TopicLog(DataSource):
    """Options: path; reading: topics, flush_rows, flush_seconds; writing: topic, partitions, batch."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MESSAGE

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(dict(self.options))

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(dict(self.options), schema.fieldNames())

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(dict(self.options), schema.fieldNames())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TopicLog)


def topic_stream(spark: SparkSession, path: str, topics: str, flush_rows: int = 1, flush_seconds: float = 0) -> DataFrame:
    """Messages of the topics as they come, in micro-batches closed by size or by time."""
    register(spark)
    reader = spark.readStream.format(FORMAT).option("path", path).option("topics", topics)
    return reader.option("flush_rows", flush_rows).option("flush_seconds", flush_seconds).load()


def read_topic(spark: SparkSession, path: str, topic: str) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).option("path", path).option("topics", topic).load()


def append_to_topic(messages: DataFrame, path: str, topic: str, partitions: int = 1, batch: int | None = None) -> None:
    """Append key and value; with the number of a batch, once however often it is tried."""
    register(messages.sparkSession)
    writer = messages.select("key", "value").write.format(FORMAT).mode("append")
    writer = writer.option("path", path).option("topic", topic).option("partitions", partitions)
    (writer if batch is None else writer.option("batch", batch)).save()


def topic_publisher(path: str, partitions: int = 1):
    """For the job's ``publish``: each kind of event to its own topic."""

    def publish(messages: DataFrame, topic: str, batch_id: int) -> None:
        append_to_topic(messages, path, topic, partitions, batch_id)

    return publish
