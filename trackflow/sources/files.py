"""Raw trajectory files: headerless CSV lines in a folder or inside zip archives."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.operators.quality import REQUIRED, require_columns
from trackflow.schema import RAW_CSV

LINES_PER_BATCH = 50_000
SMALLEST = 22  # bytes of an empty archive
MEMBER_BYTES = 256 << 20  # larger members are read twice instead of being held in memory
# What a broken archive or member raises. Failures to open or read a file are not among them: those
# fail the task, which Spark runs again, instead of silently leaving out a good file.
BROKEN = (zipfile.BadZipFile, zlib.error, NotImplementedError)
_SCAN = "value string, archive string, file string, line bigint, error string"


def _columns(lines: DataFrame, *position: str) -> DataFrame:
    """Split text lines into the four columns; what does not parse becomes null."""
    parts = F.split("value", ",")
    return lines.select(
        *[
            F.trim(F.get(parts, F.lit(i))).try_cast(f.dataType).alias(f.name)
            for i, f in enumerate(RAW_CSV.fields)
        ],
        "file", *position,
    )


def read_folder(spark: SparkSession, path: str, file: str | None = None) -> DataFrame:
    """Every ``.txt`` file below ``path``; ``line`` orders the rows of a file across its splits.

    Lines come in order within a split, and the running id rises within a partition, so the split's
    start and the id order the lines of a file however many tasks read it.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", file or "*.txt")
    lines = reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("line"),
    )
    return _columns(lines.where(F.trim("value") != ""), "line")


def _open(path: str):
    """Seekable input for a local or remote path, so that only the needed bytes are read.

    An address that cannot be opened raises."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(_known(path))
    return system.open_input_file(inner)


def _known(path: str) -> str:
    """The address as Arrow spells it."""
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = path.replace("file:/", "file:///", 1)
    elif path.startswith("s3a://"):
        path = path.replace("s3a://", "s3://", 1)
    return path


def _create(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(_known(path))
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inner)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of the text members of each archive, or why it has none."""
    for batch in batches:
        found: list[tuple[str, str | None, str | None]] = []
        for path in batch["path"].to_pylist():
            with _open(path) as raw:
                try:
                    if raw.size() < SMALLEST:
                        raise zipfile.BadZipFile("File is not a zip file")
                    names = zipfile.ZipFile(raw).namelist()
                except BROKEN as error:
                    found.append((path, None, str(error)))
                    continue
            found += [(path, name, None) for name in names if name.endswith(".txt")]
        columns = [pa.array([f[i] for f in found], pa.string()) for i in range(3)]
        yield pa.RecordBatch.from_arrays(columns, ["archive", "member", "error"])


def _checked(archive: zipfile.ZipFile, member: str):
    """The member as a stream whose checksum has been seen, which is only known at its end."""
    if archive.getinfo(member).file_size <= MEMBER_BYTES:
        return io.BytesIO(archive.read(member))
    with archive.open(member) as stream:
        while stream.read(1 << 20):
            pass
    return archive.open(member)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of each member in batches; a broken member gives one row with its error instead."""
    for batch in batches:
        places = (batch[c].to_pylist() for c in ("archive", "member", "error"))
        for path, member, error in zip(*places, strict=True):
            if error is None:
                with _open(path) as raw, zipfile.ZipFile(raw) as archive:
                    try:
                        stream = _checked(archive, member)
                    except BROKEN as reason:
                        error = str(reason)
                    else:
                        values, first = [], 0
                        for text in stream:
                            values.append(text.decode("utf-8", "replace").rstrip("\r\n"))
                            if len(values) == LINES_PER_BATCH:
                                yield _batch(values, path, member, first)
                                values, first = [], first + LINES_PER_BATCH
                        yield _batch(values, path, member, first)
            if error is not None:
                yield _batch([None], path, member, 0, error)


def _batch(values: list, archive: str, member: str | None, first: int, error: str | None = None) -> pa.RecordBatch:
    n = len(values)
    columns = [
        pa.array(values, pa.string()),
        pa.array([archive] * n, pa.string()),
        pa.array([member] * n, pa.string()),
        pa.array(range(first, first + n), pa.int64()),
        pa.array([error] * n, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["value", "archive", "file", "line", "error"])


def _scan_zips(spark: SparkSession, path: str, member: str | None) -> DataFrame:
    """Archives are only listed through the binary source (their content column is never read); each
    task then seeks to its own members, so one large archive is read by many tasks."""
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    members = archives.select("path").mapInArrow(_members, "archive string, member string, error string")
    if member is not None:
        members = members.where(F.col("member") == member)
    tasks = spark.sparkContext.defaultParallelism * 4
    return members.repartition(tasks, "archive", "member").mapInArrow(_lines, _SCAN)


def read_zips(spark: SparkSession, path: str, member: str | None = None) -> DataFrame:
    """Text members of every ``*.zip`` below ``path``, one task per group of members.

    Broken archives and members are left out as a whole; ``rejected_zips`` names them."""
    lines = _scan_zips(spark, path, member).where(F.col("error").isNull())
    return _columns(lines.where(F.trim("value") != ""), "line")


def rejected_zips(spark: SparkSession, path: str, member: str | None = None) -> DataFrame:
    """(archive, file, error) of what ``read_zips`` leaves out; file is null for a whole archive."""
    return _scan_zips(spark, path, member).where(F.col("error").isNotNull()).select("archive", "file", "error")


def write_zips(rows: DataFrame, folder: str) -> DataFrame:
    """(archive, files): raw rows (four columns, file, line) as archives of a text member per file.

    A task writes one archive, line by line; it holds the files whose names hash to the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        target, archive, member, name, files = None, None, None, None, 0
        address = f"{folder}/part-{TaskContext.get().partitionId():05d}.zip"
        for batch in batches:
            for file, value in zip(batch["file"].to_pylist(), batch["value"].to_pylist(), strict=True):
                if archive is None:
                    target = _create(address)
                    archive = zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED)
                if file != name:
                    if member is not None:
                        member.close()
                    member, name, files = archive.open(file, "w", force_zip64=True), file, files + 1
                member.write(value.encode() + b"\n")
        if archive is not None:
            member.close()
            archive.close()
            target.close()
            yield pa.RecordBatch.from_pydict({"archive": pa.array([address]), "files": pa.array([files], pa.int64())})

    names = [f.name for f in RAW_CSV.fields]
    value = F.concat_ws(",", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names])
    texts = rows.select("file", "line", value.alias("value"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = texts.repartition(tasks, "file").sortWithinPartitions("file", "line").select("file", "value")
    return placed.mapInArrow(run, "archive string, files bigint")


def read_table(spark: SparkSession, path: str, required: set[str] = REQUIRED) -> DataFrame:
    """A Parquet table that must have the given columns."""
    return require_columns(spark.read.parquet(path), required)
