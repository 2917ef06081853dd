"""Keyed tables that change while they are read: parts, and a manifest for each version.

A version is a list of folders of rows; a later folder's row replaces an earlier one's of the same key.
Writing adds a folder with the changed rows and then a manifest, which becomes visible by one rename:
readers take the newest manifest and see all of a version or nothing of it. When a version has too many
folders, the write merges the later ones, and with them each earlier one that is not much larger than
all after it: the folders stay few, and a row is rewritten a logarithmic number of times. Folders that no
recent version names are deleted.

Files are handled through Hadoop's file systems, so the path may be in any store that Spark reads.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "_version"


class Folder:
    """Small text files and sub-folders of a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        if not self.fs.exists(self._at("")):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self._at(""))]
        return sorted(n for n in names if n[0] not in "._")

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file appears whole, under a name that was free."""
        hidden = self._at(f".{name}-{uuid.uuid4().hex}")
        stream = self.fs.create(hidden)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(hidden, self._at(name)):
            raise OSError(f"cannot create {name} in {self.path}")

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


@dataclass(frozen=True)
class Manifest:
    version: int
    parts: tuple[tuple[str, int], ...]  # folder and rows, oldest first
    schema: str


class Versioned:
    """A table with one row per key, changed by numbered writes (the ids of micro-batches)."""

    def __init__(self, spark: SparkSession, path: str, key: str, most_parts: int = 16, keep_versions: int = 20):
        self.spark, self.path, self.key = spark, path, key
        self.most_parts, self.keep_versions = most_parts, keep_versions
        self.manifests, self.folders = Folder(spark, f"{path}/versions"), Folder(spark, f"{path}/parts")

    def manifest(self, upto: int | None = None) -> Manifest | None:
        """The newest version, or the newest one up to a number; of a repeated write the last attempt."""
        names = [n for n in self.manifests.names() if upto is None or int(n.split("-")[0]) <= upto]
        if not names:
            return None
        found = json.loads(self.manifests.read(names[-1]))
        return Manifest(found["version"], tuple((p, n) for p, n in found["parts"]), found["schema"])

    def read(self, upto: int | None = None) -> DataFrame | None:
        """Rows of a version; None before the first one."""
        manifest = self.manifest(upto)
        return None if manifest is None else self._merged(manifest).drop(VERSION)

    def rows(self, upto: int | None = None) -> int:
        """Rows in the folders of a version, replaced ones included, without a job."""
        manifest = self.manifest(upto)
        return sum(n for _, n in manifest.parts) if manifest else 0

    def _merged(self, manifest: Manifest) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest.schema))
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/parts/{p}" for p, _ in manifest.parts])
        if len(manifest.parts) == 1:
            return rows
        names = [c for c in rows.columns if c != self.key]
        newest = rows.groupBy(self.key).agg(F.max_by(F.struct(*names), VERSION).alias("_row"))
        return newest.select(self.key, "_row.*")

    def _write(self, rows: DataFrame, version: int) -> tuple[str, int]:
        name = f"{version:012d}-{uuid.uuid4().hex}"
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/parts/{name}")
        return name, seen.get["n"]

    def upsert(self, changes: DataFrame, version: int) -> Manifest:
        """Rows of changed keys, one per key, as the next version. A repeated write takes the place of
        its former attempt, as it starts from the version before."""
        before = self.manifest(version - 1)
        rows = changes.withColumn(VERSION, F.lit(version).cast("bigint"))
        parts = (*(before.parts if before else ()), self._write(rows, version))
        manifest = Manifest(version, parts, rows.schema.json())
        if len(parts) > self.most_parts:
            at = self._tail([n for _, n in parts])
            tail = Manifest(version, parts[at:], manifest.schema)
            manifest = Manifest(version, (*parts[:at], self._write(self._merged(tail), version)), manifest.schema)
        # A later attempt of a version sorts after the former one.
        attempts = sum(int(n.split("-")[0]) == version for n in self.manifests.names())
        text = json.dumps({"version": version, "parts": manifest.parts, "schema": manifest.schema})
        self.manifests.write(f"{version:012d}-{attempts:06d}", text)
        self._tidy()
        return manifest

    def _tail(self, rows: list[int]) -> int:
        """From which folder on to merge: half of them at least, and then each that is no more than
        twice as large as all after it together."""
        at, total = len(rows) - 1, rows[-1]
        while at and (at > self.most_parts // 2 or rows[at - 1] <= 2 * total):
            at -= 1
            total += rows[at]
        return at

    def _tidy(self) -> None:
        """Keep the last versions and the folders that they name."""
        names = self.manifests.names()
        kept = names[-self.keep_versions :]
        if len(names) == len(kept):
            return
        wanted = {p for n in kept for p, _ in json.loads(self.manifests.read(n))["parts"]}
        for name in names[: -self.keep_versions]:
            self.manifests.delete(name)
        newest = int(kept[0].split("-")[0])
        for name in self.folders.names():
            # Folders of later numbers may belong to a write that has no manifest yet.
            if name not in wanted and int(name.split("-")[0]) < newest:
                self.folders.delete(name)
