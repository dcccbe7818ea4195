"""Parquet tables replaced as a whole or by partitions, with a pointer that readers follow.

Every write goes to a folder of its own below ``data``, so nothing that a reader may have open is touched. A snapshot is a
small file in ``log`` that names, for each partition, the folders that hold its rows now. It appears by one rename to the
next free number: a write that is killed before that leaves the table as it was, and of two writers that started from the
same snapshot only one finds the number free. Old snapshots and folders that no kept one names are deleted by ``expire``.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

WRITE = "write"


def bloom_filter(column: str) -> dict[str, str]:
    """Options of a parquet writer for a Bloom filter on ``column``, as large as its values need in each row group."""
    return {f"parquet.bloom.filter.enabled#{column}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


class Conflict(RuntimeError):
    """Another writer has published a snapshot meanwhile."""


@dataclass(frozen=True)
class Snapshot:
    """``folders``: partition directory to the writes that hold its rows; ``notes``: what a writer wants to remember."""

    version: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    notes: dict[str, object] = field(default_factory=dict)


class SnapshotTable:
    """A table at ``path`` of the given schema, partitioned by ``partitions``; works on any file system Spark reaches.

    ``lookup`` names a column that rows are looked up by: its row groups get Bloom filters. Rows of a file are sorted by
    ``order``, so that the statistics of row groups tell which values of it they hold.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, partitions: tuple[str, ...],
                 lookup: str | None = None, order: tuple[Column, ...] = ()) -> None:
        self.spark, self.path, self.schema, self.partitions = spark, path.rstrip("/"), schema, partitions
        self.options, self.order = bloom_filter(lookup) if lookup else {}, order
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join([self.path, *[p for p in parts if p]]))

    def _versions(self) -> list[int]:
        folder = self._path("log")
        if not self._fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name[:1].isdigit())

    def _load(self, version: int) -> Snapshot:
        stream = self._fs.open(self._path("log", f"{version:020}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Snapshot(version, **json.loads(text))

    def current(self) -> Snapshot:
        """The latest snapshot; one without rows, numbered 0, if nothing was written yet."""
        versions = self._versions()
        return self._load(versions[-1]) if versions else Snapshot()

    def read(self, snapshot: Snapshot | None = None) -> DataFrame:
        """The rows of a snapshot, the latest by default. Filters on partition columns prune folders."""
        snapshot = snapshot or self.current()
        paths = [f"{self.path}/data/{WRITE}={write}/{part}" for part, writes in sorted(snapshot.folders.items())
                 for write in writes]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*paths).select(*self.schema.fieldNames())

    def folder_of(self, row: Row) -> str:
        """The directory of the partition that ``row`` belongs to."""
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        return "/".join(escape(name, row[name]) for name in self.partitions)

    def write_files(self, df: DataFrame, gather: bool = True) -> dict[str, list[str]]:
        """Writes rows without publishing them; their partitions with the one folder that holds each.

        The rebalance hint brings the rows of a partition together without forcing a large one into a single task:
        adaptive execution splits big partitions and merges small ones. Without ``gather`` nothing is shuffled to be written:
        each task sorts the rows it has and writes a file for every partition among them, which makes more and smaller files.
        """
        write = uuid.uuid4().hex
        target = self._path("data", f"{WRITE}={write}")
        rows = df.select(*self.schema.fieldNames())
        if gather:
            rows = rows.hint("rebalance", *self.partitions)
        if self.order:
            # The writer sorts by the partitions itself, and forgets this order, unless it sees that they are never null; it
            # writes an empty value as a null one.
            set_values = {c: F.coalesce(c, F.lit("")) for c in self.partitions if self.schema[c].dataType == StringType()}
            rows = rows.withColumns(set_values).sortWithinPartitions(*self.partitions, *self.order)
        rows.write.options(**self.options).partitionBy(*self.partitions).parquet(target.toString())
        pattern = self._path("data", f"{WRITE}={write}", *[f"{name}=*" for name in self.partitions])
        prefix = target.toUri().getPath()
        found = [status.getPath().toUri().getPath() for status in self._fs.globStatus(pattern)]
        return {path.removeprefix(prefix).strip("/"): [write] for path in found}

    def publish(self, folders: dict[str, list[str]], after: Snapshot, notes: dict[str, object] | None = None) -> Snapshot:
        """Makes ``folders`` the table, unless another snapshot has followed ``after``."""
        made = Snapshot(after.version + 1, folders, after.notes if notes is None else notes)
        body = json.dumps({"folders": made.folders, "notes": made.notes}, sort_keys=True)
        draft = self._path("log", f".{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(draft)
        try:
            stream.write(bytearray(body.encode()))
        finally:
            stream.close()
        final = self._path("log", f"{made.version:020}.json")
        files = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            # Without the option to overwrite, the rename fails if the number is taken.
            files.rename(draft, final, self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 0))
        except Exception as problem:
            self._fs.delete(draft, False)
            if self._fs.exists(final):
                raise Conflict(f"{self.path} has changed since version {after.version}") from problem
            raise
        return made

    def replace(self, df: DataFrame, notes: dict[str, object] | None = None, gather: bool = True) -> Snapshot:
        """``df`` in place of all rows. It may read the table itself. ``gather``: see ``write_files``."""
        before = self.current()
        return self.publish(self.write_files(df, gather), before, notes or {})

    def expire(self, keep: int = 2, min_age_seconds: float = 86_400.0) -> list[str]:
        """Deletes all but the last ``keep`` snapshots, and folders that none of those names and that are old enough not to
        belong to a write under way. Returns the folders deleted."""
        versions = self._versions()
        used = {write for v in versions[-keep:] for writes in self._load(v).folders.values() for write in writes}
        for version in versions[:-keep]:
            self._fs.delete(self._path("log", f"{version:020}.json"), False)
        folder, gone = self._path("data"), []
        latest = 1000 * (time.time() - min_age_seconds)
        for status in self._fs.listStatus(folder) if self._fs.exists(folder) else []:
            write = status.getPath().getName().removeprefix(f"{WRITE}=")
            if write not in used and status.getModificationTime() <= latest:
                self._fs.delete(status.getPath(), True)
                gone.append(write)
        return gone
