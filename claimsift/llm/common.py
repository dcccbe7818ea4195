"""Staged tables, packed arrays and running totals over a global order, shared by the operators."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

import claimsift
from claimsift.session import shared_folder, tune

U64 = np.uint64
#: Texts differ in length a hundred-thousandfold, so batches for Python are cut by size.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
_shipped: set[str] = set()
_discarded: list[list[str]] = []
_codec = pa.Codec("zstd", compression_level=1)


def staged(df: DataFrame, purpose: str, keep: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here, so lost executors never repeat it. With
    ``keep`` it outlives a block of ``discarding``."""
    spark = df.sparkSession
    path = f"{shared_folder(spark, 'llm')}/{purpose}"
    df.write.parquet(path)
    if _discarded and not keep:
        _discarded[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Deletes what is staged within when the block ends. For callers that have written by then what they need."""
    _discarded.append([])
    try:
        yield
    finally:
        for path in _discarded.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def parts(spark: SparkSession) -> int:
    """Pieces in which keyed work is dealt out: follows the number of shuffle partitions, which follows the data."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def ready(spark: SparkSession) -> SparkSession:
    """Session options of the library, and its modules on the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(claimsift.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="claimsift-")) / "claimsift_modules.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(app)
    if spark.conf.get(BATCH[0], None) != BATCH[1]:
        spark.conf.set(*BATCH)
    return tune(spark)


def _give_back() -> None:
    """Memory that this process has freed, back to the system: workers live on from stage to stage, and one that keeps the
    most it ever needed leaves less to everything else on its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable) -> Callable:
    """``run``, a function for ``mapInArrow``, which gives its memory back when it has ended."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()
    return whole


def lean_group(run: Callable) -> Callable:
    """The same for a function of ``applyInArrow``."""
    def whole(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            _give_back()
    return whole


def lean_groups(run: Callable) -> Callable:
    """The same for a function of two tables."""
    def whole(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            _give_back()
    return whole


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned integer arrays as compressed bytes, byte plane by byte plane, so that leading zeros cost nothing."""
    raw = [np.array([len(arrays), *map(len, arrays)], np.int64).tobytes()]
    for a in arrays:
        planes = np.ascontiguousarray(a).astype(U64, copy=False).view(np.uint8).reshape(-1, 8).T
        raw.append(np.ascontiguousarray(planes).tobytes())
    return squeeze(b"".join(raw))


def squeeze(body: bytes) -> bytes:
    return len(body).to_bytes(8, "little") + _codec.compress(body, asbytes=True)


def expand(packed: bytes) -> bytes:
    return _codec.decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)


def unpack(packed: bytes) -> list[np.ndarray]:
    body = expand(packed)
    count = int(np.frombuffer(body, np.int64, 1)[0])
    lengths = np.frombuffer(body, np.int64, count, 8)
    out, at = [], 8 * (1 + count)
    for n in lengths.tolist():
        planes = np.frombuffer(body, np.uint8, 8 * n, at).reshape(8, n)
        out.append(np.ascontiguousarray(planes.T).view(U64).reshape(n))
        at += 8 * n
    return out


def signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.int64)


def unsigned(a: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.asarray(a).astype(np.int64, copy=False).view(U64)


def running(df: DataFrame, order: list[Column], totals: dict[str, Column], purpose: str) -> DataFrame:
    """``df`` with inclusive running totals over a global order.

    The rows are sorted by range, so that no task holds more than its share whatever the keys, and written with the
    number of their range. Each range then sums its own rows, and what lies before it is added from a table of one row
    per range, which is all that a single task ever sees. Order by columns that tell rows apart: rows that tie
    throughout may swap places.
    """
    ranged = (
        df.select("*", *[value.alias(f"_add_{name}") for name, value in totals.items()])
        .repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
        .select("*", F.spark_partition_id().alias("_range"))
    )
    table = staged(ranged, purpose)
    here = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = table.groupBy("_range").agg(*[F.sum(f"_add_{name}").alias(f"_sum_{name}") for name in totals])
    offsets = sums.select("_range", *[
        F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_before_{name}") for name in totals])
    summed = table.select("*", *[F.sum(f"_add_{name}").over(here).alias(name) for name in totals])
    joined = summed.join(offsets, "_range")
    kept = [c for c in df.columns if c not in totals]
    return joined.select(*kept, *[(F.col(name) + F.col(f"_before_{name}")).alias(name) for name in totals])
