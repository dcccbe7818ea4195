"""Logs that grow by numbered batches, one folder each.

Whoever appends first claims a number with a token that names what is appended, say a stream's id and its micro-batch. The
same token gets the same number again, and a batch that is complete is not written twice, so repeating an append after a
failure, at whichever point it failed, leaves one copy. A claim is a small file created under a number that nobody else has.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

BATCH = "batch"
CLAIMS = "_claims"


class BatchLog:
    """The log at ``path``, on any file system Spark reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._files = self._at().getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _names(self, *parts: str) -> list[str]:
        folder = self._at(*parts)
        return [s.getPath().getName() for s in self._files.listStatus(folder)] if self._files.exists(folder) else []

    def _token(self, number: int) -> str:
        stream = self._files.open(self._at(CLAIMS, str(number)))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def claim(self, token: str) -> int:
        """The number of the batch that ``token`` names: the one it has, or the next free one."""
        taken = sorted(int(name) for name in self._names(CLAIMS) if name.isdigit())
        for number in reversed(taken):
            if self._token(number) == token:
                return number
        written = [int(n.removeprefix(f"{BATCH}=")) for n in self._names() if n.startswith(f"{BATCH}=")]
        number = max([0, *taken, *written]) + 1
        while True:
            try:
                stream = self._files.create(self._at(CLAIMS, str(number)), False)
            except Py4JJavaError:
                if not self._files.exists(self._at(CLAIMS, str(number))):
                    raise
                number += 1
                continue
            stream.write(bytearray(token.encode()))
            stream.close()
            return number

    def append(self, rows: DataFrame, batch: int) -> bool:
        """Writes batch ``batch`` unless all of it is there already; tells whether it wrote. What a killed attempt left is
        replaced."""
        if batch < 1:
            raise ValueError(f"batches are numbered from 1, got {batch}")
        if self._files.exists(self._at(f"{BATCH}={batch}", "_SUCCESS")):
            return False
        rows.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch}")
        return True

    def number(self, batch: int | None) -> int:
        """``batch`` itself, or a number that nobody else has."""
        return self.claim(uuid.uuid4().hex) if batch is None else batch

    def read(self, schema: StructType) -> DataFrame:
        """All batches, with their number as the column ``batch``; none if nothing was appended yet."""
        whole = StructType([*schema.fields, StructField(BATCH, LongType())])
        if not any(name.startswith(f"{BATCH}=") for name in self._names()):
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).parquet(self.path)
