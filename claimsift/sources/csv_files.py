"""CSV source and sink of the nine source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from claimsift.schemas import SOURCES


#: Column of ``read_source`` with the raw line of a damaged row, NULL in all others.
DAMAGED = "_damaged"


def read_source(
    spark: SparkSession, path: str, table: str, infer_schema: bool = False, with_damaged: bool = False,
) -> DataFrame:
    """The table ``table`` from a CSV file or a directory of CSV files at ``path``.

    Columns are bound by the names in the header: any order will do, columns the table does not have are left out, and
    a missing one raises. Files of one directory whose headers differ raise when they are read. The fixed types spare
    the pass over the files that inference costs; only a header is read ahead.

    A value that cannot be read as its type is NULL. ``with_damaged`` adds the raw line of rows that have one, or that have
    too few or too many fields, as the column ``DAMAGED``; read all columns with it, since fields that are not read are not
    looked at.
    """
    reader = spark.read.option("header", True)
    if infer_schema:
        return reader.option("inferSchema", True).csv(path)
    wanted = SOURCES[table]
    header = reader.csv(path).columns
    missing = [name for name in wanted.fieldNames() if name not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)} of {table}")
    known = set(wanted.fieldNames())
    schema = StructType([wanted[name] if name in known else StructField(name, StringType()) for name in header])
    if with_damaged:
        schema.add(DAMAGED, StringType())
        reader = reader.option("columnNameOfCorruptRecord", DAMAGED)
    columns = [*wanted.fieldNames(), *([DAMAGED] if with_damaged else [])]
    return reader.schema(schema).option("enforceSchema", False).csv(path).select(*columns)


def write_source(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Replace ``path`` with ``df`` as a directory of CSV files with a header each."""
    df.write.mode("overwrite").option("header", True).csv(path, compression=compression)


def source_path(spark: SparkSession, base: str, table: str) -> str:
    """``base/table`` or ``base/table.csv``, whichever exists; works on any file system Spark can reach."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for candidate in (f"{base}/{table}.csv", f"{base}/{table}"):
        path = jvm.org.apache.hadoop.fs.Path(candidate)
        if path.getFileSystem(conf).exists(path):
            return candidate
    raise FileNotFoundError(f"neither {base}/{table}.csv nor {base}/{table} exists")
