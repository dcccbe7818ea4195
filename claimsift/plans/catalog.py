"""The tables of a run in the session catalog, so that other sessions find them by name.

The files are those that the run has written; registering them moves no row. Each table says in its properties which layer
it belongs to, and rows are added to it only if their schema is that of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from claimsift.plans.tables import TABLES, Workspace
from claimsift.schemas import SOURCES

LAYER = "quality"
#: Layer of each table but the sources, which are ``bronze``. The serving table is left out: its files change with each
#: snapshot, and ``serving.live_table`` resolves them.
LAYERS = {
    "latest_delivery": "silver", "enriched_requests": "silver", "customer_refund_history": "silver",
    "household_activity": "silver", "customer_360": "gold", "case_decisioning": "gold", "segment_summary": "gold",
}


class SchemaMismatch(ValueError):
    """Rows whose columns are not those of the table they are meant for."""


def layer_of(table: str) -> str:
    return "bronze" if table in SOURCES else LAYERS[table]


def _quoted(*names: str) -> str:
    return ".".join(f"`{name.replace('`', '``')}`" for name in names)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(run: Workspace, database: str) -> list[str]:
    """Registers every table of the run in ``database``, in place of tables of these names; the names registered."""
    spark = run.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    names = [name for name in (*SOURCES, *TABLES) if name in SOURCES or name in LAYERS]
    for name in names:
        df = run.table(name)
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(database, name)}")
        spark.sql(f"CREATE TABLE {_quoted(database, name)} ({columns}) USING parquet LOCATION {_literal(run.path_of(name))} "
                  f"TBLPROPERTIES ('{LAYER}' = '{layer_of(name)}')")
    return names


def properties(spark: SparkSession, database: str, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(database, table)}").collect()
    return {row["key"]: row["value"] for row in rows}


def _plain(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def append(df: DataFrame, database: str, table: str) -> None:
    """Adds rows to a registered table. Columns must have the table's names, order and types; nothing is cast, added or
    left out."""
    spark = df.sparkSession
    wanted, given = _plain(spark.table(_quoted(database, table)).schema), _plain(df.schema)
    if wanted != given:
        differing = [f"{name} {kind}" for name, kind in given if (name, kind) not in wanted]
        missing = [f"{name} {kind}" for name, kind in wanted if (name, kind) not in given]
        raise SchemaMismatch(f"{database}.{table}: unexpected {', '.join(differing) or 'order'}; missing {', '.join(missing) or 'none'}")
    df.write.insertInto(f"{database}.{table}")
