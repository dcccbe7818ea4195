"""The tables of a run and what each is built from."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimsift.operators import enrich, history, household, profiles, scoring, serving
from claimsift.operators.quality import EXPECTATIONS, apply_expectations, log_quality
from claimsift.schemas import SOURCES
from claimsift.session import bound_tasks, tune
from claimsift.settings import Settings
from claimsift.sources.csv_files import DAMAGED, read_source, source_path
from claimsift.sources.snapshots import bloom_filter


@dataclass(frozen=True)
class Table:
    """``build`` takes the tables named in ``inputs``, in that order, and the settings."""

    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]


TABLES: dict[str, Table] = {
    "latest_delivery": Table(("delivery_events",), lambda deliveries, _: enrich.latest_delivery(deliveries)),
    "enriched_requests": Table(
        ("refund_requests", "order_history", "customer_profiles", "product_catalog", "latest_delivery",
         "refund_policies"),
        enrich.enrich_requests),
    "customer_refund_history": Table(("refund_requests",), history.customer_refund_history),
    "household_activity": Table(
        ("refund_requests", "household_mappings"),
        household.household_activity),
    "customer_360": Table(
        ("customer_profiles", "customer_refund_history", "household_mappings", "household_activity"),
        lambda customers, past, members, activity, s: profiles.customer_360(
            customers, past, members, activity, **s.hot_keys)),
    "case_decisioning": Table(
        ("enriched_requests", "customer_refund_history", "household_mappings", "household_activity"),
        lambda enriched, past, members, activity, s: scoring.case_decisioning(
            enriched, past, members, activity, s, **s.hot_keys)),
    "segment_summary": Table(("case_decisioning",), lambda cases, _: scoring.segment_summary(cases)),
    "live_cases": Table(("case_decisioning",), lambda cases, _: serving.live_cases(cases)),
}


#: Rule of every source: no field of the row is damaged.
READABLE = "readable_row"
#: Keys by which single rows of a table are looked up.
LOOKED_UP_BY = {"customer_360": "customer_id"}


class Workspace:
    """The tables of one run, each written once below ``out`` and read back from there.

    A written table cuts the lineage: losing executors later never repeats the work behind it. Reading it back also
    gives every join inputs that come straight from a scan, which is what adaptive execution needs to split skewed keys.
    """

    def __init__(self, spark: SparkSession, locate: Callable[[str], str], out: str, settings: Settings) -> None:
        self.spark, self.settings = bound_tasks(tune(spark)), settings
        self._locate, self._out = locate, out.rstrip("/")
        self._ready: dict[str, DataFrame] = {}
        self.dropped: dict[str, Observation] = {}
        self._rejected: set[str] = set()

    def inputs(self, name: str) -> list[DataFrame]:
        return [self.table(source) for source in TABLES[name].inputs]

    def plan(self, name: str) -> DataFrame:
        """The table as a query over the tables it is built from, not yet run."""
        if name in SOURCES:
            return read_source(self.spark, self._locate(name), name)
        return TABLES[name].build(*self.inputs(name), self.settings)

    def table(self, name: str) -> DataFrame:
        """The table read from storage; built, checked and written first if this run has not done so."""
        if name not in self._ready:
            rules = EXPECTATIONS.get(name, {})
            if name in SOURCES:
                df = read_source(self.spark, self._locate(name), name, with_damaged=True)
                rules = {READABLE: f"{DAMAGED} IS NULL", **rules}
            else:
                df = self.plan(name)
            if rules:
                self.dropped[name] = Observation(name)
                df = apply_expectations(df, rules, self.dropped[name]).drop(DAMAGED)
            self._ready[name] = self._stored(name, df)
            if name in SOURCES and self.dropped[name].get[READABLE]:
                self._keep_rejects(name)
        return self._ready[name]

    def _keep_rejects(self, name: str) -> None:
        """The raw lines of damaged rows, read in a pass of its own that only sources with such rows need."""
        rows = read_source(self.spark, self._locate(name), name, with_damaged=True)
        every = F.struct(*SOURCES[name].fieldNames())  # so that all fields are read, and looked at
        damaged = rows.select(F.input_file_name().alias("file"), F.col(DAMAGED).alias("line"), every.alias("read_as"))
        damaged.filter("line IS NOT NULL").write.mode("overwrite").parquet(f"{self._out}/rejects/{name}")
        self._rejected.add(name)

    def rejects(self, name: str) -> DataFrame:
        """Damaged rows of a source: the file, the raw line and the fields as far as they could be read."""
        self.table(name)
        schema = StructType([StructField("file", StringType()), StructField("line", StringType()),
                             StructField("read_as", SOURCES[name])])
        if name not in self._rejected:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self._out}/rejects/{name}")

    def log_quality(self, path: str, run: str, at: dt.datetime) -> None:
        """Appends what the rules of all tables built so far have dropped to the log at ``path``; no table is read."""
        log_quality(self.spark, path, run, at, {name: dict(seen.get) for name, seen in self.dropped.items()})

    def build(self, at_once: int = 4) -> None:
        """Build every table. Tables that need none of each other are submitted together, so that one fills the
        executors which the last tasks of another leave idle."""
        waiting = {name: () for name in SOURCES} | {name: table.inputs for name, table in TABLES.items()}
        with ThreadPoolExecutor(at_once) as pool:
            while waiting:
                ready = [name for name, inputs in waiting.items() if not waiting.keys() & set(inputs)]
                list(pool.map(self.table, ready))
                waiting = {name: inputs for name, inputs in waiting.items() if name not in ready}

    def create_views(self, prefix: str = "") -> None:
        """Register every table of the run as a temporary view for use with ``spark.sql``."""
        for name in (*SOURCES, *TABLES):
            self.table(name).createOrReplaceTempView(f"{prefix}{name}")

    def path_of(self, name: str) -> str:
        return f"{self._out}/{name}"

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        path = self.path_of(name)
        if name == "live_cases":
            serving.write_live_cases(df, path)
            return serving.read_live_cases(self.spark, path)
        options = bloom_filter(LOOKED_UP_BY[name]) if name in LOOKED_UP_BY else {}
        df.write.options(**options).mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def build_all(
    spark: SparkSession, csv_base: str, out: str, settings: Settings, at_once: int = 4, quality_log: str | None = None,
    run_name: str | None = None,
) -> Workspace:
    """Build every table from the CSV files below ``csv_base``. With ``quality_log`` the counts of the quality rules are
    appended to the log there, under ``run_name`` (by default the as-of date), once however often the run is repeated."""
    run = Workspace(spark, lambda name: source_path(spark, csv_base, name), out, settings)
    run.build(at_once)
    if quality_log is not None:
        run.log_quality(quality_log, run_name or str(settings.as_of), dt.datetime.combine(settings.as_of, dt.time()))
    return run
