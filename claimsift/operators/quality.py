"""Named row-quality rules: rows failing one are dropped, and can be counted.

The counts of a run come from the pass that writes its tables. They are kept in a log, one batch a run, from which
``quality_changes`` tells what has become worse or better since the run before.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from claimsift.functions.numeric import count_where, ratio
from claimsift.schemas import QUALITY_LOG
from claimsift.sources.batches import BatchLog

# Rule name -> predicate, per table; but for countable_amount, which also drops (and counts) NaN and infinite
# amounts: they have no sum, and NaN is greater than any number.
EXPECTATIONS: dict[str, dict[str, str]] = {
    "refund_requests": {
        "valid_refund_id": "refund_id IS NOT NULL",
        "valid_amount": "amount IS NOT NULL AND amount > 0",
        "countable_amount": "amount IS NULL OR amount < double('infinity')",
    },
    "order_history": {"valid_order_id": "order_id IS NOT NULL"},
    "customer_profiles": {"valid_customer_id": "customer_id IS NOT NULL"},
    "household_mappings": {"valid_household_id": "household_id IS NOT NULL"},
    "store_locations": {"valid_store_id": "store_id IS NOT NULL"},
    "product_catalog": {"valid_product_id": "product_id IS NOT NULL"},
    "delivery_events": {"valid_delivery_id": "delivery_id IS NOT NULL"},
    "refund_policies": {"valid_policy_id": "policy_id IS NOT NULL"},
    "historical_decisions": {"valid_decision_id": "decision_id IS NOT NULL"},
    "enriched_requests": {
        "valid_refund_id": "refund_id IS NOT NULL",
        "valid_customer_id": "customer_id IS NOT NULL",
    },
}


def _holds(predicate: str) -> Column:
    """A predicate that evaluates to NULL counts as failed, as it does in a filter."""
    return F.coalesce(F.expr(predicate), F.lit(False))


def apply_expectations(df: DataFrame, rules: dict[str, str], observation: Observation | None = None) -> DataFrame:
    """Keep the rows that meet every rule.

    With an ``observation`` the failures per rule are counted during the same pass; read them after the first action.
    """
    if observation is not None:
        counts = [count_where(~_holds(rule)).alias(name) for name, rule in rules.items()]
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts)
    return reduce(lambda kept, rule: kept.filter(rule), rules.values(), df)


def expectation_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per rule with the rows that pass and the rows it drops; one aggregation pass per table."""
    return reduce(DataFrame.unionByName, [_report_one(name, df) for name, df in tables.items()])


def _report_one(name: str, df: DataFrame) -> DataFrame:
    rules = EXPECTATIONS[name]
    passed = [
        F.struct(F.lit(rule).alias("expectation"), count_where(_holds(predicate)).alias("passed"))
        for rule, predicate in rules.items()
    ]
    totals = df.agg(F.count(F.lit(1)).alias("n"), F.array(*passed).alias("rules"))
    return totals.select("n", F.explode("rules").alias("rule")).select(
        F.lit(name).alias("table_name"),
        "rule.expectation",
        F.coalesce("rule.passed", F.lit(0)).cast("long").alias("passed"),
        (F.col("n") - F.coalesce("rule.passed", F.lit(0))).cast("long").alias("dropped"),
    )


def log_quality(spark: SparkSession, path: str, run: str, at: dt.datetime, counted: dict[str, dict[str, int]]) -> None:
    """Appends the counts of a run to the log, once per run: by table, ``rows`` and the failures of each rule."""
    lines = [
        (run, at, table, rule, counts["rows"] - failed, failed)
        for table, counts in sorted(counted.items()) for rule, failed in counts.items() if rule != "rows"]
    log = BatchLog(spark, path)
    log.append(spark.createDataFrame(lines, QUALITY_LOG).coalesce(1), log.claim(f"run {run}"))


def read_quality(spark: SparkSession, path: str) -> DataFrame:
    return BatchLog(spark, path).read(QUALITY_LOG).drop("batch")


def quality_changes(log: DataFrame) -> DataFrame:
    """Each rule in each run beside the run before it: how many rows pass and fail, the share that fails in percent, and the
    differences (NULL in the first run of a rule). The log has a row per run and rule, so its windows are small."""
    before = Window.partitionBy("table_name", "expectation").orderBy("run_at", "run")
    share = ratio(F.col("dropped"), F.col("passed") + F.col("dropped"), scale=100.0)
    with_share = log.withColumn("dropped_pct", share)
    return with_share.select(
        "run", "run_at", "table_name", "expectation", "passed", "dropped", "dropped_pct",
        F.lag("run").over(before).alias("previous_run"),
        (F.col("passed") - F.lag("passed").over(before)).alias("passed_change"),
        (F.col("dropped") - F.lag("dropped").over(before)).alias("dropped_change"),
        (F.col("dropped_pct") - F.lag("dropped_pct").over(before)).cast("decimal(18,3)").cast("double").alias("pct_change"),
    )
