"""Times the whole build of the tables and every headline query; prints one line of JSON.

A first pass over the smallest scale, which is not timed, loads classes and compiles generated code.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimsift.plans import registry  # noqa: E402
from claimsift.schemas import SOURCES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_UP_DIR = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "latest_delivery", "enriched_requests", "customer_refund_history", "household_activity", "customer_360",
    "case_decisioning", "case_queue", "dashboard_kpis", "risk_distribution", "leakage_by_category", "refund_leakage",
    "abuse_rate", "segment_summary", "escalation_by_segment", "top_abuse_customers", "apply_actions", "case_detail", "case_detail_few",
    "decide", "decision_audit", "abuse_signals", "policy_checks", "feedback_enriched", "action_overrides",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale(sf_dir: str) -> float | str:
    """0.1 for a folder named ``sf0.1``, else the name of the folder."""
    name = os.path.basename(sf_dir.rstrip("/"))
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def measure(spark: SparkSession, sf_dir: str) -> tuple[dict[str, float], int]:
    """Seconds per step and the number of claims."""
    d = registry.data(spark, sf_dir)
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    for name in SOURCES:
        d.land(name)
    # The build reads the nine CSV files and writes every table, as a full refresh does.
    timed("build_all_tables", d.run.build)
    for name in HEADLINE:
        timed(name, lambda name=name: registry.QUERIES[name](d).write.format("noop").mode("overwrite").save())
    return seconds, d["refund_requests"].count()


def main() -> None:
    spark = session()
    if os.path.isdir(WARM_UP_DIR):
        measure(spark, WARM_UP_DIR)
    seconds, requests = measure(spark, SF_DIR)
    print(json.dumps({
        "metric": "full table build plus headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "requests": requests, "queries": seconds, "sf": scale(SF_DIR),
    }))


if __name__ == "__main__":
    main()
