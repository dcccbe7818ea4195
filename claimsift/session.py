"""Session settings the library relies on, and the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Lists of ids that are looked up reach the Bloom filters of row groups only up to this many values.
# Several joins in a row share a key, so a skewed one may only be split if the next is allowed to shuffle again.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options above on ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# What one task sorts stays small however large the tables are: shuffles are cut finely, and adaptive execution merges
# what is small; scans are cut so that a sort before a shuffle holds about a million rows, and take several small files.
TASK_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": 400,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.files.openCostInBytes": "1m",
}


def bound_tasks(spark: SparkSession) -> SparkSession:
    """Set the options above on ``spark`` where nobody has set them, and return it."""
    for key, value in TASK_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; a temporary one where a local session names none, as in tests. On a
    cluster, where executors do not share such a folder, and where the master is not known, the setting is required."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = root or tempfile.mkdtemp(prefix="claimsift-")
    return f"{root.rstrip('/')}/claimsift/{purpose}-{uuid.uuid4().hex}"
