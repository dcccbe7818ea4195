"""Reviewer actions and feedback appended to their logs as files of them arrive.

Each call takes in what is new since the last one and stops; the same query also runs continuously with another trigger. A
micro-batch is a batch of the log, named by the stream and its number, so one that is run again after a failure is not
appended twice. Feedback that arrives again in another file is dropped by its id for as long as ``REMEMBERED`` says.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from claimsift.operators.serving import check_actions, new_feedback, valid_rows
from claimsift.schemas import ACTION_LOG, FEEDBACK_LOG
from claimsift.sources.batches import BatchLog

SUBMITTED = StructType([field for field in FEEDBACK_LOG.fields if field.name != "feedback_id"])
#: How long the ids of feedback are kept to tell a repeated one, counted from its arrival.
REMEMBERED = "30 days"


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint; a new checkpoint is a new stream."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]


def _append_new(
    spark: SparkSession, arriving: str, schema: StructType, keep: Callable[[DataFrame], DataFrame], log: str,
    checkpoint: str,
) -> StreamingQuery:
    def append(rows: DataFrame, number: int) -> None:
        batches = BatchLog(rows.sparkSession, log)
        batches.append(rows, batches.claim(f"{_stream_id(rows.sparkSession, checkpoint)} {number}"))

    rows = keep(spark.readStream.schema(schema).json(arriving))
    return (
        rows.writeStream.foreachBatch(append).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def take_in_actions(spark: SparkSession, arriving: str, log: str, checkpoint: str) -> StreamingQuery:
    """Append the valid actions of new JSON files below ``arriving`` to the log. One that is repeated changes nothing: of
    several actions on a claim the latest counts."""
    return _append_new(spark, arriving, ACTION_LOG, lambda rows: valid_rows(check_actions(rows)), log, checkpoint)


def take_in_feedback(spark: SparkSession, arriving: str, log: str, checkpoint: str) -> StreamingQuery:
    """Append the valid feedback of new JSON files below ``arriving`` to the log, with an id each and once each."""
    def once(rows: DataFrame) -> DataFrame:
        # By time of arrival, so that feedback on something long ago is never late.
        seen = new_feedback(rows).withColumn("_seen_at", F.current_timestamp()).withWatermark("_seen_at", REMEMBERED)
        return seen.dropDuplicatesWithinWatermark(["feedback_id"]).drop("_seen_at")

    return _append_new(spark, arriving, SUBMITTED, once, log, checkpoint)
