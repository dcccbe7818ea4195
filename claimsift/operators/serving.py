"""The table reviewers work on, and the logs of their actions and feedback.

Nothing is updated in place. The table is a sequence of snapshots, each published by one rename. Reviewers' actions are
appended to a log in numbered batches; the latest valid one per claim is laid over the cases when they are read, and
``fold_actions`` now and then writes those partitions anew that the batches since the last time have touched. A batch that
is appended again leaves the log as it is, so a rerun gives the same tables and a lost executor costs only its own tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimsift.functions.bands import banded, score_tier, workflow_state
from claimsift.functions.text import named_uuid
from claimsift.operators.keyed import first_per_key
from claimsift.operators.queue import few_ids
from claimsift.schemas import ACTION_LOG, FEEDBACK_LOG, LIVE_CASES
from claimsift.settings import ACTIONS, FEEDBACK_TYPES
from claimsift.sources.batches import BatchLog
from claimsift.sources.snapshots import Snapshot, SnapshotTable

PARTITIONS = ("workflow_state", "abuse_risk_tier")
#: Note of a snapshot: the last batch of actions that its rows hold.
FOLDED = "actions_up_to"


def live_cases(cases: DataFrame) -> DataFrame:
    """Scored cases with their workflow state, score tier and empty reviewer columns, in the serving schema."""
    staged = cases.withColumns({
        "workflow_state": workflow_state(F.col("recommended_action"), F.col("risk_score")),
        "abuse_risk_tier": score_tier(F.col("risk_score")),
        "csr_action": F.lit(None),
        "csr_reason": F.lit(None),
        "csr_acted_at": F.lit(None),
        "ai_explanation": F.lit(None),
    })
    return staged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LIVE_CASES.fields])


def live_table(spark: SparkSession, path: str) -> SnapshotTable:
    """Files are sorted for the queue and can be searched for a claim."""
    return SnapshotTable(spark, path, LIVE_CASES, PARTITIONS, "refund_id", (F.desc("risk_score"), F.asc("refund_id")))


def write_live_cases(live: DataFrame, path: str) -> Snapshot:
    """Replace the whole serving table. Readers see the old rows until all of the new ones are there; if the write fails
    they keep the old ones. Batches of actions are laid over the new rows from the first one on."""
    return live_table(live.sparkSession, path).replace(live)


def read_live_cases(spark: SparkSession, path: str) -> DataFrame:
    """The rows as last written, without actions that are not folded in yet."""
    return live_table(spark, path).read()


def blank(value: Column) -> Column:
    return F.coalesce(F.trim(value) == "", F.lit(True))


def check_actions(actions: DataFrame) -> DataFrame:
    """Adds ``problem`` (NULL if none) and ``is_valid``."""
    known = F.coalesce(F.col("action").isin(*ACTIONS), F.lit(False))
    problem = F.when(~known, F.lit("unknown action")).when(blank(F.col("reason")), F.lit("blank reason"))
    return actions.withColumn("problem", problem).withColumn("is_valid", F.col("problem").isNull())


def check_feedback(feedback: DataFrame) -> DataFrame:
    known = F.coalesce(F.col("feedback_type").isin(*FEEDBACK_TYPES), F.lit(False))
    problem = F.when(~known, F.lit("unknown type")).when(blank(F.col("refund_id")), F.lit("blank refund_id"))
    return feedback.withColumn("problem", problem).withColumn("is_valid", F.col("problem").isNull())


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter("is_valid").drop("problem", "is_valid")


def state_after(action: Column) -> Column:
    """An accepted action gives the state of the same name, anything else returns the case to the queue."""
    return banded([(action == name, name) for name in ACTIONS], "pending_review")


def latest_actions(actions: DataFrame) -> DataFrame:
    """The latest valid action of each claim, then the greater action and reason."""
    return first_per_key(
        valid_rows(check_actions(actions)).select("refund_id", "action", "reason", "acted_at"), ["refund_id"],
        F.desc_nulls_last("acted_at"), F.desc("action"), F.desc("reason"),
    )


def _supersedes() -> Column:
    """Whether the joined action is later than what the case holds already, in the order of ``latest_actions``."""
    held = F.struct("csr_acted_at", "csr_action", "csr_reason")
    return F.col("action").isNotNull() & (
        F.col("csr_action").isNull() | (F.struct("acted_at", "action", "reason") > held))


def apply_actions(live: DataFrame, actions: DataFrame) -> DataFrame:
    """Lay the latest valid action of each claim over its cases (all of them, if it has several rows), unless they hold
    a later one.

    A claim has one row per membership of its customer, so no claim is a hot key and the join is a plain one.
    """
    return _overlaid(live, latest_actions(actions))


def _overlaid(live: DataFrame, latest: DataFrame) -> DataFrame:
    overlay = {
        "csr_action": "action",
        "csr_reason": "reason",
        "csr_acted_at": "acted_at",
    }
    joined = live.join(latest, "refund_id", "left").withColumn("_acted", _supersedes())
    columns = {target: F.when(F.col("_acted"), F.col(source)).otherwise(F.col(target)) for target, source in overlay.items()}
    columns["workflow_state"] = F.when(F.col("_acted"), state_after(F.col("action"))).otherwise(F.col("workflow_state"))
    return joined.withColumns(columns).select(*live.columns)


def reviewed_cases(table: SnapshotTable, log: DataFrame) -> DataFrame:
    """The cases as of now: the snapshot with the batches of actions laid over it that it does not hold yet."""
    snapshot = table.current()
    return apply_actions(table.read(snapshot), _unfolded(snapshot, log))


def _unfolded(snapshot: Snapshot, log: DataFrame) -> DataFrame:
    return log.filter(F.col("batch") > snapshot.notes.get(FOLDED, 0))


def fold_actions(table: SnapshotTable, log: DataFrame, most_folders: int = 8) -> Snapshot:
    """Publishes a snapshot that holds all batches of the log, and writes anew only the partitions that lose or change a row.

    Rows that move to another partition are added to it as files of their own; a partition of more than ``most_folders``
    such additions is written anew with them. Everything else keeps its files.

    The cases of those partitions are shuffled once, whatever their number and that of the actions: few actions reach them
    where they lie, and the rows are gathered by partition to be written; for more, cases and actions meet by claim, and
    each task writes what it has, some megabytes and so a file of every partition.
    """
    before = table.current()
    fresh = _unfolded(before, log)
    last = fresh.agg(F.max("batch")).first()[0]
    if last is None:
        return before
    rows, latest = table.read(before), latest_actions(fresh)
    few = few_ids(latest)
    acted = rows if few is None else rows.filter(F.col("refund_id").isin(few))  # only row groups that may hold them
    changed = acted.join(latest, "refund_id").filter(_supersedes()).select(*PARTITIONS).distinct()
    touched = {table.folder_of(row) for row in changed.collect()}  # at most one row per state and tier
    touched |= {name for name, writes in before.folders.items() if len(writes) > most_folders}
    folders = {name: writes for name, writes in before.folders.items() if name not in touched}
    if touched:
        affected = table.read(Snapshot(before.version, {name: before.folders[name] for name in touched}))
        folded = _overlaid(affected, latest.hint("broadcast" if few is not None else "merge"))
        for name, writes in table.write_files(folded, gather=few is not None).items():
            folders[name] = [*folders.get(name, []), *writes]
    return table.publish(folders, before, before.notes | {FOLDED: last})


def with_is_actioned(live: DataFrame) -> DataFrame:
    return live.withColumn("is_actioned", F.coalesce(F.col("workflow_state").isin(*ACTIONS), F.lit(False)))


def new_feedback(submitted: DataFrame, batch: int = 0) -> DataFrame:
    """Valid submissions, once each, with an id that follows from what is submitted. Where no time is given the current
    one is taken, and the number of the batch stands for it in the id."""
    given = "submitted_at" in submitted.columns
    when = F.col("submitted_at") if given else F.current_timestamp()
    told = F.date_format("submitted_at", "yyyy-MM-dd HH:mm:ss.SSSSSS") if given else F.lit(f"batch {batch}")
    name = F.concat_ws(
        "\n", F.length("refund_id").cast("string"), "refund_id", "feedback_type", F.coalesce(told, F.lit("")),
        F.coalesce("notes", F.lit("")))
    rows = valid_rows(check_feedback(submitted))
    return rows.withColumn("feedback_id", named_uuid(name)).withColumn("submitted_at", when).select(
        *FEEDBACK_LOG.fieldNames())


def append_feedback(submitted: DataFrame, path: str, batch: int | None = None) -> None:
    """Append valid feedback as a numbered batch, the next one by default. A batch that is there already is left alone."""
    log = BatchLog(submitted.sparkSession, path)
    number = log.number(batch)
    log.append(new_feedback(submitted, number).dropDuplicates(["feedback_id"]), number)


def read_feedback(spark: SparkSession, path: str) -> DataFrame:
    return BatchLog(spark, path).read(FEEDBACK_LOG).drop("batch")


def append_actions(actions: DataFrame, path: str, batch: int | None = None) -> None:
    """Append valid actions to the log as a numbered batch, the next one by default. A batch that is there already is left
    alone. Numbers must rise: batches up to the last one folded into the cases are not looked at again."""
    log = BatchLog(actions.sparkSession, path)
    log.append(valid_rows(check_actions(actions)).select(*ACTION_LOG.fieldNames()), log.number(batch))


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    """The log of actions with the number of each one's ``batch``."""
    return BatchLog(spark, path).read(ACTION_LOG)


def recent_feedback(log: DataFrame, limit: int = 100) -> DataFrame:
    """The newest feedback first."""
    return log.select(*FEEDBACK_LOG.fieldNames()).orderBy(
        F.desc("submitted_at"), F.asc("refund_id"), F.asc("feedback_id")).limit(limit)
