"""The serving table as snapshots: killed and competing writes, folded actions, expiry; and logs of numbered batches."""

import datetime as dt

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from claimsift.operators import serving
from claimsift.schemas import ACTION_LOG
from claimsift.sources.batches import BatchLog
from claimsift.sources.snapshots import Conflict, Snapshot
from tests.frames import frame, live

STATES = (("pending_review", "CRITICAL"), ("pending_review", "HIGH"), ("pending_review", "MEDIUM"), ("auto_approved", "LOW"))


def at(hour):
    return dt.datetime(2025, 3, 1, hour)


@pytest.fixture
def table(spark, tmp_path):
    rows = [dict(refund_id=f"R{i}", household_id=f"H{j}", customer_id=i, workflow_state=state, abuse_risk_tier=tier,
                 risk_score=0.1 * (i % 10)) for i in range(40) for j in range(1 + i % 2)
            for state, tier in [STATES[i % 4]]]
    made = serving.live_table(spark, str(tmp_path / "live"))
    made.replace(live(spark, *rows))
    return made


def actions(spark, *rows):
    return frame(spark, ACTION_LOG, [dict(zip(ACTION_LOG.fieldNames(), row)) for row in rows])


def same(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_an_unwritten_table_is_empty(spark, tmp_path):
    made = serving.live_table(spark, str(tmp_path / "none"))
    assert made.current().version == 0 and made.read().isEmpty()
    assert made.read().schema == serving.LIVE_CASES


def test_a_failed_write_leaves_the_rows(table):
    before = table.read().collect()
    broken = table.read().withColumn("order_id", F.when(F.col("refund_id") == "R39", F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert sorted(table.read().collect()) == sorted(before) and table.current().version == 1


def test_a_write_killed_before_its_rename_is_not_seen_and_expires(table):
    before = table.read().count()
    table.write_files(table.read().limit(3))
    assert table.read().count() == before and table.current().version == 1
    assert len(table.expire(min_age_seconds=0)) == 1 and table.expire(min_age_seconds=0) == []
    assert table.read().count() == before


def test_a_table_is_replaced_from_itself(table):
    open_before = table.read()
    table.replace(table.read().filter("abuse_risk_tier = 'HIGH'"))
    assert {r.abuse_risk_tier for r in table.read().collect()} == {"HIGH"} and table.current().version == 2
    assert open_before.count() == 60  # readers of the old snapshot still find its files
    table.expire(keep=1, min_age_seconds=0)
    assert table.read().count() == 20


def test_of_two_writers_one_is_refused(table):
    start = table.current()
    table.publish({}, start)
    with pytest.raises(Conflict):
        table.publish(start.folders, start)
    assert table.read().isEmpty() and table.current().version == 2


def test_folding_writes_only_touched_partitions(spark, table, tmp_path):
    log = str(tmp_path / "actions")
    before = table.current()
    full = serving.apply_actions(table.read(), actions(spark, ("R1", "rejected", "x", at(9)), ("R0", "bogus", "x", at(9))))
    serving.append_actions(actions(spark, ("R1", "rejected", "x", at(9)), ("R0", "bogus", "x", at(9))), log, batch=1)
    reviewed = serving.reviewed_cases(table, serving.read_actions(spark, log))
    assert same(reviewed, full) and table.current() == before  # merged on read
    after = serving.fold_actions(table, serving.read_actions(spark, log))
    high, moved = "workflow_state=pending_review/abuse_risk_tier=HIGH", "workflow_state=rejected/abuse_risk_tier=HIGH"
    changed = {name for name in before.folders.keys() | after.folders.keys()
               if before.folders.get(name) != after.folders.get(name)}
    assert changed == {high, moved} and len(after.folders) == 5
    assert same(table.read(), full)
    read = {f.split("/data/")[1].split("/", 1)[1].rsplit("/", 1)[0] for f in table.read(
        Snapshot(0, {name: after.folders[name] for name in changed})).inputFiles()}
    assert read == changed


def test_folded_batches_equal_the_full_path_in_any_split(spark, table, tmp_path):
    names = ("approved", "rejected", "escalated", "bogus")
    rows = [(f"R{(7 * k) % 45}", names[k % 4], f"why {k}", at(8 + (5 * k) % 9) if k % 11 else None) for k in range(60)]
    full = serving.apply_actions(table.read(), actions(spark, *rows))
    log = str(tmp_path / "actions")
    for batch in range(1, 5):
        serving.append_actions(actions(spark, *rows[batch - 1::4]), log, batch)
        if batch != 3:
            serving.fold_actions(table, serving.read_actions(spark, log), most_folders=2)
        assert serving.fold_actions(table, serving.read_actions(spark, log).filter("batch = 0")) == table.current()
    assert same(serving.reviewed_cases(table, serving.read_actions(spark, log)), full)
    assert same(table.read(), full)


def test_cases_are_shuffled_at_most_once_to_be_written(spark, table, tmp_path, monkeypatch):
    plans, partition = [], DataFrameWriter.partitionBy

    def noted(writer, *columns):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return partition(writer, *columns)

    monkeypatch.setattr(DataFrameWriter, "partitionBy", noted)
    table.replace(table.read(), gather=False)
    assert "Exchange" not in plans[0]
    log = str(tmp_path / "actions")
    for batch, known in ((1, None), (2, ["R4", "R5"])):  # many claims, then few
        acted = actions(spark, ("R4", "rejected", "x", at(8 + batch)), ("R5", "approved", "x", at(8 + batch)))
        full = serving.apply_actions(table.read(), acted)
        serving.append_actions(acted, log, batch)
        monkeypatch.setattr(serving, "few_ids", lambda _: known)
        serving.fold_actions(table, serving.read_actions(spark, log))
        assert same(table.read(), full)
    many, few = plans[1:]
    assert "REBALANCE" not in many and many.count("Exchange hashpartitioning(refund_id") == 2  # cases, actions
    assert few.count("REBALANCE") == 1 and few.count("Exchange hashpartitioning(refund_id") == 1  # actions


def test_a_repeated_batch_is_left_alone(spark, tmp_path):
    log = str(tmp_path / "actions")
    for _ in range(2):
        serving.append_actions(actions(spark, ("A", "approved", "x", at(8))), log, batch=4)
    serving.append_actions(actions(spark, ("B", "approved", "x", at(8))), log)
    assert sorted((r.refund_id, r.batch) for r in serving.read_actions(spark, log).collect()) == [("A", 4), ("B", 5)]


def test_an_unfinished_batch_is_written_again(spark, tmp_path):
    rows = actions(spark, ("A", "approved", "x", at(8)))
    log = BatchLog(spark, str(tmp_path / "log"))
    assert log.append(rows, 1) and not log.append(rows, 1)
    (tmp_path / "log" / "batch=1" / "_SUCCESS").unlink()
    assert log.append(rows, 1) and log.read(ACTION_LOG).count() == 1


def test_claims_are_kept_and_never_shared(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"))
    assert log.read(ACTION_LOG).isEmpty()
    assert [log.claim(token) for token in ("a", "b", "a", "c", "b")] == [1, 2, 1, 3, 2]
    log.append(actions(spark, ("A", "approved", "x", at(8))), 9)
    assert log.claim("d") == 10
