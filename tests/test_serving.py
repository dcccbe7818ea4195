"""Serving table, reviewer actions, feedback and the queue."""

import datetime as dt

import pytest

from claimsift.operators import decisions, queue, serving
from claimsift.schemas import ACTION_LOG, FEEDBACK_LOG
from tests.frames import frame, live


def at(hour):
    return dt.datetime(2025, 3, 1, hour)


@pytest.fixture(scope="module")
def cases(spark):
    return live(
        spark,
        dict(refund_id="A", household_id="H1", customer_id=1, workflow_state="pending_review", abuse_risk_tier="CRITICAL",
             risk_score=0.8, recommended_action="REJECT", amount=10.0, coordinated_timing_flag=False, channel="online"),
        dict(refund_id="A", household_id="H2", customer_id=1, workflow_state="pending_review", abuse_risk_tier="CRITICAL",
             risk_score=0.9, recommended_action="REJECT", amount=10.0, coordinated_timing_flag=True, channel="online"),
        dict(refund_id="B", customer_id=2, workflow_state="auto_approved", abuse_risk_tier="LOW", risk_score=0.1,
             recommended_action="APPROVE", amount=5.0, channel="chat"),
        dict(refund_id="C", customer_id=3, workflow_state="pending_review", abuse_risk_tier="HIGH", risk_score=0.5,
             recommended_action="ESCALATE", amount=7.0, channel="chat"),
    )


def actions(spark, *rows):
    return frame(spark, ACTION_LOG, [dict(zip(ACTION_LOG.fieldNames(), row)) for row in rows])


def test_no_actions_change_nothing(spark, cases):
    after = serving.apply_actions(cases, actions(spark))
    assert after.columns == cases.columns
    assert after.exceptAll(cases).count() == 0 and after.count() == cases.count()


def test_latest_valid_action_wins_on_every_row_of_a_claim(spark, cases):
    log = actions(
        spark, ("A", "approved", "first", at(8)), ("A", "rejected", "second", at(9)), ("A", "bogus", "third", at(10)),
        ("A", "approved", " ", at(11)), ("B", "escalated", "odd", None), ("Z", "approved", "no case", at(9)))
    after = serving.with_is_actioned(serving.apply_actions(cases, log))
    got = sorted((r.refund_id, r.workflow_state, r.csr_action, r.csr_reason, r.csr_acted_at, r.is_actioned)
                 for r in after.filter("refund_id != 'C'").collect())
    assert got == [("A", "rejected", "rejected", "second", at(9), True)] * 2 + [
        ("B", "escalated", "escalated", "odd", None, True)]
    assert after.filter("refund_id = 'C'").first().is_actioned is False


def test_unknown_action_returns_a_case_to_the_queue(spark):
    df = spark.createDataFrame([("approved",), ("whatever",)], "action string")
    assert [r[0] for r in df.select(serving.state_after(df.action)).collect()] == ["approved", "pending_review"]


def test_action_checks(spark):
    log = actions(spark, ("A", "approved", "ok", None), ("A", "approve", "ok", None), ("A", None, "ok", None),
                  ("A", "rejected", "  ", None), ("A", "rejected", None, None))
    problems = [r.problem for r in serving.check_actions(log).collect()]
    assert problems == [None, "unknown action", "unknown action", "blank reason", "blank reason"]


def test_overrides(spark, cases):
    log = actions(spark, ("A", "rejected", "x" * 300, at(8)), ("B", "rejected", "y", at(8)), ("Z", "approved", "z", at(8)))
    rows = {r.refund_id: r for r in decisions.action_overrides(log, cases).collect()}
    assert (rows["A"].ai_recommended, rows["A"].is_override, rows["A"].risk_score) == ("reject", False, 0.9)
    assert (rows["B"].ai_recommended, rows["B"].is_override) == ("approve", True)
    assert (rows["Z"].found, rows["Z"].ai_recommended, rows["Z"].is_override, rows["Z"].amount) == (False, "", False, 0.0)
    assert len(rows["A"].reason_excerpt) == 200


def test_written_table_is_partitioned_and_pruned(spark, cases, tmp_path):
    path = str(tmp_path / "live")
    serving.write_live_cases(cases, path)
    back = serving.read_live_cases(spark, path)
    assert back.schema == cases.schema and back.exceptAll(cases).count() == 0 and back.count() == 4
    assert [p for p in tmp_path.glob("live/data/*/workflow_state=pending_review/abuse_risk_tier=HIGH") if p.is_dir()]
    page = queue.case_queue(back, status="pending_review", risk_tier="HIGH")
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(workflow_state" in plan
    assert [r.refund_id for r in page.collect()] == ["C"]


def test_rewriting_replaces_the_table(spark, cases, tmp_path, conf):
    conf(spark__sql__sources__partitionOverwriteMode="dynamic")
    path = str(tmp_path / "live")
    serving.write_live_cases(cases, path)
    serving.write_live_cases(cases.filter("refund_id = 'B'"), path)
    assert serving.read_live_cases(spark, path).count() == 1


def test_queue_order_paging_and_filters(cases):
    assert [r.refund_id for r in queue.case_queue(cases).collect()] == ["A", "A", "C", "B"]
    assert [r.refund_id for r in queue.case_queue(cases, limit=2, offset=1).collect()] == ["A", "C"]
    assert [r.refund_id for r in queue.case_queue(cases, channel="chat", limit=1).collect()] == ["C"]
    assert queue.case_queue(cases, status="x' OR '1'='1").count() == 0


def test_queue_pages_by_last_row(cases):
    seen, last = [], None
    while page := queue.case_queue(cases, limit=1, after=last).collect():
        last = (page[0].risk_score, page[0].refund_id, page[0].household_id)
        seen.append(last)
    assert seen == [(0.9, "A", "H2"), (0.8, "A", "H1"), (0.5, "C", None), (0.1, "B", None)]


@pytest.mark.parametrize("options", [dict(limit=0), dict(limit=201), dict(offset=-1)])
def test_queue_rejects_bad_pages(cases, options):
    with pytest.raises(ValueError):
        queue.case_queue(cases, **options)


def test_missing_cases(spark, cases):
    ids = spark.createDataFrame([("A",), ("Z",), ("Z",)], "refund_id string")
    assert [tuple(r) for r in queue.missing_cases(cases, ids).collect()] == [("Z", "Refund not found")]


def test_feedback_is_checked_and_appended(spark, cases, tmp_path):
    rows = [("1", "A", "false_positive", "n" * 300, at(8)), ("2", "B", "missed_abuse", None, at(9)),
            ("3", "B", "other", "x", at(9)), ("4", " ", "missed_abuse", "x", at(9)), ("5", "Z", "missed_abuse", "x", at(7))]
    submitted = frame(spark, FEEDBACK_LOG, [dict(zip(FEEDBACK_LOG.fieldNames(), row)) for row in rows])
    assert [r.is_valid for r in serving.check_feedback(submitted).collect()] == [True, True, False, False, True]
    path = str(tmp_path / "feedback")
    serving.append_feedback(submitted, path)
    serving.append_feedback(submitted.drop("submitted_at"), path)
    log = serving.read_feedback(spark, path)
    assert log.columns == FEEDBACK_LOG.fieldNames()
    assert log.count() == 6 and log.select("feedback_id").distinct().count() == 6
    assert log.filter("submitted_at IS NULL").count() == 0
    enriched = {r.refund_id: r for r in decisions.feedback_enriched(submitted, cases, min_rows=1).collect()}
    assert len(enriched["A"].notes_excerpt) == 200 and enriched["A"].risk_score == 0.9
    assert (enriched["Z"].found, enriched["Z"].channel, enriched["Z"].customer_id) == (False, "", None)
    newest = serving.recent_feedback(submitted, limit=2).collect()
    assert [r.submitted_at for r in newest] == [at(9), at(9)]


def test_actions_are_appended(spark, tmp_path):
    path = str(tmp_path / "actions")
    serving.append_actions(actions(spark, ("A", "approved", "ok", at(8)), ("A", "bogus", "ok", at(8))), path)
    serving.append_actions(actions(spark, ("B", "rejected", "ok", at(9))), path)
    assert sorted(r.refund_id for r in spark.read.parquet(path).collect()) == ["A", "B"]


def test_a_batch_of_feedback_is_appended_once(spark, tmp_path):
    row = dict(refund_id="A", feedback_type="missed_abuse", notes="n", submitted_at=at(8))
    submitted = frame(spark, FEEDBACK_LOG, [row, row, row | dict(notes=None), row | dict(submitted_at=None)])
    path = str(tmp_path / "feedback")
    for _ in range(2):
        serving.append_feedback(submitted.drop("feedback_id"), path, batch=1)
    first = serving.read_feedback(spark, path).collect()
    assert len(first) == 3 == len({r.feedback_id for r in first})
    again = serving.new_feedback(submitted.drop("feedback_id")).collect()
    assert {r.feedback_id for r in again} == {r.feedback_id for r in first}
    with pytest.raises(ValueError):
        serving.append_feedback(submitted, path, batch=0)


def test_an_earlier_action_does_not_undo_a_later_one(spark, cases):
    after = serving.apply_actions(cases, actions(spark, ("C", "rejected", "late", at(9))))
    again = serving.apply_actions(after, actions(spark, ("C", "approved", "early", at(8)), ("B", "approved", "x", None)))
    got = {r.refund_id: (r.workflow_state, r.csr_reason) for r in again.collect()}
    assert got["C"] == ("rejected", "late") and got["B"] == ("approved", "x")
