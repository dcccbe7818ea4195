"""Files of reviewer input taken in step by step."""

import json

from claimsift.operators.serving import read_actions, read_feedback
from claimsift.streaming.logs import take_in_actions, take_in_feedback


def put(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, rows)))


def test_only_new_and_valid_actions_are_appended(spark, tmp_path):
    arriving, log, state = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "state")
    action = dict(refund_id="A", action="approved", reason="ok", acted_at="2025-03-01T09:00:00")
    put(arriving, "1.json", action, action | dict(action="bogus"), action | dict(reason=" "))
    take_in_actions(spark, str(arriving), log, state).awaitTermination()
    assert read_actions(spark, log).count() == 1
    put(arriving, "2.json", action | dict(refund_id="B"))
    take_in_actions(spark, str(arriving), log, state).awaitTermination()
    assert sorted(r.refund_id for r in read_actions(spark, log).collect()) == ["A", "B"]


def test_feedback_gets_an_id(spark, tmp_path):
    arriving, log, state = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "state")
    row = dict(refund_id="A", feedback_type="missed_abuse", notes="n", submitted_at="2025-03-01T09:00:00")
    put(arriving, "1.json", row, row | dict(feedback_type="other"))
    take_in_feedback(spark, str(arriving), log, state).awaitTermination()
    kept = read_feedback(spark, log).collect()
    assert len(kept) == 1 and len(kept[0].feedback_id) == 36


def test_repeated_feedback_is_taken_in_once(spark, tmp_path):
    arriving, log, state = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "state")
    row = dict(refund_id="A", feedback_type="missed_abuse", notes="n", submitted_at="2001-03-01T09:00:00")
    put(arriving, "1.json", row, row, row | dict(refund_id="B"))
    take_in_feedback(spark, str(arriving), log, state).awaitTermination()
    put(arriving, "2.json", row, row | dict(submitted_at="1999-01-01T00:00:00"), row | dict(submitted_at=None))
    take_in_feedback(spark, str(arriving), log, state).awaitTermination()
    kept = read_feedback(spark, log).collect()
    assert len(kept) == 4 == len({r.feedback_id for r in kept})


def test_a_micro_batch_run_again_is_appended_once(spark, tmp_path):
    """The sink finished a batch, the stream did not note that down: it runs it again after a restart."""
    arriving, log, state = tmp_path / "in", str(tmp_path / "log"), tmp_path / "state"
    action = dict(refund_id="A", action="approved", reason="ok", acted_at="2025-03-01T09:00:00")
    put(arriving, "1.json", action)
    take_in_actions(spark, str(arriving), log, str(state)).awaitTermination()
    for note in list((state / "commits").iterdir()):
        note.unlink()
    put(arriving, "2.json", action | dict(refund_id="B"))
    take_in_actions(spark, str(arriving), log, str(state)).awaitTermination()
    assert sorted(r.refund_id for r in read_actions(spark, log).collect()) == ["A", "B"]
