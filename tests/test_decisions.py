"""Decision rules case by case."""

import pytest
from pyspark.sql import functions as F

from claimsift.operators import decisions, queue
from claimsift.schemas import LIVE_CASES
from tests.frames import SETTINGS, frame, live

PROFILE = "customer_id long, risk_tier string, refund_rate double, refunds_90d long, coordinated_timing_flag boolean, " \
          "household_refund_count_30d long, household_id string, shared_address_flag boolean"


@pytest.fixture(scope="module")
def asked(spark):
    """Cases beside their profile, as ``case_detail`` gives them."""
    cases = live(
        spark,
        dict(refund_id="calm", order_id="O", customer_id=1, amount=25.0, within_return_window=True, is_high_value=False,
             days_since_order=5, item_condition="opened", reason_code="DAMAGED", risk_score=0.1, delivery_issues="",
             recommended_action="APPROVE", product_name="Pen", product_category="Books", channel="chat"),
        dict(refund_id="loud", order_id="O", customer_id=2, amount=25.01, within_return_window=False, is_high_value=True,
             days_since_order=40, item_condition="missing", reason_code="ITEM_NOT_RECEIVED", delivery_confirmed=True,
             risk_score=0.85, recommended_action="REJECT", delivery_issues="late"),
        dict(refund_id="bare"),
        dict(refund_id="late", order_id="O", customer_id=1, amount=1.0, within_return_window=True, days_since_order=30,
             reason_code="UNAUTHORIZED_PURCHASE", risk_score=0.3, recommended_action="APPROVE"),
    )
    profiles = spark.createDataFrame(
        [(1, "MEDIUM", 0.25, 5, False, 1, "H1", True), (2, "LOW", 0.1, 1, False, 0, "H9", True),
         (2, "CRITICAL", 0.405, 11, True, 3, "H2", None)], PROFILE)
    ids = spark.createDataFrame([(r,) for r in ("calm", "loud", "bare", "late")], "refund_id string")
    return queue.case_detail(cases, profiles, ids, min_rows=2, salts=2)


def by_id(df, column):
    return {row.refund_id: row[column] for row in df.collect()}


def test_detail_takes_the_strongest_profile(asked):
    assert set(asked.columns) == {*LIVE_CASES.fieldNames(), "customer_360"}
    got = by_id(asked, "customer_360")
    assert got["loud"].household_id == "H2" and got["calm"].household_id == "H1" and got["bare"] is None


def test_validation(asked):
    got = by_id(decisions.with_validation(asked), "validation")
    assert (got["calm"].valid, got["calm"].issues) == (True, [])
    assert got["loud"].issues == ["Outside return window (40 days)", "Item reported as missing"]
    assert got["bare"].issues == ["No matching order found"] and got["bare"].valid is False


def test_policy(asked):
    got = by_id(decisions.with_policy(asked, SETTINGS), "policy")
    assert (got["calm"].auto_approvable, got["calm"].policy_flags) == (True, ["Below auto-approve threshold ($25)"])
    assert got["loud"].policy_flags == ["High-value item requires manual review", "Outside return window"]
    assert (got["bare"].auto_approvable, got["bare"].policy_flags) == (False, ["Outside return window"])
    assert got["late"].policy_flags == [
        "Below auto-approve threshold ($25)", "Unauthorized purchase - fraud team review"]


def test_risk(asked):
    got = by_id(decisions.with_risk(asked), "risk")
    assert (got["calm"].risk_tier, got["calm"].signals) == ("MEDIUM", [])
    assert got["loud"].signals == [
        "Customer risk tier: CRITICAL", "High refund rate: 40.5%", "Frequent refunder: 11 in 90 days",
        "Household coordination detected", "Claims non-delivery but delivery confirmed with photo"]
    assert (got["bare"].risk_score, got["bare"].risk_tier, got["bare"].signals) == (0.0, "UNKNOWN", [])


def steps(asked):
    return decisions.with_risk(decisions.with_policy(decisions.with_validation(asked), SETTINGS))


def test_prompt(asked):
    got = by_id(decisions.with_prompt(steps(asked)), "prompt")
    assert "- Amount: $25.0\n- Reason: DAMAGED\n- Product: Pen (Books)\n- Channel: chat" in got["calm"]
    assert "VALIDATION: Valid=True, Issues=None\nPOLICY: Auto-approvable=True, Flags=Below" in got["calm"]
    assert "- Channel: N/A\n- Days since order: None" in got["bare"]
    assert "RISK: Score=0.85/1.0, Tier=CRITICAL, Signals=Customer risk tier: CRITICAL, High" in got["loud"]
    assert got["bare"].endswith('"key_factors": ["factor1", "factor2"]}') and "{refund_id}" not in got["bare"]


REPLIES = {
    "calm": 'text {"action": "REJECT", "confidence": 0.9, "explanation": "why", "key_factors": ["a", "b"]} text',
    "loud": '{"action": "APPROVE"} and {more}',
    "bare": "nothing",
}


@pytest.mark.parametrize("raw, action", [
    (REPLIES["calm"], "REJECT"),
    ('{"action": "REJECT",\n "key_factors": []}', "REJECT"),
    ('{"explanation": "a {b} c", "action": "ESCALATE"}', "ESCALATE"),
    ("nothing", None), ("", None), (None, None), ("} {", None), ("{bad}", None),
    (REPLIES["loud"], None), ('{"action": "A"}, {"action": "B"}', None),
])
def test_parse_reply(spark, raw, action):
    df = spark.createDataFrame([(raw,)], "raw string").select(decisions.parse_reply(F.col("raw")).alias("reply"))
    reply = df.first().reply
    assert (reply.action if reply else None) == action


def test_recommendation(spark, asked):
    replies = spark.createDataFrame(list(REPLIES.items()), "refund_id string, raw string")
    got = by_id(decisions.with_recommendation(steps(asked), replies), "recommendation")
    assert tuple(got["calm"]) == ("REJECT", 0.9, "why", ["a", "b"], False, None)
    assert got["loud"].fallback and got["loud"].action == "REJECT" and got["loud"].confidence == 0.85
    assert got["loud"].explanation == got["loud"].unparsed_excerpt == REPLIES["loud"]
    assert tuple(got["bare"]) == ("ESCALATE", 0.0, "nothing", [], True, "nothing")
    alone = by_id(decisions.with_recommendation(steps(asked)), "recommendation")
    assert all(row.fallback and row.unparsed_excerpt is None for row in alone.values())
    assert alone["loud"].explanation.startswith(
        "Rule-based recommendation (LLM unavailable): ['Customer risk tier: CRITICAL', 'High refund rate: 40.5%', ")
    assert alone["bare"].explanation == "Rule-based recommendation (LLM unavailable): []"


def test_excerpts_of_replies(spark):
    raws = ["x" * 600, REPLIES["calm"], "", None]
    replies = spark.createDataFrame([(str(i), raw) for i, raw in enumerate(raws)], "refund_id string, raw string")
    got = {r.refund_id: (r.parsed, r.unparsed_excerpt) for r in decisions.parse_replies(replies).collect()}
    assert got == {"0": (False, "x" * 500), "1": (True, None), "2": (False, ""), "3": (False, None)}


def test_audit(asked):
    flat = decisions.decision_audit(decisions.with_recommendation(steps(asked)))
    row = flat.filter("refund_id = 'loud'").first()
    assert (row.num_abuse_signals, row.validation_passed, row.auto_approvable) == (5, False, False)


def test_policy_checks(asked):
    got = {(r.refund_id, r.label): (r.passed, r.detail) for r in decisions.policy_checks(asked).collect()}
    assert len(got) == 16
    assert got["calm", "Return Window"] == (True, "5 days since order")
    assert got["calm", "Delivery Verified"] == (False, "No issues")
    assert got["loud", "Delivery Verified"] == (True, "late")
    assert got["loud", "Item Condition"] == (False, "missing")
    assert got["loud", "High-Value Item"] == (False, "Requires manual review")
    assert got["bare", "Return Window"] == (False, "? days since order")
    assert got["bare", "Item Condition"] == (True, "Unknown")
    assert got["bare", "High-Value Item"] == (True, "Standard item")


def test_abuse_signals(asked):
    rows = sorted((r.refund_id, r.label, r.severity) for r in decisions.abuse_signals(asked).collect())
    assert rows == [
        ("late", "Return window gaming: day 30 of 30", "medium"),
        ("loud", "11 refunds in 90 days", "critical"),
        ("loud", "High refund rate: 40.5%", "high"),
        ("loud", "Household coordination detected", "critical"),
        ("loud", "Non-delivery claim with photo-confirmed delivery", "critical"),
    ]


def test_repeated_ids_give_one_decision_each(spark, asked):
    cases = asked.drop("customer_360")
    profiles = frame(spark, spark.createDataFrame([], PROFILE).schema, [])
    ids = spark.createDataFrame([("calm",), ("calm",), ("loud",), ("gone",)], "refund_id string")
    got = decisions.decide(cases, profiles, ids, SETTINGS)
    assert sorted(r.refund_id for r in got.collect()) == ["calm", "loud"]
    assert got.columns == ["refund_id", "validation", "policy", "risk", "recommendation"]
