"""Thresholds just below, at and above their bounds."""

import pytest
from pyspark.sql import functions as F

from claimsift.functions import bands
from claimsift.functions.numeric import ratio, round_to
from claimsift.operators import metrics, scoring
from claimsift.operators.history import customer_refund_history
from claimsift.operators.quality import EXPECTATIONS, apply_expectations, expectation_report
from tests.frames import SETTINGS, day, source


def evaluate(spark, values, kind, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row.y for row in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_score_tier(spark):
    got = evaluate(spark, [0.199, 0.2, 0.399, 0.4, 0.699, 0.7, None], "double", bands.score_tier)
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL", "LOW"]


def test_rounding_takes_any_number(spark):
    got = evaluate(spark, [0.0005, 2.0e9, 1e300, float("inf"), None], "double", lambda x: round_to(x, 3))
    assert got == [0.001, 2.0e9, 1e300, float("inf"), None]
    assert str(evaluate(spark, [float("nan")], "double", lambda x: round_to(x, 3))) == "[nan]"


def test_amounts_that_sums_cannot_hold_are_dropped_and_counted(spark):
    amounts = [5.0, None, 0.0, -1.0, float("nan"), float("inf"), 1e20]
    requests = source(spark, "refund_requests", *[
        dict(refund_id=f"R{i}", customer_id=1, amount=a, request_date=day(1)) for i, a in enumerate(amounts)])
    kept = apply_expectations(requests, EXPECTATIONS["refund_requests"])
    assert customer_refund_history(kept, SETTINGS).first().total_refund_amount == 1e20
    dropped = {r.expectation: r.dropped for r in expectation_report({"refund_requests": requests}).collect()}
    assert dropped == {"valid_refund_id": 0, "valid_amount": 3, "countable_amount": 2}


def test_recommended_action(spark):
    got = evaluate(spark, [0.2, 0.399, 0.4, 0.699, 0.7], "double", bands.recommended_action)
    assert got == ["APPROVE", "APPROVE", "ESCALATE", "ESCALATE", "REJECT"]


def test_workflow_state(spark):
    got = evaluate(spark, [0.199, 0.2, 0.4], "double", lambda s: bands.workflow_state(bands.recommended_action(s), s))
    assert got == ["auto_approved", "pending_review", "pending_review"]


def test_refund_frequency(spark):
    got = evaluate(spark, [2, 3, 5, 6, 10, 11, None], "long", bands.refund_frequency)
    assert got == ["low", "medium", "medium", "high", "high", "very_high", "low"]


def test_amount_score(spark):
    got = evaluate(spark, [100.0, 100.01, 200.0, 200.01, 500.0, 500.01], "double", bands.amount_score)
    assert got == [0.1, 0.3, 0.3, 0.5, 0.5, 0.8]


@pytest.mark.parametrize("rate, recent, coordinated, tier", [
    (0.15, 2, False, "LOW"), (0.151, 0, False, "MEDIUM"), (0.0, 3, False, "MEDIUM"), (0.25, 5, False, "MEDIUM"),
    (0.251, 0, False, "HIGH"), (0.0, 6, False, "HIGH"), (0.4, 10, False, "HIGH"), (0.401, 0, False, "CRITICAL"),
    (0.0, 11, False, "CRITICAL"), (0.0, 0, True, "CRITICAL"), (0.3, None, None, "HIGH"), (0.0, None, None, "LOW"),
    (0.401, None, None, "CRITICAL"),
])
def test_customer_tier(spark, rate, recent, coordinated, tier):
    df = spark.createDataFrame([(rate, recent, coordinated)], "r double, n long, c boolean")
    assert df.select(bands.customer_tier(F.col("r"), F.col("n"), F.col("c"))).first()[0] == tier


def test_component_scores(spark):
    schema = ("lifetime_orders long, lifetime_refunds long, cust_refunds_90d long, amount double, "
              "coordinated_timing_flag boolean, household_refund_count_30d long, reason_code string, "
              "delivery_confirmed boolean, within_return_window boolean, days_since_order int")
    rows = [
        (10, 2, 3, 600.0, True, 0, "ITEM_NOT_RECEIVED", True, False, 40),
        (10, 9, 30, 10.0, False, 4, "ITEM_NOT_RECEIVED", None, True, 26),
        (0, 5, None, 10.0, None, 3, "DAMAGED", True, True, 25),
        (None, None, None, 10.0, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in scoring.component_scores().items()])
    assert [tuple(row) for row in df.collect()] == [
        (0.5, 0.2, 0.8, 0.9, 1.0, 0.8),
        (1.0, 1.0, 0.1, 0.6, 0.5, 0.5),
        (0.0, 0.0, 0.1, 0.1, 0.1, 0.1),
        (0.0, 0.0, 0.1, 0.1, 0.1, 0.1),
    ]


def test_windows_are_inclusive_and_open_above(spark):
    rows = [
        dict(refund_id=str(n), customer_id=1, amount=10.0, request_date=day(n)) for n in (-5, 0, 30, 31, 90, 91)
    ]
    got = customer_refund_history(source(spark, "refund_requests", *rows), SETTINGS).first()
    assert (got.total_refunds, got.refunds_30d, got.refunds_90d) == (6, 3, 5)
    assert (got.total_refund_amount, got.total_refund_amount_90d, got.avg_refund_amount) == (60.0, 50.0, 10.0)
    assert got.last_refund_date == day(-5) and got.refund_frequency == "medium"


def test_rounding_ties_go_up(spark):
    assert evaluate(spark, [0.5025, 0.5075, 0.0005, 1.0049], "double", lambda x: round_to(x, 3)) == [
        0.503, 0.508, 0.001, 1.005]


def test_ratio_of_nothing(spark):
    assert spark.range(1).select(ratio(F.lit(0), F.lit(0))).first()[0] == 0.0


def test_sums_do_not_depend_on_order(spark):
    values = [(0.1,), (0.2,), (0.3,), (1e9,), (-1e9,), (0.7,)]
    sums = set()
    for order in (values, values[::-1], values[3:] + values[:3]):
        df = spark.createDataFrame(order, "amount double").repartition(3)
        sums.add(df.agg(metrics.exact_sum("amount")).first()[0])
    assert sums == {1.3}


def test_sums_of_wide_amounts(spark):
    values = [(12_345_678.91,), (1e9,), (0.09,), (-2e6,), (None,)]
    for order in (values, values[::-1]):
        assert spark.createDataFrame(order, "amount double").repartition(3).agg(
            metrics.exact_sum("amount")).first()[0] == 1_010_345_679.0
    huge = spark.createDataFrame([(1e300,), (1e9,), (0.5,)], "amount double")
    assert huge.agg(metrics.exact_sum("amount")).first()[0] == 1e300
    assert huge.filter("amount < 0").agg(metrics.exact_sum("amount")).first()[0] is None


def test_kpis_of_nothing(spark):
    from tests.frames import live

    kpis = metrics.dashboard_kpis(live(spark))
    assert kpis.first().total_cases == 0 and kpis.first().avg_risk_score is None
    rates = metrics.dashboard_rates(kpis.fillna(0)).first()
    assert (rates.approval_rate_pct, rates.rejection_rate_pct, rates.escalation_rate_pct) == (0.0, 0.0, 0.0)
