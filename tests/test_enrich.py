"""Enrichment and scoring of claims with missing or odd neighbours."""

import json

import pytest

from claimsift.operators import enrich, history, household, profiles, scoring
from tests.frames import SETTINGS, day, source


@pytest.fixture(scope="module")
def tables(spark):
    t = {
        "requests": source(
            spark, "refund_requests",
            dict(refund_id="full", order_id="O1", customer_id=1, reason_code="DAMAGED", amount=25.0, request_date=day(1)),
            dict(refund_id="no_order", order_id=None, customer_id=1, reason_code="DAMAGED", amount=5.0, request_date=day(1)),
            dict(refund_id="unknown", order_id="O9", customer_id=9, reason_code="DAMAGED", amount=5.0, request_date=day(1)),
            dict(refund_id="no_product", order_id="O2", customer_id=2, reason_code="DAMAGED", amount=7.0, request_date=day(1)),
            dict(refund_id="no_policy", order_id="O1", customer_id=1, reason_code="DEFECTIVE", amount=5.0, request_date=day(1)),
            dict(refund_id="not_delivered", order_id="O3", customer_id=1, reason_code="DAMAGED", amount=5.0,
                 request_date=day(1)),
        ),
        "orders": source(
            spark, "order_history",
            dict(order_id="O1", product_id="P1", order_date=day(32), total_amount=100.0),
            dict(order_id="O2", order_date=day(31), total_amount=0.0),
            dict(order_id="O3", product_id="P1", order_date=day(10), total_amount=3.0),
        ),
        "customers": source(
            spark, "customer_profiles",
            dict(customer_id=1, tier="VIP", lifetime_orders=10, lifetime_refunds=1),
            dict(customer_id=2, tier="New", lifetime_orders=0, lifetime_refunds=0),
        ),
        "products": source(spark, "product_catalog", dict(product_id="P1", category="Books", is_high_value=False)),
        "deliveries": source(
            spark, "delivery_events",
            dict(delivery_id="D-009", order_id="O1", status="delivered", photo_proof=True),
            dict(delivery_id="D-010", order_id="O1", status="attempted", photo_proof=None, delivery_issues="late"),
            dict(delivery_id="D-011", order_id="O2", status="delivered", photo_proof=None),
        ),
        "policies": source(
            spark, "refund_policies", dict(policy_id="L", category="Books", reason_code="DAMAGED", max_refund_window_days=31)),
        "members": source(
            spark, "household_mappings",
            dict(mapping_id=1, household_id="H1", customer_id=1), dict(mapping_id=2, household_id="H2", customer_id=1),
            dict(mapping_id=3, household_id="H2", customer_id=2), dict(mapping_id=4, household_id="H3", customer_id=3),
        ),
    }
    t["latest"] = enrich.latest_delivery(t["deliveries"])
    t["enriched"] = enrich.enrich_requests(
        t["requests"], t["orders"], t["customers"], t["products"], t["latest"], t["policies"], SETTINGS)
    t["history"] = history.customer_refund_history(t["requests"], SETTINGS)
    t["activity"] = household.household_activity(t["requests"], t["members"], SETTINGS)
    return t


def test_one_row_per_claim(tables):
    assert tables["enriched"].count() == tables["requests"].count()


def test_latest_delivery_is_the_greatest_id(tables):
    latest = {row.order_id: row.delivery_status_actual for row in tables["latest"].collect()}
    assert latest == {"O1": "attempted", "O2": "delivered"}


@pytest.mark.parametrize("refund_id, days, in_window, ratio, confirmed", [
    ("full", 31, True, 0.25, False),
    ("no_order", None, None, 1.0, None),
    ("unknown", None, None, 1.0, None),
    ("no_product", 30, True, 1.0, None),        # default window of 30 days, order of 0; delivered, photo unknown
    ("no_policy", 31, False, 0.05, False),
    ("not_delivered", 9, True, 1.667, None),
])
def test_derived_columns(tables, refund_id, days, in_window, ratio, confirmed):
    row = tables["enriched"].filter(f"refund_id = '{refund_id}'").first()
    got = (row.days_since_order, row.within_return_window, row.refund_to_order_ratio, row.delivery_confirmed)
    assert got == (days, in_window, ratio, confirmed)


def test_cases_fan_out_over_memberships(tables):
    args = (tables["enriched"], tables["history"], tables["members"], tables["activity"], SETTINGS)
    fanned = scoring.case_decisioning(*args)
    single = scoring.case_decisioning(*args, dedupe=True)
    hot = scoring.case_decisioning(*args, min_rows=2, salts=3)
    assert fanned.count() == 10 and single.count() == 6
    assert sorted(map(str, fanned.collect())) == sorted(map(str, hot.collect()))
    assert {row.household_id for row in single.filter("customer_id = 1").collect()} == {"H2"}
    assert single.filter("refund_id = 'unknown'").first().household_id is None


def test_reasons_leave_out_what_is_unknown(tables):
    cases = scoring.case_decisioning(
        tables["enriched"], tables["history"], tables["members"], tables["activity"], SETTINGS, dedupe=True)
    reasons = {r.refund_id: json.loads(r.recommendation_reasons_json) for r in cases.collect()}
    assert set(reasons["full"]) == {*SETTINGS.weights, *scoring.REASON_FACTS}
    assert set(reasons["unknown"]) == set(SETTINGS.weights)
    parsed = scoring.decision_reasons(cases, SETTINGS).filter("refund_id = 'full'").first()
    assert (parsed.amount_score, parsed.days_since_order, parsed.delivery_confirmed) == (0.1, 31, False)


def test_profiles_of_quiet_customers(spark, tables):
    quiet = source(spark, "customer_profiles", dict(customer_id=3, lifetime_orders=4), dict(customer_id=4))
    for options in (dict(), dict(dedupe=True), dict(min_rows=1)):
        rows = {row.customer_id: row for row in profiles.customer_360(
            quiet, tables["history"], tables["members"], tables["activity"], **options).collect()}
        assert rows[3].household_id == "H3" and rows[3].coordinated_timing_flag is None
        assert rows[3].refund_rate == 0.0 and rows[3].risk_tier == "LOW" and rows[3].total_refunds is None
        assert rows[4].household_id is None and rows[4].refund_rate == 0.0
