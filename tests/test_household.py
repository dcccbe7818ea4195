"""Household activity against a row-by-row computation."""

import random

import pytest
from pyspark.sql import functions as F

from claimsift.operators import household
from tests.frames import SETTINGS, day, source

REASONS = ("DAMAGED", "WRONG_ITEM", "DEFECTIVE")


def brute_force(requests, members):
    rows = {}
    for m in members:
        for r in requests:
            if m["customer_id"] == r["customer_id"]:
                rows.setdefault(m["household_id"], []).append(r)
    result = {}
    for home, claims in rows.items():
        claims = sorted(claims, key=lambda r: (r["request_date"], r["refund_id"], r["customer_id"]))
        coordinated = sum(
            (b["request_date"] - a["request_date"]).days * 24 <= 48 and a["customer_id"] != b["customer_id"]
            for a, b in zip(claims, claims[1:]))
        result[home] = (
            len({r["customer_id"] for r in claims}), len(claims),
            sum(r["request_date"] >= day(30) for r in claims),
            round(sum(r["amount"] for r in claims), 2),
            ", ".join(sorted({r["reason_code"] for r in claims})), coordinated, coordinated > 0)
    return result


def computed(spark, requests, members):
    activity = household.household_activity(
        source(spark, "refund_requests", *requests), source(spark, "household_mappings", *members), SETTINGS)
    columns = ["members_with_refunds", "total_refunds", "refund_count_30d", "total_refund_amount", "reason_codes"]
    rows = activity.select("household_id", *[f"household_{c}" for c in columns], "coordinated_refund_count",
                           "coordinated_timing_flag")
    return {row[0]: tuple(row)[1:] for row in rows.collect()}


def claims(*who_when):
    return [dict(refund_id=f"R{i}", customer_id=who, request_date=day(when), amount=10.0, reason_code="DAMAGED")
            for i, (who, when) in enumerate(who_when)]


def homes(*customers, home="H"):
    return [dict(mapping_id=i, household_id=home, customer_id=c) for i, c in enumerate(customers)]


@pytest.mark.parametrize("seed", range(3))
def test_random_households(spark, seed):
    rng = random.Random(seed)
    requests = [
        dict(refund_id=f"R{i:03}", customer_id=rng.choice([1, 1, 1, 2, 3, 4, 5, 6, 7, 8]), request_date=day(rng.randrange(50)),
             amount=rng.randrange(1, 9999) / 100, reason_code=rng.choice(REASONS))
        for i in range(120)
    ]
    members = [
        dict(mapping_id=i, household_id=f"H{rng.randrange(4)}", customer_id=rng.randrange(1, 11)) for i in range(25)
    ]
    assert computed(spark, requests, members) == brute_force(requests, members)


@pytest.mark.parametrize("sequence, coordinated", [
    ([(1, 9), (2, 7)], 1),                      # exactly 48 hours apart
    ([(1, 9), (2, 6)], 0),                      # 72 hours
    ([(1, 9), (1, 8), (2, 7)], 1),              # A, A, B
    ([(1, 9), (2, 8), (1, 7)], 2),              # A, B, A
    ([(1, 9), (2, 9), (3, 9)], 2),              # three members on one day
    ([(1, 9), (1, 9), (1, 8)], 0),              # one member only
])
def test_sequences(spark, sequence, coordinated):
    got = computed(spark, claims(*sequence), homes(1, 2, 3))
    assert got["H"][5:] == (coordinated, coordinated > 0)


def test_same_day_claims_follow_their_ids(spark):
    """A, B, A on one day changes twice."""
    assert computed(spark, claims((1, 9), (2, 9), (1, 9)), homes(1, 2))["H"][5] == 2


def test_repeated_membership_counts_claims_twice_but_members_once(spark):
    members = homes(1, 2) + [dict(mapping_id=9, household_id="H", customer_id=1)]
    requests = claims((1, 9), (2, 20))
    assert computed(spark, requests, members) == brute_force(requests, members)


def test_undated_and_anonymous_claims(spark):
    requests = claims((1, 9), (2, 9)) + [
        dict(refund_id="U", customer_id=1, amount=5.0, reason_code="DEFECTIVE"),
        dict(refund_id="V", amount=5.0, reason_code="DEFECTIVE", request_date=day(9)),
    ]
    got = computed(spark, requests, homes(1, 2))
    assert got == {"H": (2, 3, 2, 25.0, "DAMAGED, DEFECTIVE", 1, True)}


def test_coordination_alone_equals_activity(spark):
    requests, members = claims((1, 9), (2, 8), (1, 7), (3, 30)), homes(1, 2, 3)
    days = household.household_days(
        source(spark, "refund_requests", *requests), source(spark, "household_mappings", *members))
    got = household.household_coordination(household.household_day_sequence(days, SETTINGS)).first()
    assert tuple(got) == ("H", 2, True)


@pytest.mark.parametrize("seed", range(2))
def test_segmented_days_equal_plain_ones(spark, seed, conf):
    """All claims of few days in few households, so that most days are hot and reach over several tasks."""
    conf(spark__sql__shuffle__partitions="7")
    rng = random.Random(seed)
    requests = [dict(refund_id=f"R{rng.randrange(400):03}", customer_id=rng.choice([None, 1, 1, 2, 3, 4]),
                     request_date=rng.choice([day(1), day(2), day(2), None]), amount=1.0, reason_code="DAMAGED")
                for _ in range(400)]
    members = [dict(mapping_id=i, household_id=f"H{rng.randrange(3)}", customer_id=rng.randrange(1, 5)) for i in range(9)]
    args = source(spark, "refund_requests", *requests), source(spark, "household_mappings", *members)
    plain = household.household_days(*args)
    for hot_day in (1, 60):
        spread = household.household_days(*args, hot_day)
        assert spread.columns == plain.columns
        assert sorted(map(repr, spread.collect())) == sorted(map(repr, plain.collect()))


def test_a_hot_day_is_compared_in_segments(spark, conf):
    conf(spark__sql__shuffle__partitions="8")
    requests = source(spark, "refund_requests", *claims(*[(1 + i % 3, 5) for i in range(800)]))
    members = source(spark, "household_mappings", *homes(1, 2, 3))
    dated = requests.select("refund_id", "customer_id", "request_date")
    assert household.hot_days(dated, members.select("household_id", "customer_id"), 700) == [("H", day(5))]
    assert household.hot_days(dated, members.select("household_id", "customer_id"), 801) == []
    joined = dated.join(members.select("household_id", "customer_id"), "customer_id")
    spread = joined.repartitionByRange(8, *household._DAY, "refund_id", "customer_id")
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 300
    plan = household._segmented(joined)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(household_id" in plan and "segment" in plan
