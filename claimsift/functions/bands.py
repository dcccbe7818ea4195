"""Threshold rules that turn measures into named bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed values: (lower bound, band), from the highest bound down; the last entry is the band of everything below.
SCORE_TIER_BOUNDS = ((0.7, "CRITICAL"), (0.4, "HIGH"), (0.2, "MEDIUM"))
RECOMMENDATION_BOUNDS = ((0.7, "REJECT"), (0.4, "ESCALATE"))
FREQUENCY_BOUNDS = ((10, "very_high"), (5, "high"), (2, "medium"))
CUSTOMER_TIER_BOUNDS = ((0.4, 10, "CRITICAL"), (0.25, 5, "HIGH"), (0.15, 2, "MEDIUM"))
AMOUNT_BOUNDS = ((500, 0.8), (200, 0.5), (100, 0.3))
AUTO_APPROVE_BELOW = 0.2


def banded(rules: list[tuple[Column, object]], default: object) -> Column:
    """First matching rule wins; a NULL condition does not match."""
    (condition, value), *rest = rules
    chain = reduce(lambda c, rule: c.when(rule[0], F.lit(rule[1])), rest, F.when(condition, F.lit(value)))
    return chain.otherwise(F.lit(default))


def score_tier(score: Column) -> Column:
    return banded([(score >= bound, tier) for bound, tier in SCORE_TIER_BOUNDS], "LOW")


def recommended_action(score: Column) -> Column:
    return banded([(score >= bound, action) for bound, action in RECOMMENDATION_BOUNDS], "APPROVE")


def refund_frequency(refunds_long_window: Column) -> Column:
    return banded([(refunds_long_window > bound, band) for bound, band in FREQUENCY_BOUNDS], "low")


def customer_tier(refund_rate: Column, refunds_long_window: Column, coordinated: Column) -> Column:
    rules = [((refund_rate > rate) | (refunds_long_window > count), tier) for rate, count, tier in CUSTOMER_TIER_BOUNDS]
    rules[0] = (rules[0][0] | coordinated, rules[0][1])
    return banded(rules, "LOW")


def amount_score(amount: Column) -> Column:
    return banded([(amount > bound, score) for bound, score in AMOUNT_BOUNDS], 0.1)


def workflow_state(action: Column, score: Column) -> Column:
    return banded([((action == "APPROVE") & (score < AUTO_APPROVE_BELOW), "auto_approved")], "pending_review")


def tier_rank(tier: Column) -> Column:
    """1 for CRITICAL, 2 for HIGH, 3 for MEDIUM, 4 for anything else."""
    return banded([(tier == "CRITICAL", 1), (tier == "HIGH", 2), (tier == "MEDIUM", 3)], 4)
