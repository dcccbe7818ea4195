"""Risk score, recommended action and its reasons for every claim."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from claimsift.functions.bands import amount_score, banded, recommended_action, score_tier
from claimsift.functions.numeric import MONEY, SCORE, count_where, exact_sum, ratio, round_to
from claimsift.operators.keyed import HotKeys
from claimsift.operators.profiles import member_signals, strongest_membership
from claimsift.settings import Settings

# The facts listed with the component scores as reasons of a recommendation.
REASON_FACTS = ("within_return_window", "delivery_confirmed", "days_since_order")

# The columns of a scored case.
CASE_COLUMNS = (
    "refund_id", "order_id", "customer_id", "first_name", "last_name", "tier",
    "reason_code", "amount", "channel", "request_date", "item_condition",
    "order_amount", "order_date", "payment_method", "product_name", "product_category", "product_price",
    "is_high_value", "days_since_order", "within_return_window", "delivery_confirmed", "delivery_issues",
    "refund_to_order_ratio", "lifetime_orders", "lifetime_refunds",
    "cust_refunds_90d", "cust_refund_amt_90d", "refund_frequency", "household_id", "coordinated_timing_flag",
    "risk_score", "recommended_action", "recommendation_reasons_json",
)


def component_scores() -> dict[str, Column]:
    """The six components, each between 0 and 1."""
    orders = F.col("lifetime_orders")
    refunds = F.coalesce("lifetime_refunds", F.lit(0))
    not_received = F.col("reason_code") == "ITEM_NOT_RECEIVED"
    return {
        "refund_rate_score": F.least(F.lit(1.0), F.when(orders > 0, refunds / orders * 2.5).otherwise(F.lit(0.0))),
        "frequency_score": F.least(F.lit(1.0), F.coalesce("cust_refunds_90d", F.lit(0)) / F.lit(15.0)),
        "amount_score": amount_score(F.col("amount")),
        "household_score": banded(
            [(F.col("coordinated_timing_flag"), 0.9), (F.col("household_refund_count_30d") > 3, 0.6)], 0.1),
        "delivery_score": banded([(not_received & F.col("delivery_confirmed"), 1.0), (not_received, 0.5)], 0.1),
        "policy_score": banded([(~F.col("within_return_window"), 0.8), (F.col("days_since_order") > 25, 0.5)], 0.1),
    }


def risk_score(settings: Settings) -> Column:
    return round_to(reduce(add, [F.col(name) * F.lit(weight) for name, weight in settings.weights.items()]), 3)


def case_decisioning(
    enriched: DataFrame, history: DataFrame, households: DataFrame, activity: DataFrame, settings: Settings,
    dedupe: bool = False, **hot: int,
) -> DataFrame:
    """One row per claim and household membership of its customer, or per claim with ``dedupe``."""
    past = history.select(
        "customer_id", F.col("refunds_90d").alias("cust_refunds_90d"),
        F.col("total_refund_amount_90d").alias("cust_refund_amt_90d"), "refund_frequency",
    )
    signals = member_signals(households, activity).drop("shared_address_flag", "household_total_refund_amount")
    if dedupe:
        joined = enriched.join(past, "customer_id", "left").join(strongest_membership(signals), "customer_id", "left")
    else:
        joined = HotKeys(households, "customer_id", **hot).left(enriched, signals, "mapping_id", past)
    reasons = F.to_json(F.struct(*settings.weights, *REASON_FACTS))
    return (
        joined
        .withColumns(component_scores())
        .withColumn("risk_score", risk_score(settings))
        .withColumn("recommended_action", recommended_action(F.col("risk_score")))
        .withColumn("recommendation_reasons_json", reasons)
        .select(*CASE_COLUMNS)
    )


def decision_reasons(cases: DataFrame, settings: Settings) -> DataFrame:
    """The reasons of each recommendation as typed columns, read back from their JSON."""
    schema = ", ".join(
        [f"{name} double" for name in settings.weights]
        + ["within_return_window boolean", "delivery_confirmed boolean", "days_since_order int"])
    parsed = F.from_json("recommendation_reasons_json", schema)
    return cases.select("refund_id", "household_id", "risk_score", parsed.alias("r")).select(
        "refund_id", "household_id", "risk_score", "r.*")


def segment_summary(cases: DataFrame) -> DataFrame:
    """Counts, averages and rates per reason, channel, customer tier and score tier."""
    action = F.col("recommended_action")
    n = F.count("refund_id")
    summary = cases.groupBy(
        "reason_code", "channel", "tier", score_tier(F.col("risk_score")).alias("risk_tier"),
    ).agg(
        n.alias("total_cases"),
        count_where(action == "APPROVE").alias("approved_count"),
        count_where(action == "ESCALATE").alias("escalated_count"),
        count_where(action == "REJECT").alias("rejected_count"),
        (exact_sum("risk_score", SCORE) / F.count("risk_score")).alias("avg_risk_score"),
        exact_sum("amount", MONEY).alias("total_refund_amount"),
        (exact_sum("amount", MONEY) / F.count("amount")).alias("avg_refund_amount"),
    )
    return summary.withColumns({
        "approval_rate": ratio(F.col("approved_count"), F.col("total_cases")),
        "escalation_rate": ratio(F.col("escalated_count"), F.col("total_cases")),
    })
