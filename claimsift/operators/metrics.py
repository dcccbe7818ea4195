"""Key figures, distributions and ready-made questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from claimsift.functions.bands import tier_rank
from claimsift.functions.numeric import SCORE, count_where, exact_sum, ratio, round_to, sum_where
from claimsift.settings import ABUSE_TIERS


def mean_score() -> Column:
    """Average risk score to three decimals, NULL without rows."""
    n = F.count("risk_score")
    return F.when(n > 0, round_to(exact_sum("risk_score", SCORE) / n, 3))


def _leakage() -> Column:
    return sum_where(F.col("recommended_action") == "REJECT", "amount")


def dashboard_kpis(live: DataFrame) -> DataFrame:
    state, action = F.col("workflow_state"), F.col("csr_action")
    return live.agg(
        F.count(F.lit(1)).alias("total_cases"),
        count_where(state == "pending_review").alias("pending_count"),
        count_where(state == "auto_approved").alias("auto_approved_count"),
        count_where(action == "approved").alias("approved_count"),
        count_where(action == "rejected").alias("rejected_count"),
        count_where(action == "escalated").alias("escalated_count"),
        mean_score().alias("avg_risk_score"),
        _leakage().alias("potential_leakage"),
        exact_sum("amount").alias("total_refund_amount"),
    )


def dashboard_rates(kpis: DataFrame) -> DataFrame:
    """Shares of approved, rejected and escalated cases in percent with one decimal."""
    approved = F.col("approved_count") + F.col("auto_approved_count")
    total = F.col("total_cases")

    def share(part: Column) -> Column:
        return ratio(part, total, digits=1, scale=100.0)

    return kpis.select(
        "total_cases", "pending_count",
        share(approved).alias("approval_rate_pct"),
        share(F.col("rejected_count")).alias("rejection_rate_pct"),
        share(F.col("escalated_count")).alias("escalation_rate_pct"),
    )


def risk_distribution(live: DataFrame) -> DataFrame:
    """Cases per score tier, most severe first."""
    per_tier = live.groupBy("abuse_risk_tier").agg(
        F.count(F.lit(1)).alias("case_count"), mean_score().alias("avg_score"),
        exact_sum("amount").alias("total_amount"),
    )
    return per_tier.orderBy(tier_rank(F.col("abuse_risk_tier")))


def risk_distribution_share(live: DataFrame) -> DataFrame:
    """Cases per score tier with their share of all; the tiers (four at most) are folded into one row for the total."""
    tiers = live.groupBy("abuse_risk_tier").agg(F.count(F.lit(1)).alias("case_count"))
    folded = tiers.agg(
        F.sum("case_count").alias("total"),
        F.collect_list(F.struct("abuse_risk_tier", "case_count")).alias("tiers"),
    )
    share = ratio(F.col("t.case_count"), F.col("total"), digits=1, scale=100.0)
    return folded.select("total", F.explode("tiers").alias("t")).select("t.*", share.alias("share_pct"))


def workflow_distribution(live: DataFrame) -> DataFrame:
    counts = live.groupBy("workflow_state", "abuse_risk_tier").agg(F.count(F.lit(1)).alias("case_count"))
    return counts.orderBy("workflow_state", "abuse_risk_tier")


def leakage_by_category(cases: DataFrame) -> DataFrame:
    per_category = cases.groupBy("product_category").agg(
        F.count(F.lit(1)).alias("total_cases"), _leakage().alias("potential_leakage"),
        mean_score().alias("avg_risk_score"),
    )
    return per_category.orderBy(F.desc("potential_leakage"), F.asc_nulls_last("product_category"))


def refund_leakage(cases: DataFrame, decisions: DataFrame) -> DataFrame:
    """Amount of the cases that should have been rejected but were approved in the past."""
    approved = decisions.filter(F.col("action") == "approved").select("refund_id").distinct()
    lost = cases.filter(F.col("recommended_action") == "REJECT").join(approved, "refund_id", "left_semi")
    return lost.agg(
        F.count(F.lit(1)).alias("leaked_cases"),
        F.coalesce(exact_sum("amount"), F.lit(0.0)).alias("refund_leakage"),
    )


def abuse_rate(profiles: DataFrame) -> DataFrame:
    """Share of customers with a high or critical tier in any membership; each customer counts once."""
    flagged = F.max(F.col("risk_tier").isin(*ABUSE_TIERS).cast("int"))
    per_customer = profiles.groupBy("customer_id").agg(flagged.alias("abusive"))
    return per_customer.agg(
        F.count(F.lit(1)).alias("customers"),
        F.coalesce(F.sum("abusive"), F.lit(0)).cast("long").alias("abusive_customers"),
        ratio(F.sum("abusive"), F.count(F.lit(1))).alias("abuse_rate"),
    )


def recommendation_rates(cases: DataFrame) -> DataFrame:
    n, action = F.count(F.lit(1)), F.col("recommended_action")
    return cases.agg(
        n.alias("total_cases"),
        ratio(count_where(action == "APPROVE"), n).alias("approval_rate"),
        ratio(count_where(action == "ESCALATE"), n).alias("escalation_rate"),
        ratio(count_where(action == "REJECT"), n).alias("rejection_rate"),
    )


def rejection_by_reason(cases: DataFrame) -> DataFrame:
    rejected = count_where(F.col("recommended_action") == "REJECT")
    per_reason = cases.groupBy("reason_code").agg(
        F.count(F.lit(1)).alias("total_cases"), rejected.alias("rejected_cases"),
        ratio(rejected, F.count(F.lit(1))).alias("rejection_rate"),
    )
    return per_reason.orderBy(F.desc("rejection_rate"), F.asc_nulls_last("reason_code"))


def escalation_by_segment(segments: DataFrame, above: float = 0.1) -> DataFrame:
    keys = ("channel", "reason_code", "tier", "risk_tier")
    kept = segments.filter(F.col("escalation_rate") > above)
    return kept.select(*keys, "total_cases", "escalation_rate", "avg_risk_score").orderBy(
        F.desc("escalation_rate"), *[F.asc_nulls_last(key) for key in keys])


def top_abuse_customers(profiles: DataFrame, limit: int = 20) -> DataFrame:
    """Customers with a high or critical tier, highest refund rate first."""
    columns = (
        "customer_id", "first_name", "last_name", "tier", "risk_tier", "refund_rate", "refunds_90d",
        "total_refund_amount_90d", "coordinated_timing_flag", "household_id",
    )
    risky = profiles.filter(F.col("risk_tier").isin(*ABUSE_TIERS)).select(*columns)
    order = (F.desc("refund_rate"), F.asc("customer_id"), F.asc_nulls_last("household_id"))
    return risky.orderBy(*order).limit(limit)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
