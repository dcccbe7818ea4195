"""Customer profiles with claim history and household signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimsift.functions.bands import customer_tier
from claimsift.functions.numeric import ratio
from claimsift.operators.keyed import HotKeys, first_per_key

# What a profile and its household contribute, in the order of the profile table.
PROFILE_COLUMNS = (
    "customer_id", "first_name", "last_name", "email", "tier", "lifetime_orders", "lifetime_refunds", "lifetime_spend",
    "account_created_date", "total_refunds", "total_refund_amount", "avg_refund_amount", "refunds_30d", "refunds_90d",
    "total_refund_amount_90d", "refund_frequency", "last_refund_date", "refund_rate", "risk_tier", "household_id",
    "shared_address_flag",
)
_SIGNALS = ("household_refund_count_30d", "coordinated_timing_flag", "household_total_refund_amount")


def member_signals(households: DataFrame, activity: DataFrame) -> DataFrame:
    """The activity of its household on every membership; a customer has one row per membership."""
    members = households.select("mapping_id", "customer_id", "household_id", "shared_address_flag")
    return members.join(activity.select("household_id", *_SIGNALS), "household_id", "left")


def strongest_membership(signals: DataFrame) -> DataFrame:
    """One membership per customer: a coordinated household first, then the most active, then the lowest id."""
    return first_per_key(
        signals, ["customer_id"],
        F.desc_nulls_last("coordinated_timing_flag"), F.desc_nulls_last("household_refund_count_30d"),
        F.asc("household_id"), F.asc("mapping_id"),
    )


def customer_360(
    customers: DataFrame, history: DataFrame, households: DataFrame, activity: DataFrame, dedupe: bool = False,
    **hot: int,
) -> DataFrame:
    """One row per customer and household membership, or per customer with ``dedupe``."""
    signals = member_signals(households, activity)
    if dedupe:
        joined = customers.join(history, "customer_id", "left").join(
            strongest_membership(signals), "customer_id", "left")
    else:
        joined = HotKeys(households, "customer_id", **hot).left(customers, signals, "mapping_id", history)
    refund_rate = ratio(F.coalesce("total_refunds", F.lit(0)), F.col("lifetime_orders"))
    tier = customer_tier(F.col("refund_rate"), F.col("refunds_90d"), F.col("coordinated_timing_flag"))
    return joined.withColumn("refund_rate", refund_rate).withColumn("risk_tier", tier).select(
        *PROFILE_COLUMNS, *_SIGNALS)


def one_row_per_customer(profiles: DataFrame) -> DataFrame:
    """Reduces profiles at membership grain to the strongest membership of each customer."""
    return first_per_key(
        profiles, ["customer_id"],
        F.desc_nulls_last("coordinated_timing_flag"), F.desc_nulls_last("household_refund_count_30d"),
        F.asc_nulls_last("household_id"), F.desc_nulls_last("shared_address_flag"),
    )
