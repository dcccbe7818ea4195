"""Claim history per customer.

``claim_days`` are partial sums by customer, reason and day that add up in any order: a new day of claims, or late claims of
an old one, are reduced once and appended, and the figures for any as-of date follow from the partial sums alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimsift.functions.bands import refund_frequency
from claimsift.functions.numeric import combined, count_where, exact_sum, parts_to_sum, sum_where
from claimsift.settings import Settings


def within_last(days: int, settings: Settings) -> Column:
    """Claims no older than ``days`` before the as-of date; later dates count too."""
    return F.col("request_date") >= F.date_sub(F.lit(settings.as_of), days)


def customer_refund_history(requests: DataFrame, settings: Settings) -> DataFrame:
    recent = within_last(settings.short_window_days, settings)
    quarter = within_last(settings.long_window_days, settings)
    totals = requests.withColumn("request_date", F.col("request_date").cast("date")).groupBy("customer_id").agg(
        F.count("refund_id").alias("total_refunds"),
        exact_sum("amount").alias("total_refund_amount"),
        count_where(recent).alias("refunds_30d"),
        count_where(quarter).alias("refunds_90d"),
        sum_where(quarter, "amount").alias("total_refund_amount_90d"),
        (exact_sum("amount") / F.count("amount")).alias("avg_refund_amount"),
        F.max("request_date").alias("last_refund_date"),
    )
    return totals.withColumn("refund_frequency", refund_frequency(F.col("refunds_90d")))


#: The parts of a sum of money, see ``numeric.parts_to_sum``.
AMOUNT_PARTS = ("cents", "wide", "widest")


def claim_days(requests: DataFrame) -> DataFrame:
    """One row per customer, reason and day of some claims. Rows of several batches of claims may lie side by side."""
    return requests.groupBy("customer_id", "reason_code", F.col("request_date").cast("date").alias("request_date")).agg(
        F.count(F.lit(1)).alias("filed"),
        F.count("refund_id").alias("claims"),
        F.count("amount").alias("amounts"),
        *[F.sum(part).alias(name) for name, part in zip(AMOUNT_PARTS, parts_to_sum("amount"))],
    )


def _added(condition: Column | None = None) -> Column:
    """The money of all partial sums, or of those that meet ``condition``."""
    parts = [F.col(name) if condition is None else F.when(condition, F.col(name)) for name in AMOUNT_PARTS]
    return combined(*[F.sum(part) for part in parts])


def history_from_days(days: DataFrame, settings: Settings) -> DataFrame:
    """``customer_refund_history`` from the partial sums."""
    recent = within_last(settings.short_window_days, settings)
    quarter = within_last(settings.long_window_days, settings)

    def filed_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("filed")).otherwise(F.lit(0))).cast("long")

    totals = days.groupBy("customer_id").agg(
        F.sum("claims").cast("long").alias("total_refunds"),
        _added().alias("total_refund_amount"),
        filed_where(recent).alias("refunds_30d"),
        filed_where(quarter).alias("refunds_90d"),
        F.coalesce(_added(quarter), F.lit(0.0)).alias("total_refund_amount_90d"),
        F.when(F.sum("amounts") > 0, _added() / F.sum("amounts")).alias("avg_refund_amount"),
        F.max("request_date").alias("last_refund_date"),
    )
    return totals.withColumn("refund_frequency", refund_frequency(F.col("refunds_90d")))
