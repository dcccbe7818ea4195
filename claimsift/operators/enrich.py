"""Claims joined with their order, customer, product, latest delivery and policy."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimsift.functions.numeric import round_to
from claimsift.operators.keyed import first_per_key
from claimsift.settings import Settings


def latest_delivery(deliveries: DataFrame) -> DataFrame:
    """The delivery with the greatest id (compared as text) per order; a repeated id is decided by its values."""
    values = ("status", "delivery_issues", "photo_proof")
    narrow = deliveries.select("order_id", "delivery_id", *values)
    return first_per_key(narrow, ["order_id"], F.desc("delivery_id"), *map(F.desc, values)).select(
        "order_id", F.col("status").alias("delivery_status_actual"), "delivery_issues", "photo_proof",
    )


def enrich_requests(
    requests: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, latest_deliveries: DataFrame,
    policies: DataFrame, settings: Settings,
) -> DataFrame:
    """One row per claim with everything known about it.

    The two joins on the order come first so that the claims are shuffled once for both. Products and policies carry no
    broadcast hint: the planner broadcasts them when their measured size allows it and shuffles them otherwise.
    """
    order_part = orders.select(
        "order_id", F.col("total_amount").alias("order_amount"), "order_date",
        F.col("delivery_status").alias("order_delivery_status"), "payment_method", "store_id", "product_id",
    )
    customer_part = customers.select(
        "customer_id", "first_name", "last_name", "tier", "lifetime_orders", "lifetime_refunds", "lifetime_spend",
    )
    product_part = products.select(
        "product_id", F.col("name").alias("product_name"), F.col("category").alias("product_category"),
        F.col("price").alias("product_price"), "refund_rate_baseline", "is_high_value",
    )
    policy_part = policies.select(
        F.col("category").alias("product_category"), "reason_code", "max_refund_window_days",
        "auto_approve_threshold", "requires_return",
    )
    joined = (
        requests
        .join(order_part, "order_id", "left")
        .join(latest_deliveries, "order_id", "left")
        .join(customer_part, "customer_id", "left")
        .join(product_part, "product_id", "left")
        .join(policy_part, ["product_category", "reason_code"], "left")
        .drop("product_id")
    )
    allowed_days = F.coalesce("max_refund_window_days", F.lit(settings.default_return_window))
    share = F.when(F.col("order_amount") > 0, round_to(F.col("amount") / F.col("order_amount"), 3))
    return joined.withColumns({
        "days_since_order": F.datediff("request_date", "order_date"),
        "within_return_window": F.datediff("request_date", "order_date") <= allowed_days,
        "refund_to_order_ratio": share.otherwise(F.lit(1.0)),
        "delivery_confirmed": (F.col("delivery_status_actual") == "delivered") & F.col("photo_proof"),
    })
