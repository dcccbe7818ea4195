"""Explicit schemas of the nine source tables, the serving table and the append logs."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(*columns: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


SOURCES: dict[str, T.StructType] = {
    "refund_requests": _struct(
        ("refund_id", "string"), ("order_id", "string"), ("customer_id", "long"), ("reason_code", "string"),
        ("amount", "double"), ("channel", "string"), ("request_date", "date"), ("item_condition", "string"),
    ),
    "order_history": _struct(
        ("order_id", "string"), ("customer_id", "long"), ("product_id", "string"), ("order_date", "date"),
        ("total_amount", "double"), ("delivery_status", "string"), ("payment_method", "string"),
        ("store_id", "string"),
    ),
    "customer_profiles": _struct(
        ("customer_id", "long"), ("first_name", "string"), ("last_name", "string"), ("email", "string"),
        ("tier", "string"), ("lifetime_orders", "long"), ("lifetime_refunds", "long"), ("lifetime_spend", "double"),
        ("account_created_date", "date"),
    ),
    "household_mappings": _struct(
        ("mapping_id", "long"), ("household_id", "string"), ("customer_id", "long"), ("relationship", "string"),
        ("shared_address_flag", "boolean"),
    ),
    "store_locations": _struct(
        ("store_id", "string"), ("name", "string"), ("region", "string"), ("city", "string"), ("state", "string"),
    ),
    "product_catalog": _struct(
        ("product_id", "string"), ("name", "string"), ("category", "string"), ("price", "double"),
        ("refund_rate_baseline", "double"), ("is_high_value", "boolean"),
    ),
    "delivery_events": _struct(
        ("delivery_id", "string"), ("order_id", "string"), ("carrier", "string"), ("status", "string"),
        ("delivery_issues", "string"), ("photo_proof", "boolean"),
    ),
    "refund_policies": _struct(
        ("policy_id", "string"), ("category", "string"), ("reason_code", "string"), ("max_refund_window_days", "int"),
        ("auto_approve_threshold", "double"), ("requires_return", "boolean"),
    ),
    "historical_decisions": _struct(
        ("decision_id", "string"), ("refund_id", "string"), ("action", "string"), ("reason", "string"),
        ("override_flag", "boolean"), ("decided_at", "date"),
    ),
}

LIVE_CASES = _struct(
    ("refund_id", "string"), ("workflow_state", "string"), ("abuse_risk_tier", "string"), ("order_id", "string"),
    ("customer_id", "long"), ("first_name", "string"), ("last_name", "string"), ("tier", "string"),
    ("reason_code", "string"), ("amount", "double"), ("channel", "string"), ("request_date", "date"),
    ("item_condition", "string"), ("order_amount", "double"), ("order_date", "date"), ("payment_method", "string"),
    ("product_name", "string"), ("product_category", "string"), ("product_price", "double"),
    ("is_high_value", "boolean"), ("days_since_order", "int"), ("within_return_window", "boolean"),
    ("delivery_confirmed", "boolean"), ("delivery_issues", "string"), ("refund_to_order_ratio", "double"),
    ("lifetime_orders", "int"), ("lifetime_refunds", "int"), ("cust_refunds_90d", "int"),
    ("cust_refund_amt_90d", "double"), ("refund_frequency", "string"), ("household_id", "string"),
    ("coordinated_timing_flag", "boolean"), ("risk_score", "double"), ("recommended_action", "string"),
    ("recommendation_reasons_json", "string"), ("csr_action", "string"), ("csr_reason", "string"),
    ("csr_acted_at", "timestamp"), ("ai_explanation", "string"),
)

ACTION_LOG = _struct(("refund_id", "string"), ("action", "string"), ("reason", "string"), ("acted_at", "timestamp"))

FEEDBACK_LOG = _struct(
    ("feedback_id", "string"), ("refund_id", "string"), ("feedback_type", "string"), ("notes", "string"),
    ("submitted_at", "timestamp"),
)

QUALITY_LOG = _struct(
    ("run", "string"), ("run_at", "timestamp"), ("table_name", "string"), ("expectation", "string"), ("passed", "long"),
    ("dropped", "long"),
)

REPLY = T.StructType([
    T.StructField("action", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("explanation", T.StringType()),
    T.StructField("key_factors", T.ArrayType(T.StringType())),
])
