"""The SQL of every query, each with the tables it needs spelt out in front."""

from __future__ import annotations

import re

from oracle.sources import SOURCES
from oracle.tables import AS_OF, TABLES, counted, exact, money, score_sum, share

PARTS = SOURCES | TABLES

CASE = """refund_id, order_id, customer_id, first_name, last_name, tier, reason_code, amount, channel, request_date,
    item_condition, order_amount, order_date, payment_method, product_name, product_category, product_price,
    is_high_value, days_since_order, within_return_window, delivery_confirmed, delivery_issues, refund_to_order_ratio,
    lifetime_orders, lifetime_refunds, cust_refunds_90d, cust_refund_amt_90d, refund_frequency, household_id,
    coordinated_timing_flag, risk_score, recommended_action"""
LIVE = CASE.replace(
    "lifetime_orders, lifetime_refunds, cust_refunds_90d,",
    "CAST(lifetime_orders AS INTEGER) AS lifetime_orders, CAST(lifetime_refunds AS INTEGER) AS lifetime_refunds, "
    "CAST(cust_refunds_90d AS INTEGER) AS cust_refunds_90d,") + ", workflow_state, abuse_risk_tier"
NO_REVIEW = """CAST(NULL AS VARCHAR) AS csr_action, CAST(NULL AS VARCHAR) AS csr_reason,
    CAST(NULL AS TIMESTAMP) AS csr_acted_at, CAST(NULL AS VARCHAR) AS ai_explanation"""
QUEUE = """refund_id, order_id, customer_id, first_name, last_name, tier, reason_code, amount, channel, request_date,
    risk_score, recommended_action, workflow_state, abuse_risk_tier, product_name, product_category, household_id"""
MEAN_SCORE = exact(f"{score_sum()} / count(risk_score)")
LEAKAGE = money("CASE WHEN recommended_action = 'REJECT' THEN amount ELSE 0 END")
WATCHED = "risk_tier IN ('HIGH', 'CRITICAL')"

ACTED = f"""
        SELECT {LIVE}, csr_action, csr_reason, csr_acted_at, CAST(NULL AS VARCHAR) AS ai_explanation,
               workflow_state IN ('approved', 'rejected', 'escalated') AS is_actioned
        FROM acted"""

FEW = "SELECT refund_id FROM refund_requests ORDER BY refund_id LIMIT 10"
AUDIT = """
        SELECT refund_id, risk_score, risk_tier, action AS recommended_action, confidence, num_abuse_signals,
               valid AS validation_passed, auto_approvable, fallback, unparsed_excerpt FROM decided"""
DETAIL = """
        SELECT refund_id, customer_id, amount, risk_score, recommended_action, workflow_state,
               household_id AS case_household_id, c360_risk_tier, c360_refund_rate, c360_refunds_90d,
               c360_total_refunds, c360_household_id, c360_household_refund_count_30d, c360_coordinated_timing_flag,
               c360_household_total_refund_amount
        FROM asked"""

# The rules of the source tables, as (table, rule, condition).
RULES = [
    ("refund_requests", "valid_refund_id", "refund_id IS NOT NULL"),
    ("refund_requests", "valid_amount", "amount IS NOT NULL AND amount > 0"),
    ("refund_requests", "countable_amount", "amount IS NULL OR isfinite(amount)"),
    ("order_history", "valid_order_id", "order_id IS NOT NULL"),
    ("customer_profiles", "valid_customer_id", "customer_id IS NOT NULL"),
    ("household_mappings", "valid_household_id", "household_id IS NOT NULL"),
    ("store_locations", "valid_store_id", "store_id IS NOT NULL"),
    ("product_catalog", "valid_product_id", "product_id IS NOT NULL"),
    ("delivery_events", "valid_delivery_id", "delivery_id IS NOT NULL"),
    ("refund_policies", "valid_policy_id", "policy_id IS NOT NULL"),
    ("historical_decisions", "valid_decision_id", "decision_id IS NOT NULL"),
    ("enriched_requests", "valid_refund_id", "refund_id IS NOT NULL"),
    ("enriched_requests", "valid_customer_id", "customer_id IS NOT NULL"),
]
COUNTED = [*dict.fromkeys(rule[0] for rule in RULES), "latest_delivery", "customer_refund_history",
           "household_activity", "customer_360", "segment_summary"]

_checks = [
    ("Return Window", "coalesce(within_return_window, FALSE)",
     "coalesce(CAST(days_since_order AS VARCHAR), '?') || ' days since order'"),
    ("Delivery Verified", "coalesce(delivery_confirmed, FALSE)", "coalesce(nullif(delivery_issues, ''), 'No issues')"),
    ("Item Condition", "coalesce(item_condition <> 'missing', TRUE)", "coalesce(nullif(item_condition, ''), 'Unknown')"),
    ("High-Value Item", "NOT coalesce(is_high_value, FALSE)",
     "CASE WHEN is_high_value THEN 'Requires manual review' ELSE 'Standard item' END"),
]
_warnings = [
    ("c360_refund_rate > 0.25::DOUBLE",
     "'High refund rate: ' || CAST(CAST(c360_refund_rate * 100 AS DECIMAL(18, 1)) AS VARCHAR) || '%'", "'high'"),
    ("c360_refunds_90d > 5", "c360_refunds_90d || ' refunds in 90 days'",
     "CASE WHEN c360_refunds_90d > 10 THEN 'critical' ELSE 'high' END"),
    ("c360_coordinated_timing_flag", "'Household coordination detected'", "'critical'"),
    ("reason_code = 'ITEM_NOT_RECEIVED' AND delivery_confirmed",
     "'Non-delivery claim with photo-confirmed delivery'", "'critical'"),
    ("days_since_order > 25 AND days_since_order <= 30",
     "'Return window gaming: day ' || days_since_order || ' of 30'", "'medium'"),
]

_reasons = ("refund_rate_score", "frequency_score", "amount_score", "household_score", "delivery_score", "policy_score",
            "within_return_window", "delivery_confirmed", "days_since_order")

# A run of the quality rules a month before the as-of date, and one at it.
_counted_runs = [
    f"SELECT strftime({day}, '%Y-%m-%d') AS run, CAST({day} AS TIMESTAMP) AS run_at, '{table}' AS table_name, "
    f"'{rule}' AS expectation, {counted(condition)} AS passed, {counted(f'({condition}) IS NOT TRUE')} AS dropped FROM {table}"
    + (f" WHERE request_date <= {day} OR request_date IS NULL" if table == "refund_requests" else "")
    for day in (f"CAST({AS_OF} - 30 AS DATE)", AS_OF) for table, rule, condition in RULES if table in SOURCES]

QUERIES = {
    "bronze_requests": "SELECT * FROM refund_requests WHERE refund_id IS NOT NULL AND amount > 0",
    "bronze_orders": "SELECT * FROM order_history WHERE order_id IS NOT NULL",
    "bronze_customers": "SELECT * FROM customer_profiles WHERE customer_id IS NOT NULL",
    "bronze_households": "SELECT * FROM household_mappings WHERE household_id IS NOT NULL",
    "bronze_stores": "SELECT * FROM store_locations WHERE store_id IS NOT NULL",
    "bronze_products": "SELECT * FROM product_catalog WHERE product_id IS NOT NULL",
    "bronze_deliveries": "SELECT * FROM delivery_events WHERE delivery_id IS NOT NULL",
    "bronze_policies": "SELECT * FROM refund_policies WHERE policy_id IS NOT NULL",
    "bronze_decisions": "SELECT * FROM historical_decisions WHERE decision_id IS NOT NULL",
    "csv_roundtrip": "SELECT * FROM order_history",
    "expectation_report": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS expectation, {counted(condition)} AS passed, "
        f"{counted(f'({condition}) IS NOT TRUE')} AS dropped FROM {table}" for table, rule, condition in RULES),
    "quality_changes": f"""
        SELECT *, lag(run) OVER w AS previous_run, passed - lag(passed) OVER w AS passed_change,
               dropped - lag(dropped) OVER w AS dropped_change,
               CAST(CAST(dropped_pct - lag(dropped_pct) OVER w AS DECIMAL(18, 3)) AS DOUBLE) AS pct_change
        FROM (SELECT *, CASE WHEN passed + dropped > 0 THEN {share('dropped', '(passed + dropped)', 3, 100)} ELSE 0.0::DOUBLE END
                  AS dropped_pct FROM ({' UNION ALL '.join(_counted_runs)}) AS counted) AS shares
        WINDOW w AS (PARTITION BY table_name, expectation ORDER BY run_at)""",
    "damaged_claims": """
        SELECT refund_id, k % 7 <> 0 AND k % 11 <> 0 AS kept, CASE WHEN k % 7 = 0 OR k % 11 = 0 THEN
               refund_id || ',' || coalesce(order_id, '') || ',' || coalesce(customer_id::VARCHAR, '') END AS began
        FROM numbered_requests""",
    "latest_delivery": "SELECT * FROM latest_delivery",
    "enriched_requests": "SELECT * FROM enriched_requests",
    "customer_refund_history": "SELECT * FROM customer_refund_history",
    "household_day_sequence": """
        SELECT f.household_id, f.request_date, d.day_members, f.prev_date, f.prev_customer, f.hours_between,
               f.coord_flag, d.coordinated
        FROM (SELECT * FROM household_sequence
              QUALIFY row_number() OVER (PARTITION BY household_id, request_date ORDER BY refund_id, customer_id) = 1) f
        JOIN (SELECT household_id, request_date, count(DISTINCT customer_id) AS day_members,
                     CAST(count(*) FILTER (WHERE coord_flag) AS BIGINT) AS coordinated
              FROM household_sequence GROUP BY household_id, request_date) d
          ON d.household_id = f.household_id AND d.request_date = f.request_date""",
    "history_from_days": "SELECT * FROM customer_refund_history",
    "household_totals_from_days": """
        SELECT household_id, household_members_with_refunds, household_total_refunds, household_refund_count_30d,
               household_total_refund_amount, household_reason_codes FROM household_activity""",
    "household_coordination_segmented": "SELECT * FROM household_coordination",
    "household_coordination": "SELECT * FROM household_coordination",
    "household_activity": "SELECT * FROM household_activity",
    "customer_360": "SELECT * FROM customer_360",
    "customer_360_per_customer": "SELECT * FROM customer_360_per_customer",
    "case_decisioning": f"SELECT {CASE} FROM scored_cases",
    "case_decisioning_per_request": f"SELECT {CASE} FROM scored_requests",
    "decision_reasons": """
        SELECT refund_id, household_id, risk_score, refund_rate_score, frequency_score, amount_score, household_score,
               delivery_score, policy_score, within_return_window, delivery_confirmed, days_since_order
        FROM scored_cases""",
    "reasons_text": "SELECT refund_id, household_id, '{' || concat_ws(',', " + ", ".join(
        f"""'"{name}":' || {name}::VARCHAR""" for name in _reasons) + ") || '}' AS recommendation_reasons_json FROM scored_cases",
    "segment_summary": "SELECT * FROM segment_summary",
    "live_cases": f"SELECT {LIVE}, {NO_REVIEW} FROM live",
    "live_cases_write": f"SELECT {LIVE}, {NO_REVIEW} FROM live",
    "action_validation": """
        SELECT *, problem IS NULL AS is_valid
        FROM (SELECT *, CASE WHEN action NOT IN ('approved', 'rejected', 'escalated') THEN 'unknown action'
                             WHEN trim(reason) = '' THEN 'blank reason' END AS problem FROM actions)""",
    "apply_actions": ACTED,
    "cases_reviewed": ACTED,
    "cases_folded": ACTED,
    "action_overrides": """
        SELECT a.refund_id, a.action, a.acted_at, substr(a.reason, 1, 200) AS reason_excerpt,
               l.refund_id IS NOT NULL AS found, lower(coalesce(l.recommended_action, '')) AS ai_recommended,
               l.refund_id IS NOT NULL
                   AND CASE l.recommended_action WHEN 'APPROVE' THEN 'approved' WHEN 'REJECT' THEN 'rejected'
                            ELSE 'escalated' END <> a.action AS is_override,
               coalesce(l.risk_score, 0) AS risk_score, coalesce(l.abuse_risk_tier, '') AS risk_tier,
               coalesce(l.amount, 0) AS amount
        FROM actions a LEFT JOIN live_per_request l ON l.refund_id = a.refund_id
        WHERE a.action IN ('approved', 'rejected', 'escalated')""",
    "feedback_validation": """
        SELECT *, problem IS NULL AS is_valid
        FROM (SELECT *, CASE WHEN feedback_type NOT IN ('false_positive', 'missed_abuse') THEN 'unknown type'
                             WHEN trim(refund_id) = '' THEN 'blank refund_id' END AS problem FROM feedback)""",
    "feedback_append": """
        SELECT h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || '89ab'[('0x' || h[17])::INTEGER % 4 + 1] || h[18:20]
               || '-' || h[21:32] AS feedback_id, refund_id, feedback_type, notes, submitted_at
        FROM (SELECT *, sha1(concat_ws(chr(10), length(refund_id), refund_id, feedback_type,
                             strftime(submitted_at, '%Y-%m-%d %H:%M:%S.%f'), notes)) AS h FROM feedback)
        WHERE feedback_type <> 'other'""",
    "feedback_recent": """
        SELECT * FROM feedback WHERE feedback_type <> 'other'
        ORDER BY submitted_at DESC, refund_id, feedback_id LIMIT 100""",
    "feedback_enriched": """
        SELECT f.refund_id, f.feedback_type, f.submitted_at, substr(f.notes, 1, 200) AS notes_excerpt,
               l.refund_id IS NOT NULL AS found, l.customer_id, coalesce(l.risk_score, 0) AS risk_score,
               coalesce(l.amount, 0) AS amount, coalesce(l.abuse_risk_tier, '') AS abuse_risk_tier,
               coalesce(l.recommended_action, '') AS recommended_action, coalesce(l.reason_code, '') AS reason_code,
               coalesce(l.channel, '') AS channel, coalesce(l.product_category, '') AS product_category
        FROM feedback f LEFT JOIN live_per_request l ON l.refund_id = f.refund_id
        WHERE f.feedback_type <> 'other'""",
    "case_queue": f"""
        SELECT {QUEUE} FROM live ORDER BY risk_score DESC, refund_id, household_id NULLS LAST LIMIT 200 OFFSET 50""",
    "case_queue_skipping": f"""
        SELECT {QUEUE} FROM live ORDER BY risk_score DESC, refund_id, household_id NULLS LAST LIMIT 200 OFFSET 50""",
    "case_queue_filtered": f"""
        SELECT {QUEUE} FROM live
        WHERE workflow_state = 'pending_review' AND abuse_risk_tier = 'HIGH' AND channel = 'online'
        ORDER BY risk_score DESC, refund_id, household_id NULLS LAST LIMIT 50""",
    "case_detail": DETAIL,
    "case_detail_few": f"SELECT * FROM ({DETAIL}) AS detail WHERE refund_id IN ({FEW})",
    "dashboard_kpis": "SELECT * FROM kpis",
    "dashboard_rates": f"""
        SELECT total_cases, pending_count,
               {share('approved_count + auto_approved_count', 'total_cases', 1, 100)} AS approval_rate_pct,
               {share('rejected_count', 'total_cases', 1, 100)} AS rejection_rate_pct,
               {share('escalated_count', 'total_cases', 1, 100)} AS escalation_rate_pct
        FROM kpis""".replace("CAST(approved_count + auto_approved_count AS", "CAST((approved_count + auto_approved_count) AS"),
    "risk_distribution": f"""
        SELECT abuse_risk_tier, count(*) AS case_count, {MEAN_SCORE} AS avg_score, {money('amount')} AS total_amount
        FROM live GROUP BY abuse_risk_tier
        ORDER BY CASE abuse_risk_tier WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END""",
    "risk_distribution_share": f"""
        SELECT abuse_risk_tier, case_count,
               {share('case_count', '(SELECT count(*) FROM live)', 1, 100)} AS share_pct
        FROM (SELECT abuse_risk_tier, count(*) AS case_count FROM live GROUP BY abuse_risk_tier)""",
    "workflow_distribution": """
        SELECT workflow_state, abuse_risk_tier, count(*) AS case_count FROM acted GROUP BY ALL ORDER BY ALL""",
    "leakage_by_category": f"""
        SELECT product_category, count(*) AS total_cases, {LEAKAGE} AS potential_leakage, {MEAN_SCORE} AS avg_risk_score
        FROM scored_cases GROUP BY product_category ORDER BY potential_leakage DESC, product_category NULLS LAST""",
    "refund_leakage": f"""
        SELECT count(*) AS leaked_cases, coalesce({money('amount')}, 0) AS refund_leakage
        FROM scored_cases WHERE recommended_action = 'REJECT'
          AND refund_id IN (SELECT refund_id FROM historical_decisions WHERE action = 'approved')""",
    "abuse_rate": f"""
        SELECT *, {share('abusive_customers', 'customers')} AS abuse_rate
        FROM (SELECT count(DISTINCT customer_id) AS customers,
                     count(DISTINCT CASE WHEN {WATCHED} THEN customer_id END) AS abusive_customers
              FROM customer_360)""",
    "recommendation_rates": f"""
        SELECT n AS total_cases, {share('a', 'n')} AS approval_rate, {share('e', 'n')} AS escalation_rate,
               {share('r', 'n')} AS rejection_rate
        FROM (SELECT count(*) AS n, {counted("recommended_action = 'APPROVE'")} AS a,
                     {counted("recommended_action = 'ESCALATE'")} AS e, {counted("recommended_action = 'REJECT'")} AS r
              FROM scored_cases)""",
    "rejection_by_reason": f"""
        SELECT *, {share('rejected_cases', 'total_cases')} AS rejection_rate
        FROM (SELECT reason_code, count(*) AS total_cases, {counted("recommended_action = 'REJECT'")} AS rejected_cases
              FROM scored_cases GROUP BY reason_code)
        ORDER BY rejection_rate DESC, reason_code""",
    "escalation_by_segment": """
        SELECT channel, reason_code, tier, risk_tier, total_cases, escalation_rate, avg_risk_score FROM segment_summary
        WHERE escalation_rate > 0.1::DOUBLE ORDER BY escalation_rate DESC, channel, reason_code, tier, risk_tier""",
    "top_abuse_customers": f"""
        SELECT customer_id, first_name, last_name, tier, risk_tier, refund_rate, refunds_90d, total_refund_amount_90d,
               coordinated_timing_flag, household_id
        FROM customer_360 WHERE {WATCHED}
        ORDER BY refund_rate DESC, customer_id, household_id NULLS LAST LIMIT 20""",
    "catalog_tables": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{layer}' AS layer, count(*) AS n FROM {table}" for name, layer, table in (
            *[(t, "bronze", t) for t in COUNTED if t in SOURCES],
            *[(t, "silver", t) for t in ("latest_delivery", "enriched_requests", "customer_refund_history", "household_activity")],
            ("customer_360", "gold", "customer_360"), ("segment_summary", "gold", "segment_summary"),
            ("case_decisioning", "gold", "scored_cases"))),
    "table_counts": " UNION ALL ".join(
        [f"SELECT '{table}' AS table_name, count(*) AS row_count FROM {table}" for table in COUNTED]
        + [f"SELECT '{name}', count(*) FROM scored_cases" for name in ("case_decisioning", "live_cases")]),
    "decide_missing": """
        SELECT DISTINCT refund_id, 'Refund not found' AS error FROM ids
        WHERE refund_id NOT IN (SELECT refund_id FROM live)""",
    "decide_validation": "SELECT * FROM validation",
    "decide_policy": "SELECT * FROM policy",
    "decide_risk": "SELECT * FROM risk",
    "decide_prompt": """
        SELECT refund_id, 'You are a refund abuse analyst. Provide a structured recommendation.

REFUND REQUEST:
- Refund ID: ' || refund_id || '
- Amount: $' || amount || '
- Reason: ' || reason_code || '
- Product: ' || coalesce(product_name, 'None') || ' (' || coalesce(product_category, 'None') || ')
- Channel: ' || channel || '
- Days since order: ' || coalesce(CAST(days_since_order AS VARCHAR), 'None') || '
- Item condition: ' || item_condition || '

VALIDATION: Valid=' || CASE WHEN valid THEN 'True' ELSE 'False' END
            || ', Issues=' || coalesce(nullif(replace(issues, ' | ', ', '), ''), 'None') || '
POLICY: Auto-approvable=' || CASE WHEN auto_approvable THEN 'True' ELSE 'False' END
            || ', Flags=' || coalesce(nullif(replace(policy_flags, ' | ', ', '), ''), 'None') || '
RISK: Score=' || risk_score || '/1.0, Tier=' || risk_tier
            || ', Signals=' || coalesce(nullif(replace(signals, ' | ', ', '), ''), 'None') || '

Respond with EXACTLY this JSON:
{"action": "APPROVE" or "REJECT" or "ESCALATE", "confidence": 0.0-1.0, "explanation": "2-3 sentence explanation", '
            || '"key_factors": ["factor1", "factor2"]}' AS prompt
        FROM (SELECT * EXCLUDE (risk_score) FROM asked) JOIN validation USING (refund_id) JOIN policy USING (refund_id)
        JOIN risk USING (refund_id)""",
    "parse_replies": "SELECT * FROM parsed",
    "decide": "SELECT * EXCLUDE (num_abuse_signals, unparsed_excerpt) FROM decided",
    "decision_audit": AUDIT,
    "decision_audit_few": f"{AUDIT} WHERE refund_id IN ({FEW})",
    "policy_checks": " UNION ALL ".join(
        f"SELECT refund_id, '{label}' AS label, {passed} AS passed, {detail} AS detail FROM live_per_request"
        for label, passed, detail in _checks),
    "abuse_signals": " UNION ALL ".join(
        f"SELECT refund_id, {label} AS label, {severity} AS severity FROM asked WHERE {condition}"
        for condition, label, severity in _warnings),
}


def _needed(sql: str) -> set[str]:
    direct = {name for name in PARTS if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql)}
    return direct.union(*[_needed(PARTS[name]) for name in direct])


def with_parts(sql: str) -> str:
    needed = _needed(sql)
    parts = ",\n".join(f"{name} AS ({text})" for name, text in PARTS.items() if name in needed)
    return f"WITH {parts}\n{sql}"


def all_sql() -> dict[str, str]:
    return {name: with_parts(sql) for name, sql in QUERIES.items()}
