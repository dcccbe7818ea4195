"""The tables of a run as SQL over the source tables."""

AS_OF = "DATE '2025-03-31'"


def exact(value: str, digits: int = 3) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(18, 9)), {digits}) AS DOUBLE)"


def money(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(18, 2))) AS DOUBLE)"


def score_sum() -> str:
    return "CAST(sum(CAST(risk_score AS DECIMAL(9, 3))) AS DOUBLE)"


def counted(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def share(part: str, whole: str, digits: int = 3, scale: int = 1) -> str:
    value = f"CAST({part} AS DOUBLE) / {whole}"
    return exact(value if scale == 1 else f"{value} * {scale}", digits)


def score_tier(score: str = "risk_score") -> str:
    return (f"CASE WHEN {score} >= 0.7::DOUBLE THEN 'CRITICAL' WHEN {score} >= 0.4::DOUBLE THEN 'HIGH' "
            f"WHEN {score} >= 0.2::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END")


IN_30, IN_90 = f"request_date >= {AS_OF} - 30", f"request_date >= {AS_OF} - 90"

_RATES = """
    refund_rate AS refund_rate,
    CASE WHEN refund_rate > 0.4::DOUBLE OR refunds_90d > 10 OR coordinated_timing_flag THEN 'CRITICAL'
         WHEN refund_rate > 0.25::DOUBLE OR refunds_90d > 5 THEN 'HIGH'
         WHEN refund_rate > 0.15::DOUBLE OR refunds_90d > 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier"""


def _profiles(signals: str) -> str:
    return f"""
        SELECT customer_id, first_name, last_name, email, tier, lifetime_orders, lifetime_refunds, lifetime_spend,
               account_created_date, total_refunds, total_refund_amount, avg_refund_amount, refunds_30d, refunds_90d,
               total_refund_amount_90d, refund_frequency, last_refund_date, {_RATES},
               household_id, shared_address_flag, household_refund_count_30d, coordinated_timing_flag,
               household_total_refund_amount
        FROM (
            SELECT c.*, h.* EXCLUDE (customer_id), s.* EXCLUDE (customer_id),
                   CASE WHEN lifetime_orders > 0
                        THEN {share('coalesce(total_refunds, 0)', 'lifetime_orders')} ELSE 0 END AS refund_rate
            FROM customer_profiles c
            LEFT JOIN customer_refund_history h ON h.customer_id = c.customer_id
            LEFT JOIN {signals} s ON s.customer_id = c.customer_id)"""


def _cases(signals: str) -> str:
    scored = exact(
        "refund_rate_score * 0.25::DOUBLE + frequency_score * 0.20::DOUBLE + amount_score * 0.15::DOUBLE "
        "+ household_score * 0.15::DOUBLE + delivery_score * 0.15::DOUBLE + policy_score * 0.10::DOUBLE")
    return f"""
        SELECT *, CASE WHEN risk_score >= 0.7::DOUBLE THEN 'REJECT' WHEN risk_score >= 0.4::DOUBLE THEN 'ESCALATE'
                       ELSE 'APPROVE' END AS recommended_action
        FROM (SELECT *, {scored} AS risk_score FROM (
            SELECT e.*, h.refunds_90d AS cust_refunds_90d, h.total_refund_amount_90d AS cust_refund_amt_90d,
                   h.refund_frequency, s.household_id, s.coordinated_timing_flag,
                   least(1::DOUBLE, CASE WHEN lifetime_orders > 0
                         THEN CAST(coalesce(lifetime_refunds, 0) AS DOUBLE) / lifetime_orders * 2.5::DOUBLE
                         ELSE 0 END) AS refund_rate_score,
                   least(1::DOUBLE, coalesce(h.refunds_90d, 0) / 15::DOUBLE) AS frequency_score,
                   CASE WHEN amount > 500 THEN 0.8::DOUBLE WHEN amount > 200 THEN 0.5::DOUBLE
                        WHEN amount > 100 THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END AS amount_score,
                   CASE WHEN s.coordinated_timing_flag THEN 0.9::DOUBLE
                        WHEN coalesce(s.household_refund_count_30d, 0) > 3 THEN 0.6::DOUBLE
                        ELSE 0.1::DOUBLE END AS household_score,
                   CASE WHEN reason_code = 'ITEM_NOT_RECEIVED' AND delivery_confirmed THEN 1::DOUBLE
                        WHEN reason_code = 'ITEM_NOT_RECEIVED' THEN 0.5::DOUBLE ELSE 0.1::DOUBLE END AS delivery_score,
                   CASE WHEN NOT within_return_window THEN 0.8::DOUBLE WHEN days_since_order > 25 THEN 0.5::DOUBLE
                        ELSE 0.1::DOUBLE END AS policy_score
            FROM enriched_requests e
            LEFT JOIN customer_refund_history h ON h.customer_id = e.customer_id
            LEFT JOIN {signals} s ON s.customer_id = e.customer_id))"""


TABLES = {
    "latest_delivery": """
        SELECT order_id, status AS delivery_status_actual, delivery_issues, photo_proof FROM delivery_events
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY delivery_id DESC) = 1""",
    "enriched_requests": f"""
        SELECT r.*, o.total_amount AS order_amount, o.order_date, o.delivery_status AS order_delivery_status,
               o.payment_method, o.store_id, d.delivery_status_actual, d.delivery_issues, d.photo_proof,
               c.first_name, c.last_name, c.tier, c.lifetime_orders, c.lifetime_refunds, c.lifetime_spend,
               p.name AS product_name, p.category AS product_category, p.price AS product_price,
               p.refund_rate_baseline, p.is_high_value,
               l.max_refund_window_days, l.auto_approve_threshold, l.requires_return,
               CAST(datediff('day', o.order_date, r.request_date) AS INTEGER) AS days_since_order,
               datediff('day', o.order_date, r.request_date) <= coalesce(l.max_refund_window_days, 30)
                   AS within_return_window,
               CASE WHEN o.total_amount > 0 THEN {exact('r.amount / o.total_amount')} ELSE 1 END
                   AS refund_to_order_ratio,
               d.delivery_status_actual = 'delivered' AND d.photo_proof AS delivery_confirmed
        FROM refund_requests r
        LEFT JOIN order_history o ON o.order_id = r.order_id
        LEFT JOIN customer_profiles c ON c.customer_id = r.customer_id
        LEFT JOIN product_catalog p ON p.product_id = o.product_id
        LEFT JOIN latest_delivery d ON d.order_id = r.order_id
        LEFT JOIN refund_policies l ON l.category = p.category AND l.reason_code = r.reason_code
        WHERE r.refund_id IS NOT NULL AND r.customer_id IS NOT NULL""",
    "customer_refund_history": f"""
        SELECT *, CASE WHEN refunds_90d > 10 THEN 'very_high' WHEN refunds_90d > 5 THEN 'high'
                       WHEN refunds_90d > 2 THEN 'medium' ELSE 'low' END AS refund_frequency
        FROM (SELECT customer_id, count(refund_id) AS total_refunds, {money('amount')} AS total_refund_amount,
                     {counted(IN_30)} AS refunds_30d, {counted(IN_90)} AS refunds_90d,
                     {money(f'CASE WHEN {IN_90} THEN amount ELSE 0 END')} AS total_refund_amount_90d,
                     {money('amount')} / count(amount) AS avg_refund_amount,
                     max(request_date) AS last_refund_date
              FROM refund_requests GROUP BY customer_id)""",
    "household_requests": """
        SELECT r.*, m.household_id FROM refund_requests r JOIN household_mappings m ON m.customer_id = r.customer_id""",
    "household_sequence": """
        SELECT *, coalesce(hours_between <= 48 AND customer_id <> prev_customer, FALSE) AS coord_flag
        FROM (SELECT *, datediff('day', prev_date, request_date) * 24 AS hours_between
              FROM (SELECT household_id, request_date, customer_id, refund_id,
                           lag(request_date) OVER w AS prev_date, lag(customer_id) OVER w AS prev_customer
                    FROM household_requests
                    WINDOW w AS (PARTITION BY household_id ORDER BY request_date, refund_id, customer_id)))""",
    "household_coordination": """
        SELECT *, coordinated_refund_count > 0 AS coordinated_timing_flag
        FROM (SELECT household_id, CAST(count(*) FILTER (WHERE coord_flag) AS BIGINT) AS coordinated_refund_count
              FROM household_sequence GROUP BY household_id)""",
    "household_activity": f"""
        SELECT a.*, c.coordinated_refund_count, c.coordinated_timing_flag
        FROM (SELECT household_id, count(DISTINCT customer_id) AS household_members_with_refunds,
                     count(refund_id) AS household_total_refunds, {counted(IN_30)} AS household_refund_count_30d,
                     {money('amount')} AS household_total_refund_amount,
                     string_agg(DISTINCT reason_code, ', ' ORDER BY reason_code) AS household_reason_codes
              FROM household_requests GROUP BY household_id) a
        JOIN household_coordination c ON c.household_id = a.household_id""",
    "member_signals": """
        SELECT m.mapping_id, m.customer_id, m.household_id, m.shared_address_flag, a.household_refund_count_30d,
               a.coordinated_timing_flag, a.household_total_refund_amount
        FROM household_mappings m LEFT JOIN household_activity a ON a.household_id = m.household_id""",
    "strongest_membership": """
        SELECT * FROM member_signals
        QUALIFY row_number() OVER (
            PARTITION BY customer_id
            ORDER BY coordinated_timing_flag DESC NULLS LAST, household_refund_count_30d DESC NULLS LAST, household_id,
                     mapping_id) = 1""",
    "customer_360": _profiles("member_signals"),
    "customer_360_per_customer": _profiles("strongest_membership"),
    "scored_cases": _cases("member_signals"),
    "scored_requests": _cases("strongest_membership"),
    "segment_summary": f"""
        SELECT *, {share('approved_count', 'total_cases')} AS approval_rate,
               {share('escalated_count', 'total_cases')} AS escalation_rate
        FROM (SELECT reason_code, channel, tier, {score_tier()} AS risk_tier, count(refund_id) AS total_cases,
                     {counted("recommended_action = 'APPROVE'")} AS approved_count,
                     {counted("recommended_action = 'ESCALATE'")} AS escalated_count,
                     {counted("recommended_action = 'REJECT'")} AS rejected_count,
                     {score_sum()} / count(risk_score) AS avg_risk_score,
                     {money('amount')} AS total_refund_amount,
                     {money('amount')} / count(amount) AS avg_refund_amount
              FROM scored_cases GROUP BY ALL)""",
    "live": f"""
        SELECT *, CASE WHEN recommended_action = 'APPROVE' AND risk_score < 0.2::DOUBLE THEN 'auto_approved'
                       ELSE 'pending_review' END AS workflow_state,
               {score_tier()} AS abuse_risk_tier
        FROM scored_cases""",
    "live_per_request": """
        SELECT * FROM live
        QUALIFY row_number() OVER (
            PARTITION BY refund_id
            ORDER BY coordinated_timing_flag DESC NULLS LAST, risk_score DESC, household_id NULLS LAST) = 1""",
    "latest_action": """
        SELECT * FROM actions WHERE action IN ('approved', 'rejected', 'escalated') AND trim(reason) <> ''
        QUALIFY row_number() OVER (PARTITION BY refund_id ORDER BY acted_at DESC, action DESC, reason DESC) = 1""",
    "acted": """
        SELECT l.* EXCLUDE (workflow_state), coalesce(a.action, l.workflow_state) AS workflow_state,
               a.action AS csr_action, a.reason AS csr_reason, a.acted_at AS csr_acted_at
        FROM live l LEFT JOIN latest_action a ON a.refund_id = l.refund_id""",
    "asked": """
        SELECT l.*, c.risk_tier AS c360_risk_tier, c.refund_rate AS c360_refund_rate, c.refunds_90d AS c360_refunds_90d,
               c.total_refunds AS c360_total_refunds, c.household_id AS c360_household_id,
               c.household_refund_count_30d AS c360_household_refund_count_30d,
               c.coordinated_timing_flag AS c360_coordinated_timing_flag,
               c.household_total_refund_amount AS c360_household_total_refund_amount
        FROM live_per_request l LEFT JOIN customer_360_per_customer c ON c.customer_id = l.customer_id
        WHERE l.refund_id IN (SELECT refund_id FROM ids)""",
    "validation": """
        SELECT refund_id, issues = '' AS valid, issues
        FROM (SELECT refund_id, concat_ws(' | ',
                  CASE WHEN order_id IS NULL THEN 'No matching order found' END,
                  CASE WHEN NOT within_return_window
                       THEN 'Outside return window (' || coalesce(CAST(days_since_order AS VARCHAR), 'None')
                            || ' days)' END,
                  CASE WHEN item_condition = 'missing' THEN 'Item reported as missing' END) AS issues FROM asked)""",
    "policy": """
        SELECT refund_id, auto_approvable, concat_ws(' | ',
                   CASE WHEN auto_approvable THEN 'Below auto-approve threshold ($25)' END,
                   CASE WHEN is_high_value THEN 'High-value item requires manual review' END,
                   CASE WHEN NOT coalesce(within_return_window, FALSE) THEN 'Outside return window' END,
                   CASE WHEN reason_code = 'UNAUTHORIZED_PURCHASE'
                        THEN 'Unauthorized purchase - fraud team review' END) AS policy_flags
        FROM (SELECT *, amount <= 25 AND coalesce(within_return_window, FALSE) AND NOT coalesce(is_high_value, FALSE)
                     AS auto_approvable FROM asked)""",
    "signals": """
        SELECT refund_id, risk_score, coalesce(c360_risk_tier, 'UNKNOWN') AS risk_tier, recommended_action,
               CASE WHEN c360_risk_tier IN ('HIGH', 'CRITICAL')
                    THEN 'Customer risk tier: ' || c360_risk_tier END AS s1,
               CASE WHEN c360_refund_rate > 0.25::DOUBLE
                    THEN 'High refund rate: ' || CAST(CAST(c360_refund_rate * 100 AS DECIMAL(18, 1)) AS VARCHAR) || '%'
                    END AS s2,
               CASE WHEN c360_refunds_90d > 5
                    THEN 'Frequent refunder: ' || c360_refunds_90d || ' in 90 days' END AS s3,
               CASE WHEN c360_coordinated_timing_flag THEN 'Household coordination detected' END AS s4,
               CASE WHEN reason_code = 'ITEM_NOT_RECEIVED' AND delivery_confirmed
                    THEN 'Claims non-delivery but delivery confirmed with photo' END AS s5
        FROM asked""",
    "risk": """
        SELECT refund_id, risk_score, risk_tier, concat_ws(' | ', s1, s2, s3, s4, s5) AS signals FROM signals""",
    "parsed": """
        SELECT refund_id, j IS NOT NULL AS parsed, j ->> '$.action' AS action,
               CAST(j ->> '$.confidence' AS DOUBLE) AS confidence, j ->> '$.explanation' AS explanation,
               CASE WHEN j IS NOT NULL THEN (j ->> '$.key_factors[0]') || ' | ' || (j ->> '$.key_factors[1]') END
                   AS key_factors,
               CASE WHEN j IS NULL THEN substr(raw, 1, 500) END AS unparsed_excerpt
        FROM (SELECT refund_id, raw, CASE WHEN contains(raw, '{') THEN
                  CAST(substr(raw, strpos(raw, '{'), length(raw) - strpos(reverse(raw), '}') - strpos(raw, '{') + 2)
                       AS JSON) END AS j
              FROM replies)""",
    "decided": """
        SELECT v.*, p.auto_approvable, p.policy_flags, k.risk_score, k.risk_tier, k.signals,
               coalesce(a.action, s.recommended_action) AS action, coalesce(a.confidence, k.risk_score) AS confidence,
               coalesce(a.explanation, u.unparsed_excerpt, 'Rule-based recommendation (LLM unavailable): [' || concat_ws(', ',
                   '''' || s1 || '''', '''' || s2 || '''', '''' || s3 || '''', '''' || s4 || '''',
                   '''' || s5 || '''') || ']') AS explanation,
               coalesce(a.key_factors, k.signals) AS key_factors, a.refund_id IS NULL AS fallback, u.unparsed_excerpt,
               CAST((s1 IS NOT NULL)::INT + (s2 IS NOT NULL)::INT + (s3 IS NOT NULL)::INT + (s4 IS NOT NULL)::INT
                    + (s5 IS NOT NULL)::INT AS BIGINT) AS num_abuse_signals
        FROM validation v JOIN policy p USING (refund_id) JOIN risk k USING (refund_id) JOIN signals s USING (refund_id)
        LEFT JOIN (SELECT * FROM parsed WHERE parsed) a USING (refund_id)
        LEFT JOIN (SELECT * FROM parsed WHERE NOT parsed) u USING (refund_id)""",
    "kpis": f"""
        SELECT count(*) AS total_cases, {counted("workflow_state = 'pending_review'")} AS pending_count,
               {counted("workflow_state = 'auto_approved'")} AS auto_approved_count,
               {counted("csr_action = 'approved'")} AS approved_count,
               {counted("csr_action = 'rejected'")} AS rejected_count,
               {counted("csr_action = 'escalated'")} AS escalated_count,
               {exact(f'{score_sum()} / count(risk_score)')} AS avg_risk_score,
               {money("CASE WHEN recommended_action = 'REJECT' THEN amount ELSE 0 END")} AS potential_leakage,
               {money('amount')} AS total_refund_amount
        FROM acted""",
}
