"""The nine source tables, and what reviewers would provide, as SQL over the parquet tables."""

# The code lists of the source tables.
REASONS = """['ITEM_NOT_RECEIVED', 'WRONG_ITEM', 'DAMAGED', 'DEFECTIVE', 'CHANGED_MIND', 'SIZE_ISSUE', 'QUALITY_ISSUE',
    'LATE_DELIVERY', 'DUPLICATE_ORDER', 'UNAUTHORIZED_PURCHASE']"""
CATEGORIES = """['Electronics', 'Clothing', 'Home & Garden', 'Sports', 'Toys', 'Jewelry', 'Beauty', 'Grocery', 'Books',
    'Automotive']"""
CHANNELS = "['online', 'in_store', 'phone', 'chat']"
CONDITIONS = "['unopened', 'opened', 'used', 'damaged', 'missing']"
PAYMENTS = "['credit_card', 'debit_card', 'paypal', 'gift_card', 'apple_pay']"
CARRIERS = "['UPS', 'FedEx', 'USPS', 'DHL', 'Amazon Logistics']"
TIERS = "['Standard', 'Premium', 'VIP', 'New']"
ISSUES = """['none', 'none', 'none', 'none', 'late', 'damaged_package', 'wrong_address', 'weather_delay', 'none',
    'none']"""
RELATIONS = "['primary', 'spouse', 'child', 'other']"
WINDOWS = "[14, 30, 60, 90]"
PAST_ACTIONS = "['approved', 'approved', 'approved', 'rejected', 'escalated']"
REVIEWS = "['approved', 'rejected', 'escalated']"


def pick(values: str, index: str) -> str:
    return f"list_extract({values}, ({index}) + 1)"


def key(prefix: str, number: str, width: int) -> str:
    return f"'{prefix}-' || lpad(CAST({number} AS VARCHAR), {width}, '0')"


SOURCES = {
    "ln": """
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_returnflag) AS rn
        FROM lineitem""",
    "first_line": "SELECT * FROM ln WHERE rn = 1",
    "order_history": f"""
        SELECT {key('ORD', 'o_orderkey', 9)} AS order_id,
               100000 + o_custkey AS customer_id,
               {key('PROD', 'l_partkey', 7)} AS product_id,
               DATE '2024-12-15'
                   + CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 60 AS INTEGER) AS order_date,
               CAST(floor(o_totalprice / 300) AS DOUBLE) AS total_amount,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'in_transit' ELSE 'delayed' END
                   AS delivery_status,
               {pick(PAYMENTS, 'o_orderkey % 5')} AS payment_method,
               CASE WHEN o_orderkey % 2 = 0 THEN {key('STR', 'l_suppkey', 6)} END AS store_id
        FROM orders LEFT JOIN first_line ON o_orderkey = l_orderkey""",
    "refund_requests": f"""
        SELECT {key('REF', 'l_orderkey', 9)} AS refund_id, o.order_id, o.customer_id,
               {pick(REASONS, '(l_partkey + l_suppkey) % 10')} AS reason_code,
               CAST(floor(o.total_amount * (50 + l_partkey % 51)) AS DOUBLE) / 100 AS amount,
               {pick(CHANNELS, 'l_suppkey % 4')} AS channel,
               o.order_date + CAST(1 + (l_partkey * 7 + l_linenumber * 13) % 44 AS INTEGER) AS request_date,
               {pick(CONDITIONS, '(l_partkey + l_linenumber) % 5')} AS item_condition
        FROM first_line JOIN order_history o ON o.order_id = {key('ORD', 'l_orderkey', 9)}
        WHERE l_returnflag = 'R'""",
    "customer_profiles": f"""
        SELECT 100000 + c_custkey AS customer_id, c_mktsegment AS first_name, c_name AS last_name,
               'c' || c_custkey || '@example.com' AS email,
               {pick(TIERS, 'c_nationkey % 4')} AS tier,
               CAST(coalesce(n, 0) AS BIGINT) AS lifetime_orders,
               CAST(floor(coalesce(n, 0) * (c_custkey % 45) / CAST(100 AS DOUBLE)) AS BIGINT) AS lifetime_refunds,
               coalesce(spend, CAST(0 AS DOUBLE)) AS lifetime_spend,
               DATE '2020-01-01' + CAST(c_custkey % 1825 AS INTEGER) AS account_created_date
        FROM customer LEFT JOIN (
            SELECT o_custkey, count(*) AS n, sum(CAST(floor(o_totalprice / 300) AS DOUBLE)) AS spend
            FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""",
    "product_catalog": f"""
        SELECT {key('PROD', 'p_partkey', 7)} AS product_id, p_name AS name,
               {pick(CATEGORIES, 'p_partkey % 10')} AS category, p_retailprice AS price,
               (20 + p_partkey % 130) / CAST(1000 AS DOUBLE) AS refund_rate_baseline,
               p_partkey % 10 IN (0, 5) AS is_high_value
        FROM part""",
    "store_locations": f"""
        SELECT {key('STR', 's_suppkey', 6)} AS store_id, s_name AS name, r_name AS region, n_name AS city,
               'S' || n_nationkey AS state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "delivery_events": f"""
        SELECT 'DEL-' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || '-' || lpad(CAST(rn AS VARCHAR), 3, '0')
                   AS delivery_id,
               {key('ORD', 'l_orderkey', 9)} AS order_id,
               {pick(CARRIERS, 'l_suppkey % 5')} AS carrier,
               CASE WHEN l_partkey % 20 < 17 THEN 'delivered' WHEN l_partkey % 20 < 19 THEN 'attempted'
                    ELSE 'exception' END AS status,
               {pick(ISSUES, 'l_suppkey % 10')} AS delivery_issues,
               l_partkey % 5 <> 0 AS photo_proof
        FROM ln WHERE l_linestatus = 'F'""",
    "refund_policies": f"""
        SELECT {key('POL', 'i * 5 + j // 2', 3)} AS policy_id, {pick(CATEGORIES, 'i')} AS category,
               {pick(REASONS, 'j')} AS reason_code, {pick(WINDOWS, '((i + j) // 2) % 4')} AS max_refund_window_days,
               25 + (i * 10 + j) * CAST(1.75 AS DOUBLE) AS auto_approve_threshold,
               (i + j) % 5 < 3 AS requires_return
        FROM (SELECT a.p_partkey AS i, b.p_partkey AS j FROM part a, part b
              WHERE a.p_partkey < 10 AND b.p_partkey < 10 AND (a.p_partkey + b.p_partkey) % 2 = 0)""",
    "household_mappings": f"""
        SELECT c_custkey * 2 + r AS mapping_id, {key('HH', 'c_custkey // 3 + r', 7)} AS household_id,
               100000 + c_custkey AS customer_id, {pick(RELATIONS, 'c_custkey % 4')} AS relationship,
               c_custkey % 7 <> 0 AS shared_address_flag
        FROM (SELECT c_custkey, 0 AS r FROM customer WHERE c_custkey % 10 < 6
              UNION ALL SELECT c_custkey, 1 FROM customer WHERE c_custkey % 50 = 0)""",
    "numbered_requests": "SELECT *, CAST(substr(refund_id, 5) AS BIGINT) AS k FROM refund_requests",
    "historical_decisions": f"""
        SELECT {key('DEC', 'k', 9)} AS decision_id, refund_id, {pick(PAST_ACTIONS, 'k % 5')} AS action,
               'mapped' AS reason, k % 8 = 0 AS override_flag, request_date + 1 AS decided_at
        FROM numbered_requests WHERE k % 10 < 9""",
    "actions": f"""
        SELECT refund_id, CASE WHEN k % 7 = 0 THEN 'bogus' ELSE {pick(REVIEWS, 'k % 4')} END AS action,
               'r' || k AS reason, CAST(request_date AS TIMESTAMP) + INTERVAL 9 HOUR AS acted_at
        FROM numbered_requests WHERE k % 4 <> 3
        UNION ALL
        SELECT refund_id, 'escalated', 's' || k, CAST(request_date AS TIMESTAMP) + INTERVAL 10 HOUR
        FROM numbered_requests WHERE k % 5 = 0""",
    "feedback": """
        SELECT 'FB-' || k AS feedback_id, refund_id,
               CASE WHEN k % 9 = 0 THEN 'other' WHEN k % 2 = 0 THEN 'false_positive' ELSE 'missed_abuse' END
                   AS feedback_type,
               'n' || k AS notes, CAST(request_date + 2 AS TIMESTAMP) AS submitted_at
        FROM numbered_requests""",
    "replies": """
        SELECT refund_id, CASE WHEN k % 3 = 0
            THEN 'Here it is: {"action": "ESCALATE", "confidence": 0.' || (k % 9 + 1) || ', "explanation": "case ' || k
                 || '", "key_factors": ["amount", "f' || (k % 4) || '"]} done'
            ELSE 'no json here' END AS raw
        FROM numbered_requests WHERE k % 3 <> 2""",
    "ids": """
        SELECT refund_id FROM refund_requests
        UNION ALL SELECT 'REF-UNKNOWN-1' UNION ALL SELECT 'REF-UNKNOWN-2'""",
}
