"""Adapter from a TPC-H-like set of parquet tables to the nine source tables.

Every value is a function of the row it comes from, so the same tables can be derived in any SQL engine for comparison.
"""

from __future__ import annotations

import datetime as dt
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

AS_OF = dt.date(2025, 3, 31)

# The code lists of the source tables.
REASONS = (
    "ITEM_NOT_RECEIVED", "WRONG_ITEM", "DAMAGED", "DEFECTIVE", "CHANGED_MIND", "SIZE_ISSUE", "QUALITY_ISSUE",
    "LATE_DELIVERY", "DUPLICATE_ORDER", "UNAUTHORIZED_PURCHASE",
)
CATEGORIES = (
    "Electronics", "Clothing", "Home & Garden", "Sports", "Toys", "Jewelry", "Beauty", "Grocery", "Books",
    "Automotive",
)
CHANNELS = ("online", "in_store", "phone", "chat")
CONDITIONS = ("unopened", "opened", "used", "damaged", "missing")
PAYMENTS = ("credit_card", "debit_card", "paypal", "gift_card", "apple_pay")
CARRIERS = ("UPS", "FedEx", "USPS", "DHL", "Amazon Logistics")
TIERS = ("Standard", "Premium", "VIP", "New")
ISSUES = (
    "none", "none", "none", "none", "late", "damaged_package", "wrong_address", "weather_delay", "none", "none",
)
RELATIONS = ("primary", "spouse", "child", "other")
WINDOWS = (14, 30, 60, 90)
PAST_ACTIONS = ("approved", "approved", "approved", "rejected", "escalated")
REVIEWS = ("approved", "rejected", "escalated")

_LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag")


def pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def key(prefix: str, number: Column | str, width: int) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(f"{prefix}-"), F.lpad(number.cast("string"), width, "0"))


def div(number: Column | str, by: int) -> Column:
    return F.floor((F.col(number) if isinstance(number, str) else number) / by)


class TestData:
    """The source tables as lazy DataFrames over the parquet files below ``sf_dir``.

    With ``kept``, a folder that all executors share, the lines are sorted once and kept there for the sources that need
    them; without it each source sorts them anew.
    """

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str, kept: str | None = None) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._kept, self._written, self._lock = kept, False, Lock()

    def source(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def _raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _lines(self) -> DataFrame:
        """Lines with their number ``rn`` within the order, those that some source needs: the first and the delivered."""
        within = Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)
        numbered = self._raw("lineitem").withColumn("rn", F.row_number().over(within))
        lines = numbered.filter((F.col("rn") == 1) | (F.col("l_linestatus") == "F")).select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "rn")
        if self._kept is None:
            return lines
        with self._lock:
            if not self._written:
                lines.write.mode("overwrite").option("compression", "zstd").parquet(f"{self._kept}/lines")
                self._written = True
        return self.spark.read.schema(lines.schema).parquet(f"{self._kept}/lines")

    def _first_lines(self) -> DataFrame:
        return self._lines().filter(F.col("rn") == 1)

    def _order_parts(self) -> dict[str, Column]:
        day = F.datediff(F.col("o_orderdate").cast("date"), F.lit(dt.date(1995, 1, 1))) % 60
        return {
            "order_id": key("ORD", "o_orderkey", 9),
            "customer_id": F.col("o_custkey") + 100000,
            "order_date": F.date_add(F.lit(dt.date(2024, 12, 15)), day),
            "total_amount": F.floor(F.col("o_totalprice") / 300).cast("double"),
        }

    def order_history(self) -> DataFrame:
        lines = self._first_lines().select("l_orderkey", "l_partkey", "l_suppkey")
        joined = self._raw("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        status = F.col("o_orderstatus")
        parts = self._order_parts() | {
            "product_id": key("PROD", "l_partkey", 7),
            "delivery_status": F.when(status == "F", "delivered").when(status == "O", "in_transit").otherwise("delayed"),
            "payment_method": pick(PAYMENTS, F.col("o_orderkey") % 5),
            "store_id": F.when(F.col("o_orderkey") % 2 == 0, key("STR", "l_suppkey", 6)),
        }
        names = ("order_id", "customer_id", "product_id", "order_date", "total_amount", "delivery_status",
                 "payment_method", "store_id")
        return joined.select(*[parts[name].alias(name) for name in names])

    def refund_requests(self) -> DataFrame:
        returned = self._first_lines().filter(F.col("l_returnflag") == "R")
        orders = self._raw("orders")
        order = orders.select("o_orderkey", *[c.alias(n) for n, c in self._order_parts().items()])
        part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
        share = F.floor(F.col("total_amount") * (part % 51 + 50)) / 100
        wait = ((part * 7 + line * 13) % 44 + 1).cast("int")
        return returned.join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(
            key("REF", "l_orderkey", 9).alias("refund_id"), "order_id", "customer_id",
            pick(REASONS, (part + supp) % 10).alias("reason_code"),
            share.cast("double").alias("amount"),
            pick(CHANNELS, supp % 4).alias("channel"),
            F.date_add("order_date", wait).alias("request_date"),
            pick(CONDITIONS, (part + line) % 5).alias("item_condition"),
        )

    def customer_profiles(self) -> DataFrame:
        per_customer = self._raw("orders").groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.floor(F.col("o_totalprice") / 300)).cast("double").alias("spend"),
        )
        cust, n = F.col("c_custkey"), F.coalesce("n", F.lit(0))
        joined = self._raw("customer").join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
        return joined.select(
            (cust + 100000).alias("customer_id"), F.col("c_mktsegment").alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.concat(F.lit("c"), cust.cast("string"), F.lit("@example.com")).alias("email"),
            pick(TIERS, F.col("c_nationkey") % 4).alias("tier"),
            n.alias("lifetime_orders"),
            F.floor(n * (cust % 45) / F.lit(100.0)).alias("lifetime_refunds"),
            F.coalesce("spend", F.lit(0.0)).alias("lifetime_spend"),
            F.date_add(F.lit(dt.date(2020, 1, 1)), (cust % 1825).cast("int")).alias("account_created_date"),
        )

    def product_catalog(self) -> DataFrame:
        part = F.col("p_partkey")
        return self._raw("part").select(
            key("PROD", part, 7).alias("product_id"), F.col("p_name").alias("name"),
            pick(CATEGORIES, part % 10).alias("category"), F.col("p_retailprice").alias("price"),
            ((part % 130 + 20) / F.lit(1000.0)).alias("refund_rate_baseline"),
            (part % 10).isin(0, 5).alias("is_high_value"),
        )

    def store_locations(self) -> DataFrame:
        joined = self._raw("supplier").join(
            self._raw("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(
            self._raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return joined.select(
            key("STR", "s_suppkey", 6).alias("store_id"), F.col("s_name").alias("name"),
            F.col("r_name").alias("region"), F.col("n_name").alias("city"),
            F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("state"),
        )

    def delivery_events(self) -> DataFrame:
        part, supp = F.col("l_partkey"), F.col("l_suppkey")
        delivery_id = F.concat(
            F.lit("DEL-"), F.lpad(F.col("l_orderkey").cast("string"), 9, "0"), F.lit("-"),
            F.lpad(F.col("rn").cast("string"), 3, "0"))
        return self._lines().filter(F.col("l_linestatus") == "F").select(
            delivery_id.alias("delivery_id"), key("ORD", "l_orderkey", 9).alias("order_id"),
            pick(CARRIERS, supp % 5).alias("carrier"),
            F.when(part % 20 < 17, "delivered").when(part % 20 < 19, "attempted").otherwise("exception").alias("status"),
            pick(ISSUES, supp % 10).alias("delivery_issues"),
            (part % 5 != 0).alias("photo_proof"),
        )

    def refund_policies(self) -> DataFrame:
        """One policy for every other pair of category i and reason j."""
        i, j = F.col("i"), F.col("j")
        grid = self._raw("part").filter(F.col("p_partkey") < 10).select(
            F.col("p_partkey").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("j"),
        ).filter((i + j) % 2 == 0)
        return grid.select(
            key("POL", i * 5 + div("j", 2), 3).alias("policy_id"),
            pick(CATEGORIES, i).alias("category"), pick(REASONS, j).alias("reason_code"),
            pick(WINDOWS, div(i + j, 2) % 4).alias("max_refund_window_days"),
            ((i * 10 + j) * F.lit(1.75) + F.lit(25.0)).alias("auto_approve_threshold"),
            ((i + j) % 5 < 3).alias("requires_return"),
        )

    def household_mappings(self) -> DataFrame:
        cust = F.col("c_custkey")
        listings = F.when(cust % 50 == 0, F.array(F.lit(0), F.lit(1))).when(cust % 10 < 6, F.array(F.lit(0)))
        rows = self._raw("customer").select("c_custkey", F.explode(listings).alias("r"))
        return rows.select(
            (cust * 2 + F.col("r")).alias("mapping_id"),
            key("HH", div("c_custkey", 3) + F.col("r"), 7).alias("household_id"),
            (cust + 100000).alias("customer_id"), pick(RELATIONS, cust % 4).alias("relationship"),
            (cust % 7 != 0).alias("shared_address_flag"),
        )

    def historical_decisions(self) -> DataFrame:
        k = claim_number()
        return self.refund_requests().filter(k % 10 < 9).select(
            key("DEC", k, 9).alias("decision_id"), "refund_id", pick(PAST_ACTIONS, k % 5).alias("action"),
            F.lit("mapped").alias("reason"), (k % 8 == 0).alias("override_flag"),
            F.date_add("request_date", 1).alias("decided_at"),
        )


def claim_number() -> Column:
    return F.substring("refund_id", 5, 20).cast("long")


def actions(requests: DataFrame) -> DataFrame:
    """Reviewer actions derived from claims: a first one for most, a later escalation for every fifth."""
    k = claim_number()
    first = F.when(k % 4 != 3, F.struct(
        F.when(k % 7 == 0, F.lit("bogus")).otherwise(pick(REVIEWS, k % 4 % 3)).alias("action"),
        F.concat(F.lit("r"), k.cast("string")).alias("reason"), F.lit(9).alias("hour")))
    second = F.when(k % 5 == 0, F.struct(
        F.lit("escalated").alias("action"), F.concat(F.lit("s"), k.cast("string")).alias("reason"),
        F.lit(10).alias("hour")))
    made = requests.select("refund_id", "request_date", F.explode(F.array_compact(F.array(first, second))).alias("a"))
    at = F.col("request_date").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("a.hour"))
    return made.select("refund_id", "a.action", "a.reason", at.alias("acted_at"))


def feedback(requests: DataFrame) -> DataFrame:
    """Feedback on every claim; some of an unknown type."""
    k = claim_number()
    kind = F.when(k % 9 == 0, "other").when(k % 2 == 0, "false_positive").otherwise("missed_abuse")
    return requests.select(
        F.concat(F.lit("FB-"), k.cast("string")).alias("feedback_id"), "refund_id", kind.alias("feedback_type"),
        F.concat(F.lit("n"), k.cast("string")).alias("notes"),
        F.date_add("request_date", 2).cast("timestamp").alias("submitted_at"),
    )


def replies(requests: DataFrame) -> DataFrame:
    """Model replies: an object within text for every third claim, text without one for the next, none for the last."""
    k = claim_number()
    answer = F.concat(
        F.lit('Here it is: {"action": "ESCALATE", "confidence": 0.'), (k % 9 + 1).cast("string"),
        F.lit(', "explanation": "case '), k.cast("string"), F.lit('", "key_factors": ["amount", "f'),
        (k % 4).cast("string"), F.lit('"]} done'))
    raw = F.when(k % 3 == 0, answer).otherwise(F.lit("no json here"))
    return requests.filter(k % 3 != 2).select("refund_id", raw.alias("raw"))


def requested_ids(requests: DataFrame) -> DataFrame:
    """Every claim, and two ids nobody filed."""
    numbers = requests.sparkSession.range(1, 3)
    unknown = numbers.select(F.concat(F.lit("REF-UNKNOWN-"), F.col("id").cast("string")).alias("refund_id"))
    return requests.select("refund_id").unionByName(unknown)
