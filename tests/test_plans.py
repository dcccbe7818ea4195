"""Physical plans: what must never appear in them, what must be pushed down, and how skewed keys are split."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from claimsift.operators import enrich, history, household, queue, scoring
from claimsift.plans import registry
from claimsift.schemas import SOURCES
from tests.frames import AS_OF, SETTINGS

SF_DIR = "/root/testdata/sf0.001"


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", entry_points.queries())
def test_plan_has_no_slow_operator(spark, name):
    plan = executed(entry_points.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ExistingRDD"):
        assert operator not in plan, (name, operator)
    assert not re.search(r"Window \[.*\], \[\]", plan)


def test_scans_read_only_what_is_used(spark):
    data = registry.data(spark, SF_DIR)
    plan = executed(registry.QUERIES["leakage_by_category"](data))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == {
        "amount", "product_category", "risk_score", "recommended_action"}
    watched = executed(registry.QUERIES["top_abuse_customers"](data))
    assert "PushedFilters: [In(risk_tier" in watched and "TakeOrderedAndProject" in watched


def test_few_requested_ids_leave_the_cases_in_place(spark):
    cases = registry.data(spark, SF_DIR)["live_cases"]
    ids = spark.createDataFrame([("REF-000000001",)], "refund_id string")
    plan = executed(queue.missing_cases(cases, ids))
    assert "BroadcastHashJoin [refund_id" in plan and "LeftSemi" in plan


ROWS, CUSTOMERS, ORDERS = 90_000, 5_000, 8_000


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the claims and deliveries on one order, a third of the claims by one customer, a third of the
    memberships in one household and a third by one customer."""
    out = tmp_path_factory.mktemp("skewed")
    i = F.col("id")

    def stored(table, rows, **columns):
        given = spark.range(rows).select(*[c.alias(n) for n, c in columns.items()])
        fields = SOURCES[table].fields
        df = given.select(*[
            (F.col(f.name) if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        df.write.parquet(str(out / table))
        return spark.read.schema(df.schema).parquet(str(out / table))

    def order(hot):
        return F.when(hot, F.lit("O-hot")).otherwise(F.concat(F.lit("O"), i % ORDERS))

    def text(prefix, number):
        return F.concat(F.lit(prefix), number.cast("string"))

    t = {
        "requests": stored(
            "refund_requests", ROWS, refund_id=F.format_string("R%09d", i), order_id=order(i % 3 == 0),
            customer_id=F.when(i % 3 == 1, F.lit(0)).otherwise(i % CUSTOMERS), amount=i % 300 + 1,
            reason_code=F.when(i % 2 == 0, "DAMAGED").otherwise("DEFECTIVE"), channel=text("channel ", i * 7919),
            request_date=F.date_sub(F.lit(AS_OF), (i % 100).cast("int"))),
        "orders": stored(
            "order_history", ORDERS, order_id=F.when(i == 0, "O-hot").otherwise(text("O", i)), order_date=F.lit(AS_OF),
            total_amount=F.lit(10.0), product_id=text("P", i % 100)),
        "customers": stored(
            "customer_profiles", CUSTOMERS, customer_id=i, lifetime_orders=F.lit(10), lifetime_refunds=i % 9),
        "products": stored("product_catalog", 100, product_id=text("P", i), category=F.lit("Books")),
        "deliveries": stored(
            "delivery_events", ROWS, delivery_id=F.format_string("D%09d", i), order_id=order(i % 3 == 0),
            status=F.when(i % 5 == 0, "attempted").otherwise("delivered"), photo_proof=i % 7 != 0),
        "policies": stored(
            "refund_policies", 1, policy_id=F.lit("1"), category=F.lit("Books"), reason_code=F.lit("DAMAGED")),
        "members": stored(
            "household_mappings", 6_000, mapping_id=i,
            household_id=F.when(i % 3 == 0, "H-hot").otherwise(text("H", i)),
            customer_id=F.when(i % 3 == 1, F.lit(7)).otherwise(i % CUSTOMERS)),
    }

    def kept(name, df):
        df.write.parquet(str(out / name))
        return spark.read.schema(df.schema).parquet(str(out / name))

    t["latest"] = kept("latest", enrich.latest_delivery(t["deliveries"]))
    t["enriched"] = kept("enriched", enriched(t))
    t["history"] = kept("history", history.customer_refund_history(t["requests"], SETTINGS))
    t["activity"] = kept("activity", household.household_activity(t["requests"], t["members"], SETTINGS))
    return t


def enriched(t):
    return enrich.enrich_requests(
        t["requests"], t["orders"], t["customers"], t["products"], t["latest"], t["policies"], SETTINGS)


def cases(t, **hot):
    return scoring.case_decisioning(t["enriched"], t["history"], t["members"], t["activity"], SETTINGS, **hot)


def fingerprint(df):
    """Row count and an order-free checksum, with the plan that gave it."""
    summary = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")))
    return tuple(summary.collect()[0]), executed(summary).split("Initial Plan")[0]


@pytest.fixture
def small_partitions(conf):
    conf(**{
        "spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__shuffle__partitions": "16", "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "128KB",
        "spark__sql__files__maxPartitionBytes": "300KB", "spark__sql__files__openCostInBytes": "0",
    })


def test_hot_orders_and_customers_are_split(spark, skewed, small_partitions):
    split, plan = fingerprint(enriched(skewed))
    assert plan.count("SortMergeJoin(skew=true)") >= 3
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain, _ = fingerprint(enriched(skewed))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert split == plain and split[0] == ROWS


def test_cases_of_hot_customers_are_split(skewed, small_partitions):
    split, plan = fingerprint(cases(skewed, min_rows=1_000, salts=8))
    assert "SortMergeJoin(skew=true)" in plan
    assert split == fingerprint(cases(skewed))[0]


def test_hot_households_give_the_same_activity(skewed, small_partitions):
    spread = household.household_activity(skewed["requests"], skewed["members"], SETTINGS)
    assert fingerprint(spread)[0] == fingerprint(skewed["activity"])[0]
    assert spread.count() == skewed["members"].select("household_id").distinct().count()
