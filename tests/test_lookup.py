"""How much of the files lookups and queue pages read, and partial sums of claims by day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimsift.operators import history, household, queue, serving
from claimsift.settings import Settings
from claimsift.sources.snapshots import bloom_filter
from tests.frames import AS_OF, SETTINGS, day, live, source

ROWS = 40_000


def rows_read(df):
    """Rows that the scan hands on, after row groups are passed over."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan()
    while "AdaptiveSparkPlan" in leaves.getClass().getSimpleName():
        leaves = leaves.executedPlan()
    leaves = leaves.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Cases in many small row groups; ids are scattered over all files."""
    i = F.col("id")
    score = (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0)
    rows = live(spark).sparkSession.range(ROWS).select(
        F.sha1(i.cast("string")).alias("refund_id"), i.alias("customer_id"), F.when(i >= 0, "pending_review").otherwise("approved").alias("workflow_state"),
        F.when(score >= 0.7, "CRITICAL").when(score >= 0.4, "HIGH").when(score >= 0.2, "MEDIUM").otherwise("LOW").alias("abuse_risk_tier"),
        F.when(i % 3 == 0, "online").otherwise("store").alias("channel"), score.alias("risk_score"),
        F.sha2(i.cast("string"), 512).alias("first_name"), (i % 7).cast("string").alias("household_id"))
    filled = rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in serving.LIVE_CASES.fields])
    made = serving.live_table(spark, str(tmp_path_factory.mktemp("live")))
    made.options |= {"parquet.block.size": "65536"}
    made.replace(filled)
    return made


def ids(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "n long").select(F.sha1(F.col("n").cast("string")).alias("refund_id"))


def test_few_ids_read_few_row_groups(spark, table):
    cases = table.read()
    one = queue.few_ids(ids(spark, 17))
    read = {n: rows_read(cases.filter(F.col("refund_id").isin(queue.few_ids(ids(spark, *range(n))))))
            for n in (1, 10)}
    assert len(one) == 1 and rows_read(cases) == ROWS
    assert read[1] <= ROWS // 10 and read[1] < read[10] <= ROWS // 2
    got = queue.requested_cases(cases, ids(spark, 3, 17, ROWS + 5))
    assert sorted(r.customer_id for r in got.collect()) == [3, 17]
    assert "In(refund_id" in got._jdf.queryExecution().executedPlan().toString()


def test_many_ids_are_joined(spark, table):
    many = ids(spark, *range(queue.FEW_IDS + 1))
    assert queue.few_ids(many) is None and queue.few_ids(ids(spark)) == []
    got = queue.requested_cases(table.read(), many)
    assert got.count() == queue.FEW_IDS + 1 and "LeftSemi" in got._jdf.queryExecution().executedPlan().toString()


def test_details_of_few_and_many_agree(spark, table, tmp_path):
    profiles = spark.range(ROWS // 2).select(
        F.col("id").alias("customer_id"), F.lit("HIGH").alias("risk_tier"), F.lit(True).alias("coordinated_timing_flag"),
        F.lit(1).alias("household_refund_count_30d"), F.lit("H").alias("household_id"), F.lit(True).alias("shared_address_flag"))
    path = str(tmp_path / "profiles")
    profiles.write.options(**bloom_filter("customer_id")).option("parquet.block.size", "16384").parquet(path)
    profiles, asked = spark.read.parquet(path), ids(spark, 5, 9, ROWS - 1, ROWS + 1)
    few = queue.case_detail(table.read(), profiles, asked)
    many = queue.with_profile(queue.cases_of(table.read(), asked, None), table.read(), profiles)
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect())) and few.count() == 3
    assert [r.customer_360 is None for r in few.orderBy("customer_id").collect()] == [False, False, True]


@pytest.mark.parametrize("options", [
    dict(), dict(limit=200, offset=300), dict(channel="online", limit=20), dict(risk_tier="MEDIUM"), dict(status="approved"),
    dict(risk_tier="LOW", offset=7_990, limit=200), dict(after=(0.95, "8", None), limit=30), dict(offset=39_990, limit=50)])
def test_skipping_pages_equal_plain_ones(table, options):
    page = queue.case_queue_skipping(table.read(), **options)
    assert page.collect() == queue.case_queue(table.read(), **options).collect()


def test_the_first_page_reads_only_row_groups_that_reach_it(table):
    page = queue.case_queue_skipping(table.read(), limit=50)
    assert rows_read(page) <= ROWS // 20 < ROWS // 4 <= rows_read(queue.case_queue(table.read(), limit=50))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(risk_score" in plan and "abuse_risk_tier#" in plan.split("PartitionFilters")[1]


@pytest.fixture(scope="module")
def claims(spark):
    rows = [dict(refund_id=f"R{i}", customer_id=i % 9 if i % 13 else None, amount=(i * 37 % 1000) / 100 if i % 5 else None,
                 reason_code=("DAMAGED", "DEFECTIVE", None)[i % 3], request_date=day(i % 200) if i % 17 else None)
            for i in range(600)] + [dict(refund_id=None, customer_id=3, amount=2e6, request_date=day(3), reason_code="DAMAGED")]
    return source(spark, "refund_requests", *rows)


@pytest.mark.parametrize("as_of", [AS_OF, day(45), AS_OF + dt.timedelta(days=60), day(400)])
def test_partial_sums_equal_the_full_history(spark, claims, as_of):
    settings = Settings(as_of=as_of)
    late = F.col("refund_id").endswith("7")
    batches = [claims.filter(~late & (F.col("request_date") < F.lit(day(50)))), claims.filter(late),
               claims.filter((~late & ((F.col("request_date") >= F.lit(day(50))) | F.col("request_date").isNull()))
                             | F.col("refund_id").isNull())]
    days = [history.claim_days(batch) for batch in batches]
    days = days[0].unionByName(days[1]).unionByName(days[2])
    full, partial = history.customer_refund_history(claims, settings), history.history_from_days(days, settings)
    assert partial.columns == full.columns and partial.dtypes == full.dtypes
    assert sorted(map(repr, partial.collect())) == sorted(map(repr, full.collect()))
    members = source(spark, "household_mappings", *[
        dict(mapping_id=i, household_id=f"H{i % 4}", customer_id=i % 9) for i in (*range(12), 3)])
    full, partial = household.household_totals(claims, members, settings), household.totals_from_days(days, members, settings)
    assert partial.dtypes == full.dtypes
    assert sorted(map(repr, partial.collect())) == sorted(map(repr, full.collect()))


def test_partial_sums_of_nothing(spark, claims):
    none = history.claim_days(claims.limit(0))
    assert history.history_from_days(none, SETTINGS).isEmpty()
