"""CSV files in, quality rules, and a whole build from files with bad rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimsift.operators import quality
from claimsift.plans import registry
from claimsift.plans.tables import TABLES, Workspace, build_all
from claimsift.schemas import LIVE_CASES, SOURCES
from claimsift.sources import testdata
from claimsift.sources.csv_files import read_source, source_path, write_source
from claimsift.settings import Settings
from tests.frames import day, source

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("table", SOURCES)
def test_round_trip(spark, tmp_path, table):
    df = testdata.TestData(spark, SF_DIR).source(table)
    path = str(tmp_path / table)
    write_source(df, path)
    back = read_source(spark, path, table)
    assert back.schema.simpleString() == SOURCES[table].simpleString()
    assert back.exceptAll(df.select(back.columns)).count() == 0 and back.count() == df.count()


def write_orders(spark, folder):
    """Orders with several lines, lines that come twice, an order without lines, lines without an order, and null keys."""
    when = F.lit(dt.datetime(1995, 1, 2))
    rows = [(key, number, 7 * number, number % 3, 10.0 * number, flag, status)
            for key in (1, 2, 2, None) for number, flag, status in ((2, "N", "F"), (1, "R", "O"), (3, "R", "F"))]
    rows += [(4, 1, 5, 5, 1.0, "R", "F"), (4, 1, 4, 5, 1.0, "N", "O"), (9, 1, 1, 1, 1.0, "R", "F")]
    lines = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, " \
            "l_returnflag string, l_linestatus string"
    spark.createDataFrame(rows, lines).withColumn("l_shipdate", when).write.parquet(f"{folder}/lineitem.parquet")
    orders = [(1, 10, 900.0, "F"), (2, 10, 600.0, "O"), (3, 11, 300.0, "P"), (4, 11, 900.0, "F"), (None, 12, 300.0, "F")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string").withColumn(
        "o_orderdate", when).write.parquet(f"{folder}/orders.parquet")


def test_lines_are_sorted_once_for_all_sources(spark, tmp_path):
    write_orders(spark, tmp_path)
    plain, kept = testdata.TestData(spark, str(tmp_path)), testdata.TestData(spark, str(tmp_path), str(tmp_path / "kept"))
    for table in ("order_history", "refund_requests", "delivery_events", "historical_decisions"):
        df = kept.source(table)
        assert "Window" not in df._jdf.queryExecution().executedPlan().toString(), table
        assert sorted(map(str, df.collect())) == sorted(map(str, plain.source(table).collect())), table
    orders = {r.order_id: r.product_id for r in kept.order_history().filter("order_id IS NOT NULL").collect()}
    assert orders == {"ORD-000000001": "PROD-0000007", "ORD-000000002": "PROD-0000007", "ORD-000000003": None,
                      "ORD-000000004": "PROD-0000004"}
    assert sorted(r.refund_id for r in kept.refund_requests().collect()) == ["REF-000000001", "REF-000000002"]
    delivered = [r.delivery_id for r in kept.delivery_events().filter("order_id = 'ORD-000000002'").collect()]
    assert sorted(delivered) == [f"DEL-000000002-00{n}" for n in (3, 4, 5, 6)]


def test_landed_sources_are_compressed(spark):
    landed = registry.data(spark, SF_DIR).land("store_locations")
    assert all(f.endswith(".csv.gz") for f in read_source(spark, landed, "store_locations").inputFiles())


def test_inferred_schema_has_dates_and_booleans(spark, tmp_path):
    write_source(testdata.TestData(spark, SF_DIR).household_mappings(), str(tmp_path / "h"))
    inferred = dict(read_source(spark, str(tmp_path / "h"), "household_mappings", infer_schema=True).dtypes)
    assert inferred["shared_address_flag"] == "boolean" and inferred["household_id"] == "string"


def test_quoted_text_survives(spark, tmp_path):
    row = dict(product_id="P", name='a "b", c', category="Home & Garden", price=1.5, is_high_value=True)
    write_source(source(spark, "product_catalog", row), str(tmp_path / "p"))
    assert read_source(spark, str(tmp_path / "p"), "product_catalog").first().name == 'a "b", c'


def test_source_path_takes_files_and_folders(spark, tmp_path):
    (tmp_path / "order_history.csv").write_text("order_id\n")
    (tmp_path / "refund_requests").mkdir()
    base = str(tmp_path)
    assert source_path(spark, base, "order_history").endswith("order_history.csv")
    assert source_path(spark, base, "refund_requests").endswith("refund_requests")
    with pytest.raises(FileNotFoundError):
        source_path(spark, base, "delivery_events")


def bad_requests(spark):
    good = dict(refund_id="R1", customer_id=1, amount=5.0, request_date=day(1))
    return source(spark, "refund_requests", good, good | dict(refund_id=None), good | dict(amount=None),
                  good | dict(amount=0.0), good | dict(amount=-1.0), good | dict(refund_id=None, amount=-1.0))


def test_expectations_drop_and_report(spark):
    df, rules = bad_requests(spark), quality.EXPECTATIONS["refund_requests"]
    assert [row.refund_id for row in quality.apply_expectations(df, rules).collect()] == ["R1"]
    report = {row.expectation: (row.passed, row.dropped)
              for row in quality.expectation_report({"refund_requests": df}).collect()}
    assert report == {"valid_refund_id": (4, 2), "valid_amount": (2, 4), "countable_amount": (6, 0)}


def test_unreadable_values_are_dropped_by_the_rules(spark, tmp_path):
    lines = ["refund_id,order_id,customer_id,reason_code,amount,channel,request_date,item_condition",
             "R1,O1,1,DAMAGED,5.5,online,2025-03-01,used", "R2,O1,1,DAMAGED,five,online,2025-03-01,used",
             ",O1,1,DAMAGED,5.5,online,2025-03-01,used", "R4,O1,1,DAMAGED,5.5,online,someday,used"]
    (tmp_path / "refund_requests.csv").write_text("\n".join(lines))
    df = read_source(spark, str(tmp_path / "refund_requests.csv"), "refund_requests")
    kept = quality.apply_expectations(df, quality.EXPECTATIONS["refund_requests"]).orderBy("refund_id").collect()
    assert [(r.refund_id, r.request_date) for r in kept] == [("R1", dt.date(2025, 3, 1)), ("R4", None)]


def test_report_of_an_empty_table(spark):
    row = quality.expectation_report({"store_locations": source(spark, "store_locations")}).first()
    assert (row.passed, row.dropped) == (0, 0)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("csv")
    data = testdata.TestData(spark, SF_DIR)
    for table in SOURCES:
        df = data.source(table)
        if table == "refund_requests":
            df = df.unionByName(bad_requests(spark).filter("refund_id IS NULL OR amount <= 0"))
        write_source(df, str(base / table))
    return build_all(spark, str(base), str(tmp_path_factory.mktemp("out")), Settings(as_of=testdata.AS_OF))


def test_build_writes_every_table(spark, built):
    for name in (*SOURCES, *TABLES):
        assert built.table(name).inputFiles(), name
    assert built.table("refund_requests").count() == built.table("enriched_requests").count() == 509
    assert built.table("live_cases").schema.simpleString() == LIVE_CASES.simpleString()


def test_build_counts_what_it_drops(built):
    counts = built.dropped["refund_requests"].get
    assert (counts["rows"], counts["valid_refund_id"], counts["valid_amount"]) == (513, 2, 3)
    assert built.dropped["enriched_requests"].get["valid_customer_id"] == 0


def test_invariants(built):
    cases = built.table("case_decisioning")
    low, high = cases.agg(F.min("risk_score"), F.max("risk_score")).first()
    assert 0.055 <= low and high <= 0.935
    segments = built.table("segment_summary")
    parts = F.col("approved_count") + F.col("escalated_count") + F.col("rejected_count")
    assert segments.filter(parts != F.col("total_cases")).count() == 0
    assert segments.agg(F.sum("total_cases")).first()[0] == cases.count()


def test_tables_do_not_depend_on_partitioning(spark, built, conf):
    names = ("household_activity", "customer_360", "case_decisioning", "segment_summary")
    conf(spark__sql__shuffle__partitions="13", spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__files__maxPartitionBytes="20000", spark__sql__adaptive__enabled="false")
    for name in names:
        again = built.plan(name)
        assert again.exceptAll(built.table(name)).count() == 0, name
        assert again.count() == built.table(name).count()


def test_tables_can_be_queried_with_sql(spark, built):
    built.create_views("claims_")
    top = spark.sql("""
        SELECT customer_id, risk_tier, refund_rate FROM claims_customer_360 WHERE risk_tier IN ('HIGH', 'CRITICAL')
        ORDER BY refund_rate DESC LIMIT 20""")
    leakage = spark.sql("""
        SELECT product_category, SUM(CASE WHEN recommended_action = 'REJECT' THEN amount ELSE 0 END) AS leakage
        FROM claims_case_decisioning GROUP BY product_category ORDER BY leakage DESC""")
    assert top.count() == 20 and leakage.count() == 10


def test_spreading_hot_keys_changes_nothing(built):
    spread = Settings(as_of=testdata.AS_OF, hot_keys=dict(min_rows=2, salts=3))
    for name in ("household_activity", "customer_360", "case_decisioning"):
        again = TABLES[name].build(*built.inputs(name), spread)
        assert again.exceptAll(built.table(name)).count() == 0, name
        assert again.count() == built.table(name).count()


def test_windows_follow_the_as_of_date(spark, built):
    later = Settings(as_of=dt.date(2030, 1, 1))
    past = TABLES["customer_refund_history"].build(built.table("refund_requests"), later)
    assert past.agg(F.sum("refunds_90d")).first()[0] == 0


def test_columns_are_bound_by_header(spark, tmp_path):
    file = tmp_path / "household_mappings.csv"
    names = SOURCES["household_mappings"].fieldNames()
    file.write_text(",".join(["extra", *reversed(names)]) + "\n" + ",".join(["z"] * (len(names) + 1)) + "\n")
    df = read_source(spark, str(file), "household_mappings")
    assert df.columns == names and df.count() == 1
    file.write_text(",".join(names[1:]) + "\n")
    with pytest.raises(ValueError, match=names[0]):
        read_source(spark, str(file), "household_mappings")


def test_damaged_rows_are_kept_aside(spark, tmp_path):
    header = "refund_id,order_id,customer_id,reason_code,amount,channel,request_date,item_condition"
    good = ["R1,O1,1,DAMAGED,5.5,online,2025-03-01,used", "R5,,,DAMAGED,5.5,online,,", ",O1,1,DAMAGED,5.5,online,2025-03-01,used"]
    damaged = ["R2,O1,1,DAMAGED,five,online,2025-03-01,used", "R3,O1,1,DAMAGED,5.5,online,someday,used", "R4,O1,1,DAMAGED",
               "R6,O1,1,DAMAGED,5.5,online,2025-03-01,used,more", '"R7,O1"x,1,DAMAGED,5.5,online,2025-03-01,used']
    (tmp_path / "refund_requests.csv").write_text("\n".join([header, *good, *damaged]))
    run = Workspace(spark, lambda name: str(tmp_path / f"{name}.csv"), str(tmp_path / "out"), Settings(as_of=testdata.AS_OF))
    kept, rejects = run.table("refund_requests"), run.rejects("refund_requests")
    assert sorted(r.refund_id for r in kept.collect()) == ["R1", "R5"] and kept.columns == SOURCES["refund_requests"].fieldNames()
    lines = {r.line: r for r in rejects.collect()}
    assert set(damaged[:4]) <= set(lines) and len(lines) == 5
    assert lines[damaged[1]].read_as.refund_id == "R3" and lines[damaged[1]].read_as.request_date is None
    assert all(r.file.endswith("refund_requests.csv") for r in lines.values())
    counts = run.dropped["refund_requests"].get
    assert counts["rows"] == 8 and counts["readable_row"] == 5


def test_sources_without_damage_have_no_rejects(built):
    assert built.dropped["refund_requests"].get["readable_row"] == 0
    assert built.rejects("refund_requests").isEmpty() and built.rejects("refund_requests").columns == ["file", "line", "read_as"]


def test_quality_is_logged_once_per_run(spark, built, tmp_path):
    log = str(tmp_path / "quality")
    for run, day in (("first", 1), ("first", 1), ("second", 2)):
        built.log_quality(log, run, dt.datetime(2025, 3, day))
    rows = quality.read_quality(spark, log)
    assert rows.groupBy("run").count().count() == 2
    assert rows.groupBy("run", "table_name", "expectation").count().filter("count > 1").isEmpty()
    first = rows.filter("run = 'first' AND table_name = 'refund_requests'").collect()
    assert {r.expectation: (r.passed, r.dropped) for r in first} == {
        "readable_row": (513, 0), "valid_refund_id": (511, 2), "valid_amount": (510, 3), "countable_amount": (513, 0)}


def test_quality_changes(spark):
    at = [dt.datetime(2025, 3, day) for day in (1, 2, 3)]
    log = spark.createDataFrame(
        [("a", at[0], "t", "r", 90, 10), ("c", at[2], "t", "r", 0, 0), ("b", at[1], "t", "r", 150, 50),
         ("b", at[1], "t", "new", 200, 0)], quality.QUALITY_LOG)
    got = {(r.run, r.expectation): (r.dropped_pct, r.previous_run, r.passed_change, r.dropped_change, r.pct_change)
           for r in quality.quality_changes(log).collect()}
    assert got == {("a", "r"): (10.0, None, None, None, None), ("b", "r"): (25.0, "a", 60, 40, 15.0),
                   ("c", "r"): (0.0, "b", -150, -50, -25.0), ("b", "new"): (0.0, None, None, None, None)}
