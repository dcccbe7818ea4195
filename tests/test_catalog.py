"""The tables of a run in the session catalog."""

import pytest
from pyspark.sql import functions as F

from claimsift.plans import catalog, registry
from claimsift.schemas import SOURCES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    made = registry.data(spark, SF_DIR).run
    made.build()
    assert len(catalog.register(made, "claims_catalog")) == 16
    yield made
    spark.sql("DROP DATABASE claims_catalog CASCADE")


def test_another_session_reads_tables_by_name(spark, run):
    other = spark.newSession()
    for name in ("refund_requests", "enriched_requests", "case_decisioning"):
        table = other.table(f"claims_catalog.{name}")
        assert table.count() == run.table(name).count()
        assert table.schema.simpleString() == run.table(name).schema.simpleString()
    top = other.sql("SELECT customer_id FROM claims_catalog.customer_360 WHERE risk_tier = 'CRITICAL' ORDER BY 1 LIMIT 3")
    assert top.count() == 3


def test_properties_tell_the_layer(spark, run):
    got = {name: catalog.properties(spark, "claims_catalog", name)[catalog.LAYER]
           for name in ("order_history", "latest_delivery", "customer_360")}
    assert got == {"order_history": "bronze", "latest_delivery": "silver", "customer_360": "gold"}


def test_registering_again_replaces(spark, run):
    catalog.register(run, "claims_catalog")
    assert spark.table("claims_catalog.refund_policies").count() == run.table("refund_policies").count()


def test_rows_of_another_schema_are_refused(spark, run, tmp_path):
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SOURCES["store_locations"].fields)
    spark.sql(f"CREATE TABLE claims_catalog.more_stores ({fields}) USING parquet LOCATION '{tmp_path}/stores'")
    stores = run.table("store_locations")
    catalog.append(stores, "claims_catalog", "more_stores")
    assert spark.table("claims_catalog.more_stores").count() == stores.count()
    for wrong in (stores.withColumn("store_id", F.lit(1)), stores.drop("state"), stores.withColumn("more", F.lit("x")),
                  stores.select(*reversed(stores.columns))):
        with pytest.raises(catalog.SchemaMismatch, match="more_stores"):
            catalog.append(wrong, "claims_catalog", "more_stores")
    assert spark.table("claims_catalog.more_stores").count() == stores.count()
