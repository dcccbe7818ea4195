"""Every query by name, over the parquet tables of one scale factor.

The tables of a run are built once per session and scale factor and written to the shared folder; a query that is itself
one of those tables is planned anew over the tables it is built from.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from claimsift.operators import decisions, enrich, history, household, metrics, profiles, quality, queue, scoring, serving
from claimsift.plans import catalog
from claimsift.plans.tables import TABLES, Workspace
from claimsift.schemas import SOURCES
from claimsift.session import shared_folder
from claimsift.settings import Settings
from claimsift.sources import testdata
from claimsift.sources.batches import BatchLog
from claimsift.sources.csv_files import read_source, write_source

SETTINGS = Settings(as_of=testdata.AS_OF)
BRONZE = {
    "bronze_requests": "refund_requests",
    "bronze_orders": "order_history",
    "bronze_customers": "customer_profiles",
    "bronze_households": "household_mappings",
    "bronze_stores": "store_locations",
    "bronze_products": "product_catalog",
    "bronze_deliveries": "delivery_events",
    "bronze_policies": "refund_policies",
    "bronze_decisions": "historical_decisions",
}

_open: dict[tuple[str, str], "Data"] = {}


class Data:
    """One scale factor: its source files, its tables and the inputs reviewers would provide."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.folder = shared_folder(spark, "run")
        self._landed: dict[str, str] = {}
        self._test = testdata.TestData(spark, sf_dir, f"{self.folder}/kept")
        self.run = Workspace(spark, self.land, f"{self.folder}/tables", SETTINGS)

    def land(self, name: str) -> str:
        """Write the source table as compressed CSV, once, and return its path."""
        if name not in self._landed:
            path = f"{self.folder}/csv/{name}"
            write_source(self._test.source(name), path, "gzip")
            self._landed[name] = path
        return self._landed[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.run.table(name)

    @property
    def actions(self) -> DataFrame:
        return testdata.actions(self["refund_requests"])

    @property
    def feedback(self) -> DataFrame:
        return testdata.feedback(self["refund_requests"])

    @property
    def replies(self) -> DataFrame:
        return testdata.replies(self["refund_requests"])

    @property
    def ids(self) -> DataFrame:
        return testdata.requested_ids(self["refund_requests"])

    @property
    def few_ids(self) -> DataFrame:
        """Ten claims, as a reviewer asks for them, and one that does not exist."""
        first = self["refund_requests"].select("refund_id").orderBy("refund_id").limit(10)
        return first.unionByName(self.spark.range(1).select(F.lit("REF-UNKNOWN-1").alias("refund_id")))

    @property
    def acted(self) -> DataFrame:
        return serving.apply_actions(self["live_cases"], self.actions)

    @property
    def asked(self) -> DataFrame:
        return queue.case_detail(self["live_cases"], self["customer_360"], self.ids)


def data(spark: SparkSession, sf_dir: str) -> Data:
    handle = (spark.sparkContext.applicationId, sf_dir)
    if handle not in _open:
        _open[handle] = Data(spark, sf_dir)
    return _open[handle]


def _joined(items: str) -> Column:
    return F.array_join(items, " | ")


def _bronze(name: str) -> Callable[[Data], DataFrame]:
    return lambda d: quality.apply_expectations(d.run.plan(name), quality.EXPECTATIONS[name])


def _planned(name: str, *left_out: str) -> Callable[[Data], DataFrame]:
    return lambda d: quality.apply_expectations(d.run.plan(name), quality.EXPECTATIONS.get(name, {})).drop(*left_out)


def _csv_roundtrip(d: Data) -> DataFrame:
    """Orders written as CSV and read back with an inferred schema, whose integers are as narrow as the data allows."""
    path = f"{shared_folder(d.spark, 'csv')}/order_history"
    write_source(d["order_history"], path)
    inferred = read_source(d.spark, path, "order_history", infer_schema=True)
    return inferred.withColumn("customer_id", F.col("customer_id").cast("long"))


def _live_cases_write(d: Data) -> DataFrame:
    """The serving table written with its partitions and read back."""
    path = f"{shared_folder(d.spark, 'live')}/live_cases"
    serving.write_live_cases(serving.live_cases(d["case_decisioning"]), path)
    return serving.read_live_cases(d.spark, path).drop("recommendation_reasons_json")


def _feedback_append(d: Data) -> DataFrame:
    """Feedback appended in two batches, the second of them twice, and read back."""
    path = f"{shared_folder(d.spark, 'feedback')}/feedback"
    submitted = d.feedback.drop("feedback_id")
    even = testdata.claim_number() % 2 == 0
    serving.append_feedback(submitted.filter(even), path, batch=1)
    for _ in range(2):
        serving.append_feedback(submitted.filter(~even), path, batch=2)
    return serving.read_feedback(d.spark, path)


def _reviewed(d: Data, fold_after: tuple[int, ...]) -> DataFrame:
    """The cases after three batches of actions; those named are folded into the table, the others laid over it."""
    folder = shared_folder(d.spark, "review")
    table, log = serving.live_table(d.spark, f"{folder}/live_cases"), f"{folder}/actions"
    table.replace(serving.live_cases(d["case_decisioning"]), gather=False)  # stored rows, in tasks of some megabytes
    deal = (testdata.claim_number() + F.hour("acted_at")) % 3 + 1
    for batch in (1, 2, 3):
        serving.append_actions(d.actions.filter(deal == batch), log, batch)
        if batch in fold_after:
            serving.fold_actions(table, serving.read_actions(d.spark, log))
    now = serving.reviewed_cases(table, serving.read_actions(d.spark, log))
    return serving.with_is_actioned(now).drop("recommendation_reasons_json")


def _expectation_report(d: Data) -> DataFrame:
    tables = {name: d.run.plan(name) for name in SOURCES}
    tables["enriched_requests"] = d.run.plan("enriched_requests")
    return quality.expectation_report(tables)


def _quality_changes(d: Data) -> DataFrame:
    """The rules in two runs of the log: over the claims of up to 30 days before the as-of date, and over all."""
    path = f"{shared_folder(d.spark, 'quality')}/log"
    month_ago = SETTINGS.as_of - dt.timedelta(days=30)
    for as_of in (month_ago, SETTINGS.as_of):
        seen = {}
        for name in SOURCES:
            df = d.run.plan(name)
            if name == "refund_requests":
                df = df.filter((F.col("request_date") <= F.lit(as_of)) | F.col("request_date").isNull())
            seen[name] = Observation(name)
            counted = quality.apply_expectations(df, quality.EXPECTATIONS[name], seen[name])
            counted.write.format("noop").mode("overwrite").save()
        at = dt.datetime.combine(as_of, dt.time())
        for _ in range(2):  # a run that is logged again counts once
            quality.log_quality(d.spark, path, str(as_of), at, {name: dict(s.get) for name, s in seen.items()})
    return quality.quality_changes(quality.read_quality(d.spark, path))


def _damaged_claims(d: Data) -> DataFrame:
    """The claims as CSV with some dates and amounts broken: which rows are kept, and which are rejected with their line."""
    k = testdata.claim_number()
    claims = d["refund_requests"].withColumns({
        "request_date": F.when(k % 7 == 0, F.lit("someday")).otherwise(F.col("request_date").cast("string")),
        "amount": F.when(k % 11 == 0, F.lit("ten")).otherwise(F.col("amount").cast("string"))})
    path = f"{shared_folder(d.spark, 'damaged')}/refund_requests"
    write_source(claims, path)
    run = Workspace(d.spark, lambda _: path, f"{path}_tables", SETTINGS)
    kept = run.table("refund_requests").select("refund_id", F.lit(True).alias("kept"), F.lit(None).cast("string").alias("began"))
    began = F.substring_index("line", ",", 3)
    return kept.unionByName(run.rejects("refund_requests").select(
        "read_as.refund_id", F.lit(False).alias("kept"), began.alias("began")))


def _claim_days(d: Data) -> DataFrame:
    """Partial sums of three batches of claims: old ones, recent ones, and late ones of all dates."""
    log = BatchLog(d.spark, f"{shared_folder(d.spark, 'days')}/claim_days")
    late = F.pmod(F.xxhash64("refund_id"), F.lit(10)) == 0
    recent = F.col("request_date") >= F.date_sub(F.lit(SETTINGS.as_of), 20)
    for batch, wanted in enumerate((~late & ~recent, ~late & recent, late), start=1):
        log.append(history.claim_days(d["refund_requests"].filter(wanted)), batch)
    return log.read(log_schema(history.claim_days(d["refund_requests"])))


def _catalog_tables(d: Data) -> DataFrame:
    """The registered tables read by name, with the layer that their properties tell."""
    database = f"claims_{uuid.uuid4().hex}"
    d.run.build()
    counts = [
        d.spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit(catalog.properties(d.spark, database, name)[catalog.LAYER]).alias("layer"), "n")
        for name in catalog.register(d.run, database)]
    return reduce(DataFrame.unionByName, counts)


def log_schema(df: DataFrame) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in df.schema.fields])


def _household_sequence(d: Data) -> DataFrame:
    days = household.household_days(d["refund_requests"], d["household_mappings"])
    return household.household_day_sequence(days, SETTINGS)


def _customer_360_per_customer(d: Data) -> DataFrame:
    return profiles.customer_360(*d.run.inputs("customer_360"), dedupe=True)


def _cases_per_request(d: Data) -> DataFrame:
    cases = scoring.case_decisioning(*d.run.inputs("case_decisioning"), SETTINGS, dedupe=True)
    return cases.drop("recommendation_reasons_json")


def _case_detail(asked: DataFrame) -> DataFrame:
    nested = ("risk_tier", "refund_rate", "refunds_90d", "total_refunds", "household_id", "household_refund_count_30d",
              "coordinated_timing_flag", "household_total_refund_amount")
    return asked.select(
        "refund_id", "customer_id", "amount", "risk_score", "recommended_action", "workflow_state",
        F.col("household_id").alias("case_household_id"),
        *[F.col(f"customer_360.{name}").alias(f"c360_{name}") for name in nested])


def _validation(d: Data) -> DataFrame:
    checked = decisions.with_validation(d.asked)
    return checked.select("refund_id", "validation.valid", _joined("validation.issues").alias("issues"))


def _policy(d: Data) -> DataFrame:
    checked = decisions.with_policy(d.asked, SETTINGS)
    return checked.select(
        "refund_id", "policy.auto_approvable", _joined("policy.policy_flags").alias("policy_flags"))


def _risk(d: Data) -> DataFrame:
    checked = decisions.with_risk(d.asked)
    return checked.select(
        "refund_id", "risk.risk_score", "risk.risk_tier", _joined("risk.signals").alias("signals"))


def _prompt(d: Data) -> DataFrame:
    steps = decisions.with_risk(decisions.with_policy(decisions.with_validation(d.asked), SETTINGS))
    return decisions.with_prompt(steps).select("refund_id", "prompt")


def _parse_replies(d: Data) -> DataFrame:
    return decisions.parse_replies(d.replies).withColumn("key_factors", _joined("key_factors"))


def _decisions(d: Data, ids: DataFrame | None = None) -> DataFrame:
    return decisions.decide(d["live_cases"], d["customer_360"], d.ids if ids is None else ids, SETTINGS, d.replies)


def _decide_missing(d: Data) -> DataFrame:
    return queue.missing_cases(d["live_cases"], d.ids)


def _decide(d: Data) -> DataFrame:
    return _decisions(d).select(
        "refund_id", "validation.valid", _joined("validation.issues").alias("issues"),
        "policy.auto_approvable", _joined("policy.policy_flags").alias("policy_flags"),
        "risk.risk_score", "risk.risk_tier", _joined("risk.signals").alias("signals"),
        "recommendation.action", "recommendation.confidence", "recommendation.explanation",
        _joined("recommendation.key_factors").alias("key_factors"), "recommendation.fallback")


QUERIES: dict[str, Callable[[Data], DataFrame]] = {
    **{query: _bronze(name) for query, name in BRONZE.items()},
    "csv_roundtrip": _csv_roundtrip,
    "expectation_report": _expectation_report,
    "quality_changes": _quality_changes,
    "damaged_claims": _damaged_claims,
    "latest_delivery": lambda d: enrich.latest_delivery(d["delivery_events"]),
    "enriched_requests": _planned("enriched_requests"),
    "customer_refund_history": _planned("customer_refund_history"),
    "history_from_days": lambda d: history.history_from_days(_claim_days(d), SETTINGS),
    "household_totals_from_days": lambda d: household.totals_from_days(
        _claim_days(d), d["household_mappings"], SETTINGS),
    "household_coordination_segmented": lambda d: household.household_coordination(household.household_day_sequence(
        household.household_days(d["refund_requests"], d["household_mappings"], hot_day=2), SETTINGS)),
    "household_day_sequence": lambda d: _household_sequence(d).select(
        "household_id", "request_date", "day_members", "prev_date", "prev_customer", "hours_between", "coord_flag",
        "coordinated"),
    "household_coordination": lambda d: household.household_coordination(_household_sequence(d)),
    "household_activity": _planned("household_activity"),
    "customer_360": _planned("customer_360"),
    "customer_360_per_customer": _customer_360_per_customer,
    "case_decisioning": _planned("case_decisioning", "recommendation_reasons_json"),
    "case_decisioning_per_request": _cases_per_request,
    "decision_reasons": lambda d: scoring.decision_reasons(d["case_decisioning"], SETTINGS),
    "reasons_text": lambda d: d["case_decisioning"].select("refund_id", "household_id", "recommendation_reasons_json"),
    "segment_summary": _planned("segment_summary"),
    "live_cases": _planned("live_cases", "recommendation_reasons_json"),
    "live_cases_write": _live_cases_write,
    "action_validation": lambda d: serving.check_actions(d.actions),
    "apply_actions": lambda d: serving.with_is_actioned(d.acted).drop("recommendation_reasons_json"),
    "cases_reviewed": lambda d: _reviewed(d, ()),
    "cases_folded": lambda d: _reviewed(d, (1, 2)),
    "action_overrides": lambda d: decisions.action_overrides(d.actions, d["live_cases"]),
    "feedback_validation": lambda d: serving.check_feedback(d.feedback),
    "feedback_append": _feedback_append,
    "feedback_recent": lambda d: serving.recent_feedback(serving.valid_rows(serving.check_feedback(d.feedback))),
    "feedback_enriched": lambda d: decisions.feedback_enriched(d.feedback, d["live_cases"]),
    "case_queue": lambda d: queue.case_queue(d["live_cases"], limit=200, offset=50),
    "case_queue_skipping": lambda d: queue.case_queue_skipping(d["live_cases"], limit=200, offset=50),
    "case_queue_filtered": lambda d: queue.case_queue(
        d["live_cases"], status="pending_review", risk_tier="HIGH", channel="online", limit=50),
    "case_detail": lambda d: _case_detail(d.asked),
    "case_detail_few": lambda d: _case_detail(queue.case_detail(d["live_cases"], d["customer_360"], d.few_ids)),
    "dashboard_kpis": lambda d: metrics.dashboard_kpis(d.acted),
    "dashboard_rates": lambda d: metrics.dashboard_rates(metrics.dashboard_kpis(d.acted)),
    "risk_distribution": lambda d: metrics.risk_distribution(d["live_cases"]),
    "risk_distribution_share": lambda d: metrics.risk_distribution_share(d["live_cases"]),
    "workflow_distribution": lambda d: metrics.workflow_distribution(d.acted),
    "leakage_by_category": lambda d: metrics.leakage_by_category(d["case_decisioning"]),
    "refund_leakage": lambda d: metrics.refund_leakage(d["case_decisioning"], d["historical_decisions"]),
    "abuse_rate": lambda d: metrics.abuse_rate(d["customer_360"]),
    "recommendation_rates": lambda d: metrics.recommendation_rates(d["case_decisioning"]),
    "rejection_by_reason": lambda d: metrics.rejection_by_reason(d["case_decisioning"]),
    "escalation_by_segment": lambda d: metrics.escalation_by_segment(d["segment_summary"]),
    "top_abuse_customers": lambda d: metrics.top_abuse_customers(d["customer_360"]),
    "catalog_tables": _catalog_tables,
    "table_counts": lambda d: metrics.table_counts({name: d[name] for name in (*SOURCES, *TABLES)}),
    "decide_missing": _decide_missing,
    "decide_validation": _validation,
    "decide_policy": _policy,
    "decide_risk": _risk,
    "decide_prompt": _prompt,
    "parse_replies": _parse_replies,
    "decide": _decide,
    "decision_audit": lambda d: decisions.decision_audit(_decisions(d)),
    "decision_audit_few": lambda d: decisions.decision_audit(_decisions(d, d.few_ids)),
    "policy_checks": lambda d: decisions.policy_checks(queue.one_row_per_case(d["live_cases"])),
    "abuse_signals": lambda d: decisions.abuse_signals(d.asked),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(query: Callable[[Data], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(data(spark, sf_dir))

    return {name: bound(query) for name, query in QUERIES.items()}
