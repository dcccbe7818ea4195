"""Claim activity per household and detection of members claiming within two days of each other.

A household's claims are looked at in the order (request_date, refund_id), and a claim counts as coordinated if the claim
just before it came from another member at most 48 hours earlier. Claims of one day are compared in a window over that
household and day; what lies between days follows from the first and the last claimant of each, in a window over one row
per day. A household and day with very many claims is no group of one task: its claims are sorted over a range of tasks,
each compares those in its segment, and the last claimant of a segment is carried to the next. Totals, reason codes and members come from claims already reduced per
customer, through sums and distinct rows only, so a household or customer with a third of all claims is combined before
each shuffle; the joins on customers are left to adaptive skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from claimsift.functions.numeric import combined, count_where, parts_to_sum
from claimsift.operators.history import AMOUNT_PARTS, within_last
from claimsift.settings import Settings


def _members(households: DataFrame) -> DataFrame:
    """Each (household, customer) once, with the number of times it is listed."""
    return households.groupBy("household_id", "customer_id").agg(F.count(F.lit(1)).alias("listed"))


#: Households and days that are looked for as hot ones, from this many claims on; more than ``MOST_HOT`` would each own
#: too small a share of the claims to matter.
HOT_DAY, MOST_HOT = 1_000_000, 1_000
_DAY = ["household_id", "request_date"]


def household_days(requests: DataFrame, households: DataFrame, hot_day: int = HOT_DAY) -> DataFrame:
    """One row per household and day with claims: how often the claimant changes from claim to claim within the day, and
    the first and the last of them. Days of ``hot_day`` claims and more are cut into segments."""
    dated = requests.select("refund_id", "customer_id", F.col("request_date").cast("date").alias("request_date"))
    members = _members(households).drop("listed")
    claims = dated.join(members, "customer_id")
    hot = hot_days(dated, members, hot_day)
    if not hot:
        return _compared(claims, [])
    kinds = [claims.schema[c].dataType for c in _DAY]
    rows = [F.struct(*[F.lit(v).cast(kind).alias(c) for c, v, kind in zip(_DAY, row, kinds)]) for row in hot]
    listed = F.broadcast(dated.sparkSession.range(1).select(F.inline(F.array(*rows))))  # at most MOST_HOT rows
    is_hot = [claims[c].eqNullSafe(listed[c]) for c in _DAY]
    plain = _compared(claims.join(listed, is_hot, "left_anti"), [])
    return plain.unionByName(_segmented(claims.join(listed, is_hot, "left_semi")))


def hot_days(dated: DataFrame, members: DataFrame, hot_day: int) -> list[tuple]:
    """The households and days with the most claims, if any has ``hot_day``. Only where some day has that many claims at
    all are they counted by household, by claims already reduced per customer."""
    by_day = dated.groupBy("request_date").count().agg(F.max("count")).first()[0]
    if (by_day or 0) < hot_day:
        return []
    per_customer = dated.groupBy("customer_id", "request_date").count()
    counts = per_customer.join(members, "customer_id").groupBy(*_DAY).agg(F.sum("count").alias("n"))
    return [tuple(row) for row in counts.filter(F.col("n") >= hot_day).orderBy(F.desc("n"), *_DAY).limit(
        MOST_HOT).select(*_DAY).collect()]


def _compared(claims: DataFrame, segment: list[str]) -> DataFrame:
    within = Window.partitionBy(*_DAY, *segment).orderBy("refund_id", "customer_id")
    changed = F.coalesce(F.col("customer_id") != F.lag("customer_id").over(within), F.lit(False))
    place = F.struct("refund_id", "customer_id")
    return claims.withColumn("changed", changed).groupBy(*_DAY, *segment).agg(
        count_where(F.col("changed")).alias("changes"),
        F.count_distinct("customer_id").alias("day_members"),
        F.min_by("customer_id", place).alias("first_customer"),
        F.max_by("customer_id", place).alias("last_customer"),
    )


def _segmented(claims: DataFrame) -> DataFrame:
    """The same for hot days: a segment is what one task of a global sort holds of a day, so segments follow each other."""
    order = [*_DAY, "refund_id", "customer_id"]
    tasks = int(claims.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = claims.repartitionByRange(tasks, *order).withColumn("segment", F.spark_partition_id())
    parts = _compared(spread, ["segment"]).drop("day_members")
    in_order = Window.partitionBy(*_DAY).orderBy("segment")
    carried = F.coalesce(F.col("first_customer") != F.lag("last_customer").over(in_order), F.lit(False))
    joined = parts.withColumn("carried", carried).groupBy(*_DAY).agg(
        (F.sum("changes") + count_where(F.col("carried"))).alias("changes"),
        F.min_by("first_customer", "segment").alias("first_customer"),
        F.max_by("last_customer", "segment").alias("last_customer"),
    )
    members = claims.select(*_DAY, "customer_id").distinct().groupBy(*_DAY).agg(
        F.count("customer_id").alias("day_members")).withColumnsRenamed({c: f"_{c}" for c in _DAY})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _DAY]
    return joined.join(members, same).select(*_DAY, "changes", "day_members", "first_customer", "last_customer")


def household_day_sequence(days: DataFrame, settings: Settings) -> DataFrame:
    """Adds what the day before says: its date, its last claimant, the hours since, and the coordinated claims.

    Claims dated NULL sort first and are never close to another claim.
    """
    in_order = Window.partitionBy("household_id").orderBy("request_date")
    hours = F.datediff("request_date", "prev_date").cast("long") * 24
    follows = F.coalesce(
        (F.col("hours_between") <= settings.coordination_hours) & (F.col("first_customer") != F.col("prev_customer")),
        F.lit(False),
    )
    same_day = F.when(F.col("request_date").isNotNull(), F.col("changes")).otherwise(F.lit(0))
    return (
        days
        .withColumn("prev_date", F.lag("request_date").over(in_order))
        .withColumn("prev_customer", F.lag("last_customer").over(in_order))
        .withColumn("hours_between", hours)
        .withColumn("coord_flag", follows)
        .withColumn("coordinated", (same_day + follows.cast("int")).cast("long"))
    )


def household_coordination(sequence: DataFrame) -> DataFrame:
    return sequence.groupBy("household_id").agg(
        F.sum("coordinated").alias("coordinated_refund_count"),
    ).withColumn("coordinated_timing_flag", F.col("coordinated_refund_count") > 0)


def household_totals(requests: DataFrame, households: DataFrame, settings: Settings) -> DataFrame:
    """Claims, amounts, reason codes and claiming members of each household; a membership listed twice counts its claims
    twice and its member once."""
    per_code = requests.withColumn("request_date", F.col("request_date").cast("date")).groupBy(
        "customer_id", "reason_code").agg(
        F.count("refund_id").alias("claims"),
        count_where(within_last(settings.short_window_days, settings)).alias("recent"),
        *[F.sum(part).alias(name) for name, part in zip(AMOUNT_PARTS, parts_to_sum("amount"))],
    )
    return _totals(per_code, requests.select("customer_id").distinct(), households)


def totals_from_days(days: DataFrame, households: DataFrame, settings: Settings) -> DataFrame:
    """``household_totals`` from the partial sums of ``history.claim_days``."""
    recent = F.when(within_last(settings.short_window_days, settings), F.col("filed")).otherwise(F.lit(0))
    per_code = days.groupBy("customer_id", "reason_code").agg(
        F.sum("claims").alias("claims"), F.sum(recent).alias("recent"), *[F.sum(c).alias(c) for c in AMOUNT_PARTS])
    return _totals(per_code, per_code.select("customer_id").distinct(), households)


def _totals(per_code: DataFrame, claiming: DataFrame, households: DataFrame) -> DataFrame:
    members = _members(households)
    by_code = per_code.join(members, "customer_id").groupBy("household_id", "reason_code").agg(
        *[F.sum(F.col(c) * F.col("listed")).alias(c) for c in ("claims", "recent", *AMOUNT_PARTS)])
    totals = by_code.groupBy("household_id").agg(
        F.sum("claims").cast("long").alias("household_total_refunds"),
        F.sum("recent").cast("long").alias("household_refund_count_30d"),
        combined(*[F.sum(name) for name in AMOUNT_PARTS]).alias("household_total_refund_amount"),
        F.array_join(F.sort_array(F.collect_set("reason_code")), ", ").alias("household_reason_codes"),
    )
    claimants = claiming.join(members, "customer_id").groupBy("household_id").agg(
        F.count(F.lit(1)).alias("household_members_with_refunds"))
    return claimants.join(totals, "household_id")


def household_activity(requests: DataFrame, households: DataFrame, settings: Settings) -> DataFrame:
    """Activity and coordination of each household with a claim."""
    hot_day = settings.hot_keys.get("min_rows", HOT_DAY)
    sequence = household_day_sequence(household_days(requests, households, hot_day), settings)
    return household_totals(requests, households, settings).join(household_coordination(sequence), "household_id")
