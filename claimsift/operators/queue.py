"""Review queue and case lookups.

Lookups of few ids reach the files as a list of values: the tables are written with Bloom filters on the keys that are
looked up, so row groups without an asked id are not read. Lookups of many ids are joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimsift.operators.keyed import HotKeys, first_per_key
from claimsift.operators.profiles import one_row_per_customer
from claimsift.settings import SCORE_TIERS

# What a queue shows of a case.
QUEUE_COLUMNS = (
    "refund_id", "order_id", "customer_id", "first_name", "last_name", "tier", "reason_code", "amount", "channel",
    "request_date", "risk_score", "recommended_action", "workflow_state", "abuse_risk_tier", "product_name",
    "product_category",
)
MAX_PAGE = 200
#: Up to so many ids are looked up as values; it is also the bound of what is brought to the driver for that.
FEW_IDS = 1_000


def case_queue(
    live: DataFrame, status: str | None = None, risk_tier: str | None = None, channel: str | None = None,
    limit: int = 50, offset: int = 0, after: tuple[float, str, str | None] | None = None,
) -> DataFrame:
    """A page of the queue, highest risk first; filters on state and tier prune partitions of the serving table.

    Each task keeps ``offset + limit`` rows, so go deep with ``after`` instead: the (risk_score, refund_id, household_id)
    of the last row seen. The page then costs the same however deep it lies; it carries ``household_id`` for that.
    """
    return _page(_queued(live, status, risk_tier, channel, limit, offset, after), limit, offset)


def case_queue_skipping(
    live: DataFrame, status: str | None = None, risk_tier: str | None = None, channel: str | None = None,
    limit: int = 50, offset: int = 0, after: tuple[float, str, str | None] | None = None,
) -> DataFrame:
    """The same page for a large serving table, with as little of it read as possible.

    Tiers are ranges of the score, so the page lies in the most severe ones that hold ``offset + limit`` rows; the others
    are not opened. The lowest score of the page is found from the columns that are filtered on alone. It then goes down to
    the scan of all columns, which passes over the row groups that do not reach it, as rows of a file are sorted by score.
    """
    queued = _queued(live, status, risk_tier, channel, limit, offset, after)
    wanted, scores, tiers = offset + limit, [], []
    for tier in SCORE_TIERS:
        if risk_tier and tier != risk_tier:
            continue
        tiers.append(tier)
        best = queued.filter(F.col("abuse_risk_tier") == tier).select("risk_score").orderBy(F.desc("risk_score"))
        scores += [row[0] for row in best.limit(wanted - len(scores)).collect()]  # at most a page and its offset
        if len(scores) >= wanted:
            break
    reached = queued.filter(F.col("abuse_risk_tier").isin(tiers))
    if len(scores) >= wanted:
        reached = reached.filter(F.col("risk_score") >= F.lit(scores[-1]))
    return _page(reached, limit, offset)


def _queued(live: DataFrame, status: str | None, risk_tier: str | None, channel: str | None, limit: int, offset: int,
            after: tuple[float, str, str | None] | None) -> DataFrame:
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE}, got {limit}")
    if offset < 0:
        raise ValueError(f"offset must not be negative, got {offset}")
    wanted = {"workflow_state": status, "abuse_risk_tier": risk_tier, "channel": channel}
    for column, value in wanted.items():
        if value:
            live = live.filter(F.col(column) == value)
    return live if after is None else live.filter(_comes_after(*after))


def _page(queued: DataFrame, limit: int, offset: int) -> DataFrame:
    order = (F.desc("risk_score"), F.asc("refund_id"), F.asc_nulls_last("household_id"))
    return queued.select(*QUEUE_COLUMNS, "household_id").orderBy(*order).offset(offset).limit(limit)


def _comes_after(score: float, refund_id: str, household_id: str | None) -> Column:
    """Rows behind the given one in queue order, where a missing household comes last."""
    same = (F.col("risk_score") == score) & (F.col("refund_id") == refund_id)
    home = F.col("household_id")
    later_home = F.lit(False) if household_id is None else home.isNull() | (home > household_id)
    lower = (F.col("risk_score") < score) | ((F.col("risk_score") == score) & (F.col("refund_id") > refund_id))
    return lower | (same & later_home)


def one_row_per_case(cases: DataFrame) -> DataFrame:
    """Reduces cases at membership grain to one row per claim: coordinated first, then the highest score."""
    return first_per_key(
        cases, ["refund_id"],
        F.desc_nulls_last("coordinated_timing_flag"), F.desc("risk_score"), F.asc_nulls_last("household_id"),
    )


def requested_cases(cases: DataFrame, ids: DataFrame) -> DataFrame:
    """The cases asked for, one row each."""
    return cases_of(cases, ids, few_ids(ids))


def few_ids(ids: DataFrame) -> list[str] | None:
    """The claims asked for, or None if there are more than ``FEW_IDS`` rows."""
    return _few(ids, "refund_id")


def _few(rows: DataFrame, key: str) -> list | None:
    found = rows.select(key).limit(FEW_IDS + 1).collect()
    return None if len(found) > FEW_IDS else sorted({row[0] for row in found if row[0] is not None})


def cases_of(cases: DataFrame, ids: DataFrame, few: list[str] | None) -> DataFrame:
    """``requested_cases`` for a caller that knows ``few_ids`` already."""
    if few is not None:
        return one_row_per_case(cases.filter(F.col("refund_id").isin(few)))
    return one_row_per_case(cases.join(ids.select("refund_id").distinct(), "refund_id", "left_semi"))


def missing_cases(cases: DataFrame, ids: DataFrame) -> DataFrame:
    """Requested ids without a case.

    Cases are first reduced to the requested ones, so that few ids are broadcast and the cases stay where they are.
    """
    wanted = ids.select("refund_id").distinct()
    known = cases.select("refund_id").join(wanted, "refund_id", "left_semi").distinct()
    unknown = wanted.join(known, "refund_id", "left_anti")
    return unknown.withColumn("error", F.lit("Refund not found"))


def case_detail(cases: DataFrame, profiles: DataFrame, ids: DataFrame, **hot: int) -> DataFrame:
    """Requested cases with the profile of their customer as the struct ``customer_360`` (NULL if there is none)."""
    few = few_ids(ids)
    return with_profile(cases_of(cases, ids, few), cases, profiles, few is not None, **hot)


def with_profile(found: DataFrame, cases: DataFrame, profiles: DataFrame, few: bool = False, **hot: int) -> DataFrame:
    """Adds ``customer_360`` to ``found``, some cases of ``cases``. ``few``: they are at most ``FEW_IDS``, so no customer
    can be hot among them and the profiles are looked up by value as well."""
    customers = _few(found, "customer_id") if few else None
    needed = (profiles.filter(F.col("customer_id").isin(customers)) if customers is not None
              else profiles.join(found.select("customer_id").distinct(), "customer_id", "left_semi"))
    nested = one_row_per_customer(needed).select("customer_id", F.struct(*profiles.columns).alias("customer_360"))
    if few:
        joined = found.join(nested, "customer_id", "left")
    else:
        joined = HotKeys(cases, "customer_id", **hot).lookup(found, nested, "refund_id")
    return joined.select(*found.columns, "customer_360")
