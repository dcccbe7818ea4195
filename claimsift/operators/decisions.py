"""Decision rules as column expressions, for any number of cases at once.

Every function takes cases as given by ``case_detail``: the case columns and the struct ``customer_360``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimsift.functions.bands import banded
from claimsift.functions.text import lines_where, listed, or_word, percent, quoted_list, true_false
from claimsift.operators.keyed import HotKeys
from claimsift.operators.queue import cases_of, few_ids, requested_cases, with_profile
from claimsift.operators.serving import check_actions, check_feedback, valid_rows
from claimsift.schemas import REPLY
from claimsift.settings import ABUSE_TIERS, Settings

# The wording of issues, flags and signals.
NO_ORDER = "No matching order found"
ITEM_MISSING = "Item reported as missing"
BELOW_LIMIT = "Below auto-approve threshold ($25)"
HIGH_VALUE = "High-value item requires manual review"
OUTSIDE_WINDOW = "Outside return window"
UNAUTHORIZED = "Unauthorized purchase - fraud team review"
COORDINATED = "Household coordination detected"
DELIVERED = "Claims non-delivery but delivery confirmed with photo"

# The policy checks and the severity-tagged signals shown to a reviewer.
CHECKS = ("Return Window", "Delivery Verified", "Item Condition", "High-Value Item")
HIGH_RATE = "High refund rate: "
NO_DELIVERY = "Non-delivery claim with photo-confirmed delivery"
GAMING = "Return window gaming: day "

# The question put to a language model; {names} stand for values of the case.
PROMPT = """You are a refund abuse analyst. Provide a structured recommendation.

REFUND REQUEST:
- Refund ID: {refund_id}
- Amount: ${amount}
- Reason: {reason_code}
- Product: {product_name} ({product_category})
- Channel: {channel}
- Days since order: {days_since_order}
- Item condition: {item_condition}

VALIDATION: Valid={valid}, Issues={issues}
POLICY: Auto-approvable={auto_approvable}, Flags={policy_flags}
RISK: Score={risk_score}/1.0, Tier={risk_tier}, Signals={signals}

Respond with EXACTLY this JSON:
{"action": "APPROVE" or "REJECT" or "ESCALATE", "confidence": 0.0-1.0, "explanation": "2-3 sentence explanation", \
"key_factors": ["factor1", "factor2"]}"""

EXCERPT = 200
REPLY_EXCERPT = 500
_REPLY, _UNPARSED = "_reply", "_unparsed"


def _is_true(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def _contradicts_delivery() -> Column:
    return (F.col("reason_code") == "ITEM_NOT_RECEIVED") & _is_true("delivery_confirmed")


def with_validation(cases: DataFrame) -> DataFrame:
    """Step 1: struct ``validation`` (valid, issues). An unknown return window is no issue."""
    issues = lines_where(
        (F.col("order_id").isNull(), NO_ORDER),
        (~F.col("within_return_window"),
         F.concat(F.lit("Outside return window ("), or_word(F.col("days_since_order"), "None"), F.lit(" days)"))),
        (F.col("item_condition") == "missing", ITEM_MISSING),
    )
    return cases.withColumn("validation", F.struct((F.size(issues) == 0).alias("valid"), issues.alias("issues")))


def with_policy(cases: DataFrame, settings: Settings) -> DataFrame:
    """Step 2: struct ``policy`` (auto_approvable, policy_flags). An unknown return window is flagged."""
    small = F.coalesce("amount", F.lit(0.0)) <= settings.auto_approve_limit
    in_window, high_value = _is_true("within_return_window"), _is_true("is_high_value")
    approvable = small & in_window & ~high_value
    flags = lines_where(
        (approvable, BELOW_LIMIT),
        (high_value, HIGH_VALUE),
        (~in_window, OUTSIDE_WINDOW),
        (F.col("reason_code") == "UNAUTHORIZED_PURCHASE", UNAUTHORIZED),
    )
    return cases.withColumn("policy", F.struct(approvable.alias("auto_approvable"), flags.alias("policy_flags")))


def with_risk(cases: DataFrame) -> DataFrame:
    """Step 3: struct ``risk`` (risk_score, risk_tier, signals)."""
    tier = F.coalesce("customer_360.risk_tier", F.lit("UNKNOWN"))
    rate = F.coalesce("customer_360.refund_rate", F.lit(0.0))
    recent = F.coalesce("customer_360.refunds_90d", F.lit(0))
    signals = lines_where(
        (tier.isin(*ABUSE_TIERS), F.concat(F.lit("Customer risk tier: "), tier)),
        (rate > 0.25, F.concat(F.lit(HIGH_RATE), percent(rate))),
        (recent > 5, F.concat(F.lit("Frequent refunder: "), recent.cast("string"), F.lit(" in 90 days"))),
        (_is_true("customer_360.coordinated_timing_flag"), COORDINATED),
        (_contradicts_delivery(), DELIVERED),
    )
    return cases.withColumn("risk", F.struct(
        F.coalesce("risk_score", F.lit(0.0)).alias("risk_score"), tier.alias("risk_tier"), signals.alias("signals")))


def with_prompt(cases: DataFrame) -> DataFrame:
    """Step 4: the question for the model as column ``prompt``, from the results of steps 1 to 3."""
    values = {
        name: or_word(F.col(name), "None")
        for name in ("refund_id", "amount", "reason_code", "product_name", "product_category", "days_since_order",
                     "item_condition")
    }
    values |= {
        "channel": or_word(F.col("channel"), "N/A"),
        "valid": true_false(F.col("validation.valid")),
        "issues": listed(F.col("validation.issues")),
        "auto_approvable": true_false(F.col("policy.auto_approvable")),
        "policy_flags": listed(F.col("policy.policy_flags")),
        "risk_score": or_word(F.col("risk.risk_score"), "None"),
        "risk_tier": F.col("risk.risk_tier"),
        "signals": listed(F.col("risk.signals")),
    }
    pieces, rest = [], PROMPT
    for name in sorted(values, key=lambda n: PROMPT.index("{" + n + "}")):
        before, rest = rest.split("{" + name + "}", 1)
        pieces += [F.lit(before), values[name]]
    return cases.withColumn("prompt", F.concat(*pieces, F.lit(rest)))


def parse_reply(raw: Column) -> Column:
    """The JSON object between the first and the last brace, or NULL if that text is not exactly one object."""
    body = F.regexp_extract(raw, r"(?s)\{.*\}", 0)
    one = F.from_json(F.concat(F.lit("["), body, F.lit("]")), f"array<{REPLY.simpleString()}>")
    return F.when((body != "") & (F.size(one) == 1), one[0])


def parse_replies(replies: DataFrame) -> DataFrame:
    """The fields of each reply, or the beginning of its text where it cannot be parsed."""
    parsed = replies.withColumn("reply", parse_reply(F.col("raw")))
    return parsed.select("refund_id", F.col("reply").isNotNull().alias("parsed"), "reply.*",
                         _beginning("reply").alias("unparsed_excerpt"))


def _beginning(reply: str) -> Column:
    return F.when(F.col(reply).isNull(), F.substring("raw", 1, REPLY_EXCERPT))


def with_replies(cases: DataFrame, replies: DataFrame | None) -> DataFrame:
    """Adds the parsed reply of each case; ``replies`` holds (refund_id, raw) with at most one row per claim."""
    if replies is None:
        return cases.withColumn(_REPLY, F.lit(None).cast(REPLY)).withColumn(_UNPARSED, F.lit(None).cast("string"))
    answers = replies.withColumn(_REPLY, parse_reply(F.col("raw"))).select(
        "refund_id", _REPLY, _beginning(_REPLY).alias(_UNPARSED))
    return cases.join(answers, "refund_id", "left")


def with_recommendation(cases: DataFrame, replies: DataFrame | None = None) -> DataFrame:
    """Step 4, answer: struct ``recommendation`` from the model's reply, or from the rules where there is none. The
    beginning of a reply that cannot be parsed stands in for the explanation and is kept as ``unparsed_excerpt``."""
    if _REPLY not in cases.columns:
        cases = with_replies(cases, replies)
    signals = F.col("risk.signals")
    explanation = F.concat(F.lit("Rule-based recommendation (LLM unavailable): "), quoted_list(signals))
    recommendation = F.struct(
        F.coalesce("_reply.action", "recommended_action", F.lit("ESCALATE")).alias("action"),
        F.coalesce("_reply.confidence", "risk.risk_score").alias("confidence"),
        F.coalesce("_reply.explanation", _UNPARSED, explanation).alias("explanation"),
        F.coalesce("_reply.key_factors", signals).alias("key_factors"),
        F.col("_reply").isNull().alias("fallback"),
        F.col(_UNPARSED).alias("unparsed_excerpt"),
    )
    return cases.withColumn("recommendation", recommendation).drop(_REPLY, _UNPARSED)


def decide(
    cases: DataFrame, profiles: DataFrame, ids: DataFrame, settings: Settings, replies: DataFrame | None = None,
    **hot: int,
) -> DataFrame:
    """All four steps for every requested case: (refund_id, validation, policy, risk, recommendation).

    Replies are joined while the cases are still partitioned by claim, before the profiles move them to their customer.
    """
    few = few_ids(ids)
    found = with_replies(cases_of(cases, ids, few), replies)
    detail = with_profile(found, cases, profiles, few is not None, **hot)
    steps = with_risk(with_policy(with_validation(detail), settings))
    return with_recommendation(steps).select(
        "refund_id", "validation", "policy", "risk", "recommendation")


def decision_audit(decisions: DataFrame) -> DataFrame:
    """One flat record per decision."""
    return decisions.select(
        "refund_id",
        F.col("risk.risk_score").alias("risk_score"),
        F.col("risk.risk_tier").alias("risk_tier"),
        F.col("recommendation.action").alias("recommended_action"),
        F.col("recommendation.confidence").alias("confidence"),
        F.size("risk.signals").cast("long").alias("num_abuse_signals"),
        F.col("validation.valid").alias("validation_passed"),
        F.col("policy.auto_approvable").alias("auto_approvable"),
        F.col("recommendation.fallback").alias("fallback"),
        F.col("recommendation.unparsed_excerpt").alias("unparsed_excerpt"),
    )


def policy_checks(cases: DataFrame) -> DataFrame:
    """Four checks per case, one row each, with a detail text."""

    def check(label: str, passed: Column, detail: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), passed.alias("passed"), detail.alias("detail"))

    def text_or(name: str, word: str) -> Column:
        return F.when(F.col(name) != "", F.col(name)).otherwise(F.lit(word))

    high_value = _is_true("is_high_value")
    window, delivery, condition, value = CHECKS
    checks = F.array(
        check(window, _is_true("within_return_window"),
              F.concat(or_word(F.col("days_since_order"), "?"), F.lit(" days since order"))),
        check(delivery, _is_true("delivery_confirmed"), text_or("delivery_issues", "No issues")),
        check(condition, F.coalesce(F.col("item_condition") != "missing", F.lit(True)),
              text_or("item_condition", "Unknown")),
        check(value, ~high_value,
              F.when(high_value, F.lit("Requires manual review")).otherwise(F.lit("Standard item"))),
    )
    return cases.select("refund_id", F.explode(checks).alias("c")).select("refund_id", "c.*")


def abuse_signals(cases: DataFrame) -> DataFrame:
    """Signals of each case with a severity, one row each; takes the output of ``case_detail``."""

    def signal(condition: Column, label: Column | str, severity: Column | str) -> Column:
        text, level = [F.lit(v) if isinstance(v, str) else v for v in (label, severity)]
        return F.when(condition, F.struct(text.alias("label"), level.alias("severity")))

    rate, recent = F.col("customer_360.refund_rate"), F.col("customer_360.refunds_90d")
    day = F.col("days_since_order")
    found = F.array_compact(F.array(
        signal(rate > 0.25, F.concat(F.lit(HIGH_RATE), percent(rate)), "high"),
        signal(recent > 5, F.concat(recent.cast("string"), F.lit(" refunds in 90 days")),
               banded([(recent > 10, "critical")], "high")),
        signal(F.col("customer_360.coordinated_timing_flag"), COORDINATED, "critical"),
        signal(_contradicts_delivery(), NO_DELIVERY, "critical"),
        signal((day > 25) & (day <= 30),
               F.concat(F.lit(GAMING), day.cast("string"), F.lit(" of 30")), "medium"),
    ))
    return cases.select("refund_id", F.explode(found).alias("s")).select("refund_id", "s.*")


def _case_context(cases: DataFrame, asked: DataFrame, *columns: str) -> DataFrame:
    return requested_cases(cases, asked).select("refund_id", *columns, F.lit(True).alias("_found"))


def action_overrides(actions: DataFrame, cases: DataFrame, **hot: int) -> DataFrame:
    """Valid actions beside what was recommended; an override differs from a recommendation that exists."""
    rows = valid_rows(check_actions(actions))
    context = _case_context(cases, rows, "recommended_action", "risk_score", "abuse_risk_tier", "amount")
    advised = F.lower(F.coalesce("recommended_action", F.lit("")))
    same_as = F.create_map(*[F.lit(w) for pair in (
        ("approve", "approved"), ("reject", "rejected"), ("escalate", "escalated")) for w in pair])
    normalised = F.coalesce(F.try_element_at(same_as, F.col("ai_recommended")), F.col("ai_recommended"))
    joined = HotKeys(rows, "refund_id", **hot).lookup(rows, context, "acted_at", "action", "reason")
    return joined.withColumn("ai_recommended", advised).select(
        "refund_id", "action", "acted_at",
        F.substring("reason", 1, EXCERPT).alias("reason_excerpt"),
        F.coalesce("_found", F.lit(False)).alias("found"),
        "ai_recommended",
        ((F.col("ai_recommended") != "") & (normalised != F.col("action"))).alias("is_override"),
        F.coalesce("risk_score", F.lit(0.0)).alias("risk_score"),
        F.coalesce("abuse_risk_tier", F.lit("")).alias("risk_tier"),
        F.coalesce("amount", F.lit(0.0)).alias("amount"),
    )


def feedback_enriched(feedback: DataFrame, cases: DataFrame, **hot: int) -> DataFrame:
    """Valid feedback beside the case it is about."""
    rows = valid_rows(check_feedback(feedback))
    words = ("abuse_risk_tier", "recommended_action", "reason_code", "channel", "product_category")
    context = _case_context(cases, rows, "customer_id", "risk_score", "amount", *words)
    joined = HotKeys(rows, "refund_id", **hot).lookup(rows, context, "submitted_at", "feedback_type", "notes")
    return joined.select(
        "refund_id", "feedback_type", "submitted_at",
        F.substring("notes", 1, EXCERPT).alias("notes_excerpt"),
        F.coalesce("_found", F.lit(False)).alias("found"),
        "customer_id",
        F.coalesce("risk_score", F.lit(0.0)).alias("risk_score"),
        F.coalesce("amount", F.lit(0.0)).alias("amount"),
        *[F.coalesce(word, F.lit("")).alias(word) for word in words],
    )
