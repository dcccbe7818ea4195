"""Parameters of a scoring run.

Everything a run depends on besides its tables lives here: the as-of date that the rolling windows count back from,
the weights of the risk score and the thresholds of the bands.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# The weight of each component in the composite risk score, in the order in which they are added.
SCORE_WEIGHTS = {
    "refund_rate_score": 0.25,
    "frequency_score": 0.20,
    "amount_score": 0.15,
    "household_score": 0.15,
    "delivery_score": 0.15,
    "policy_score": 0.10,
}

# Accepted reviewer actions, feedback types and the tiers a reviewer watches.
ACTIONS = ("approved", "rejected", "escalated")
FEEDBACK_TYPES = ("false_positive", "missed_abuse")
ABUSE_TIERS = ("HIGH", "CRITICAL")

# Score tiers from the most to the least severe.
SCORE_TIERS = ("CRITICAL", "HIGH", "MEDIUM", "LOW")


@dataclass(frozen=True)
class Settings:
    """Settings of one run; ``as_of`` is the day that plays the role of today.

    ``hot_keys`` overrides when and how far the rows of a key are spread: ``min_rows`` and ``salts`` of ``HotKeys``.
    """

    as_of: dt.date
    short_window_days: int = 30
    long_window_days: int = 90
    default_return_window: int = 30
    coordination_hours: int = 48
    auto_approve_limit: float = 25.0
    weights: dict[str, float] = field(default_factory=lambda: dict(SCORE_WEIGHTS))
    hot_keys: dict[str, int] = field(default_factory=dict)

    @classmethod
    def today(cls) -> "Settings":
        return cls(as_of=dt.date.today())
