"""Numbers that come out the same whatever the order of the rows.

Money and scores are stored as doubles, but sums of doubles depend on the order in which partitions arrive. Sums
therefore run on whole cents and whole thousandths as long integers, which is also twice as fast as wide decimals. Each
amount is rounded to whole cents before it is summed, so fractions of a cent count as the nearest cent. Amounts of a
million and more are added as decimals beside them, those beyond any decimal as doubles; NaN and infinities have no sum and
are dropped and counted by a quality rule. Rounding works on a decimal so that ties are decided exactly; values too large
for it, NaN and infinities are rounded as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = 100
SCORE = 1000
EXACT = "decimal(18,9)"
#: From here on amounts are added as decimals, and from the second bound on as doubles.
WIDE, WIDEST = 1e6, 1e25


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_to(value: Column | str, digits: int) -> Column:
    exact = F.round(_col(value).try_cast(EXACT), digits).cast("double")
    return F.coalesce(exact, F.round(_col(value).cast("double"), digits))


def parts_to_sum(value: Column | str, units: int = MONEY) -> list[Column]:
    """``value`` as a whole number of hundredths (or of the given ``units`` per one), as a decimal or as a double, two of
    which are NULL; sums of the three make up one of ``combined``."""
    amount = _col(value).cast("double")
    size = F.abs(amount)
    return [
        F.when(size < WIDE, F.rint(amount * F.lit(float(units)))).cast("long"),
        F.when((size >= WIDE) & (size < WIDEST), amount).cast("decimal(28,3)"),
        F.when(size >= WIDEST, amount),
    ]


def combined(small: Column, wide: Column, widest: Column, units: int = MONEY) -> Column:
    """The number whose parts were summed; NULL if all are."""
    exact = F.coalesce(small, F.lit(0)).cast("decimal(20,0)") / F.lit(units) + wide
    total = F.when(wide.isNull(), small / F.lit(float(units))).otherwise(exact.cast("double"))
    return F.when(widest.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + widest)


def exact_sum(value: Column | str, units: int = MONEY) -> Column:
    if units == SCORE:  # scores are at most 1, so whole thousandths do
        return F.sum(F.rint(_col(value) * F.lit(float(units))).cast("long")) / F.lit(float(units))
    return combined(*[F.sum(part) for part in parts_to_sum(value, units)], units)


def sum_where(condition: Column, value: Column | str, units: int = MONEY) -> Column:
    """Sum of ``value`` over the rows that meet ``condition``; the others count as zero."""
    return exact_sum(F.when(condition, _col(value)).otherwise(F.lit(0.0)), units)


def count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0))).cast("long")


def ratio(part: Column, whole: Column, digits: int = 3, scale: float = 1.0) -> Column:
    """``scale * part / whole`` rounded, 0.0 for an empty whole (ANSI division by zero would raise)."""
    value = part.cast("double") / whole.cast("double")
    if scale != 1.0:
        value = value * F.lit(scale)
    return F.when(whole > 0, round_to(value, digits)).otherwise(F.lit(0.0))
