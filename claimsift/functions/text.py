"""Text built from columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def percent(rate: Column) -> Column:
    """A rate as a percentage with one decimal, e.g. 0.405 -> ``40.5%``."""
    return F.concat((rate * 100).cast("decimal(18,1)").cast("string"), F.lit("%"))


def or_word(value: Column, word: str) -> Column:
    """``value`` as text, or ``word`` where it is NULL."""
    return F.coalesce(value.cast("string"), F.lit(word))


def true_false(value: Column) -> Column:
    return F.when(value, F.lit("True")).otherwise(F.lit("False"))


def listed(items: Column, empty: str = "None") -> Column:
    """Items separated by commas, or ``empty`` if there are none."""
    return F.when(F.size(items) > 0, F.array_join(items, ", ")).otherwise(F.lit(empty))


def quoted_list(items: Column) -> Column:
    """Items in single quotes within brackets: ``['a', 'b']``."""
    quoted = F.transform(items, lambda item: F.concat(F.lit("'"), item, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def lines_where(*rules: tuple[Column, Column | str]) -> Column:
    """Array of the texts whose condition holds, in the order given."""
    texts = [F.when(condition, F.lit(text) if isinstance(text, str) else text) for condition, text in rules]
    return F.array_compact(F.array(*texts))


def named_uuid(name: Column) -> Column:
    """A UUID that follows from a name, laid out as version 5: the same name always gives the same one."""
    h = F.sha1(name)
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))
