"""Keyed building blocks that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

SALT = "_salt"
_MATCH = "_match"


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of every key.

    Spark turns the rank filter into a group limit that already runs before the shuffle, so each map task sends at
    most one row per key and a hot key costs no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


@dataclass(frozen=True)
class HotKeys:
    """Joins that spread the rows of hot keys over several partitions.

    Adaptive skew handling needs both inputs straight from a shuffle and never splits the right side of a left join.
    Here the side with ``many`` rows per key gets a salt from a hash of given columns where its key is hot, the other
    side is repeated once per salt for those keys only, and both are joined on key and salt. The result is exact
    whichever keys are taken as hot; where none is, these are plain joins.

    Hot keys come from a frequent-items sketch over ``counted_on`` (a stored table): one narrow pass without a shuffle,
    run when the join is built. At most ``tracked`` keys are brought to the driver, whatever the size of the data. The
    sketch is only approximate, so it must not be evaluated once per side: both sides have to agree on the keys.
    """

    counted_on: DataFrame
    key: str
    min_rows: int = 1_000_000
    salts: int = 32
    tracked: int = 1_000

    @cached_property
    def _counts(self) -> Row:
        sketch = f"approx_top_k({self.key}, {self.tracked}, {10 * self.tracked})"
        known = f"{self.key} IS NOT NULL"
        return self.counted_on.agg(
            F.expr(f"{sketch} FILTER (WHERE {known})").alias("top"), F.expr(f"count_if(NOT {known})").alias("missing"),
        ).collect()[0]

    @cached_property
    def keys(self) -> list:
        return [top["item"] for top in self._counts["top"] or [] if top["count"] >= self.min_rows]

    def _is_hot(self) -> Column:
        return F.coalesce(F.col(self.key).isin(self.keys), F.lit(False))

    def _salted(self, many: DataFrame, spread_by: tuple[str, ...]) -> DataFrame:
        """NULL keys never match, so their rows are spread as well."""
        salt = F.when(self._is_hot() | F.col(self.key).isNull(), F.pmod(F.xxhash64(*spread_by), F.lit(self.salts)))
        return many.withColumn(SALT, salt.otherwise(F.lit(0)).cast("int"))

    def _repeated(self, other: DataFrame) -> DataFrame:
        every = F.sequence(F.lit(0), F.lit(self.salts - 1))
        return other.withColumn(SALT, F.explode(F.when(self._is_hot(), every).otherwise(F.array(F.lit(0)))))

    def lookup(self, many: DataFrame, table: DataFrame, *spread_by: str) -> DataFrame:
        """``many`` left join ``table``."""
        if not self.keys and self._counts["missing"] < self.min_rows:
            return many.join(table, self.key, "left")
        return self._salted(many, spread_by).join(self._repeated(table), [self.key, SALT], "left").drop(SALT)

    def inner(self, other: DataFrame, many: DataFrame, *spread_by: str) -> DataFrame:
        """``other`` inner join ``many``."""
        if not self.keys:
            return other.join(many, self.key)
        return self._repeated(other).join(self._salted(many, spread_by), [self.key, SALT]).drop(SALT)

    def left(self, other: DataFrame, many: DataFrame, spread_by: str, *lookups: DataFrame) -> DataFrame:
        """``other`` left join each lookup (unique per key), then left join ``many``, all on one partitioning.

        ``many`` must hold every key of ``counted_on``: a hot key then has rows in it, so an unmatched repeat of one is
        an artefact and is dropped.
        """
        if not self.keys:
            return reduce(lambda joined, table: joined.join(table, self.key, "left"), (*lookups, many), other)
        joined = self._repeated(other)
        for table in lookups:
            joined = joined.join(self._repeated(table), [self.key, SALT], "left")
        right = self._salted(many, (spread_by,)).withColumn(_MATCH, F.lit(True))
        joined = joined.join(right, [self.key, SALT], "left")
        return joined.filter(~(self._is_hot() & F.col(_MATCH).isNull())).drop(SALT, _MATCH)
