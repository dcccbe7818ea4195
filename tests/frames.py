"""Small frames with the schemas of the source tables; columns left out are NULL."""

import datetime as dt

from claimsift.schemas import LIVE_CASES, SOURCES
from claimsift.settings import Settings

AS_OF = dt.date(2025, 3, 31)
SETTINGS = Settings(as_of=AS_OF)


def day(n: int) -> dt.date:
    """``n`` days before the as-of date."""
    return AS_OF - dt.timedelta(days=n)


def frame(spark, schema, rows):
    names = schema.fieldNames()
    for row in rows:
        assert set(row) <= set(names), row
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def source(spark, table, *rows):
    return frame(spark, SOURCES[table], rows)


def live(spark, *rows):
    return frame(spark, LIVE_CASES, rows)
