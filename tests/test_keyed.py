"""Keyed joins give what plain joins give, whichever keys count as hot."""

import random

import pytest
from pyspark.sql import functions as F

from claimsift.operators.keyed import HotKeys, first_per_key

HOT = dict(min_rows=5, salts=4)


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(7)
    keys = [1] * 40 + [2] * 6 + [None] * 9 + [rng.randrange(3, 15) for _ in range(25)]
    many = spark.createDataFrame([(k, i, f"m{i}") for i, k in enumerate(keys)], "k long, id long, m string")
    left = spark.createDataFrame(
        [(k, f"l{i}") for i, k in enumerate([1, 1, 2, 3, 4, 5, 5, 99, 100, None, None])], "k long, l string")
    lookup = spark.createDataFrame([(k, f"u{k}") for k in (1, 2, 4, 99)], "k long, u string")
    return left, many, lookup


def rows(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_hot_keys_are_found(sides):
    _, many, _ = sides
    assert {1, 2} <= set(HotKeys(many, "k", **HOT).keys)


def test_an_empty_table_has_no_hot_key(sides):
    _, many, _ = sides
    assert HotKeys(many.filter("id < 0"), "k", min_rows=0).keys == []


def test_inner(sides):
    left, many, _ = sides
    got = HotKeys(many, "k", **HOT).inner(left, many, "id")
    assert rows(got, "k", "l", "m") == rows(left.join(many, "k"), "k", "l", "m")


def test_left_with_lookups(sides):
    left, many, lookup = sides
    got = HotKeys(many, "k", **HOT).left(left, many, "id", lookup)
    plain = left.join(lookup, "k", "left").join(many, "k", "left")
    assert rows(got, "k", "l", "u", "m") == rows(plain, "k", "l", "u", "m")


def test_lookup(sides):
    _, many, lookup = sides
    got = HotKeys(many, "k", **HOT).lookup(many, lookup, "id")
    assert rows(got, "k", "m", "u") == rows(many.join(lookup, "k", "left"), "k", "m", "u")
    assert got.columns == ["k", "id", "m", "u"]


def test_hot_key_rows_are_spread(sides):
    _, many, _ = sides
    salted = HotKeys(many, "k", **HOT)._salted(many, ("id",))
    per_key = {row.k: row.n for row in salted.groupBy("k").agg(F.countDistinct("_salt").alias("n")).collect()}
    assert per_key[1] == 4 and per_key[None] > 1


def test_no_key_is_hot_by_default(sides):
    left, many, _ = sides
    plain = HotKeys(many, "k")
    assert plain.keys == []
    assert rows(plain.left(left, many, "id"), "k", "m") == rows(left.join(many, "k", "left"), "k", "m")
    assert "_salt" not in plain.left(left, many, "id")._jdf.queryExecution().toString()
    assert "_salt" not in plain.lookup(many, left, "id")._jdf.queryExecution().toString()


def test_only_missing_keys_are_hot(sides):
    _, many, lookup = sides
    some = many.filter("k IS NULL OR k > 2")
    spread = HotKeys(some, "k", min_rows=9, salts=4)
    assert spread.keys == []
    got = spread.lookup(some, lookup, "id")
    assert "_salt" in got._jdf.queryExecution().toString()
    assert rows(got, "k", "m", "u") == rows(some.join(lookup, "k", "left"), "k", "m", "u")


def test_first_per_key_is_limited_before_the_shuffle(spark, sides):
    _, many, _ = sides
    first = first_per_key(many, ["k"], F.desc("id"))
    expected = {row.k: row.id for row in many.groupBy("k").agg(F.max("id").alias("id")).collect()}
    assert {row.k: row.id for row in first.collect()} == expected
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
