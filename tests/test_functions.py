"""Column functions."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from stockpond.functions import (
    add_amounts,
    clean_code,
    customer_segment,
    customer_status,
    date_key,
    email_domain,
    is_valid_email,
    money,
    parse_flag,
    parse_timestamp,
    percent_of,
    person_name,
    price_tier,
    stock_status,
    sum_cents,
    sum_exact,
    value_tier,
    within_cent,
)
from stockpond.functions.bands import behavior_segment


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_money_rounds_half_cents_up_despite_binary_noise(spark):
    odd = [(float("nan"),), (float("inf"),), (1e300,), (-0.001,)]
    assert values(spark, odd, "x double", money("x")) == [None, None, None, 0.0]
    rows = [(0.335 * 3,), (1.005,), (2.675,), (-1.005,), (41.666,), (None,)]
    assert values(spark, rows, "x double", money("x")) == [1.01, 1.01, 2.68, -1.01, 41.67, None]


def test_percent_of_needs_a_positive_whole(spark):
    rows = [(249.99, 599.99), (1.0, 0.0), (1.0, None), (None, 5.0), (-5.0, 10.0), (1.0, -2.0)]
    assert values(spark, rows, "a double, b double", percent_of("a", "b")) == [41.67, 0.0, 0.0, None, -50.0, 0.0]


@pytest.mark.parametrize("difference, expected", [(0.0, True), (0.005, True), (0.01, False), (0.02, False), (None, None)])
def test_within_cent(spark, difference, expected):
    other = None if difference is None else 100.1 + difference
    assert values(spark, [(100.1, other)], "a double, b double", within_cent("a", "b")) == [expected]


def test_sums_do_not_depend_on_order(spark):
    rows = [(0.1,), (0.2,), (0.3,), (1e9,), (-1e9,), (None,)]
    df = spark.createDataFrame(rows, "x double")
    assert df.agg(sum_exact("x"), sum_cents("x")).first()[:] == (0.6, 0.6)
    assert df.where("x is null").agg(sum_exact("x"), sum_cents("x")).first()[:] == (None, None)


def test_email_parts(spark):
    rows = [("a.b@example.com",), ("no-at",), ("a@b@c.com",), (None,), ("x@y",)]
    df = spark.createDataFrame(rows, "e string").select(email_domain(F.col("e")), is_valid_email(F.col("e")))
    assert [tuple(r) for r in df.collect()] == [
        ("example.com", True), ("", False), ("b@c.com", False), (None, None), ("y", False)
    ]


def test_text_cleaning(spark):
    df = spark.createDataFrame([(" De ", " john ", "DOE"), (None, None, "o'neil mc-donald")], "c string, f string, l string")
    got = df.select(clean_code("c"), clean_code("c", "upper"), person_name("f", "l")).collect()
    assert [tuple(r) for r in got] == [("de", "DE", "John Doe"), (None, None, "O'neil Mc-donald")]


def test_flags(spark):
    rows = [("True",), ("YES",), ("1",), ("0",), ("false",), ("y",), (None,)]
    assert values(spark, rows, "x string", parse_flag("x")) == [True, True, True, False, False, False, False]


def test_timestamps_and_date_keys(spark):
    rows = [("2023-12-01T10:30:00",), ("2023-12-01",), ("bad",), ("",), (None,)]
    got = values(spark, rows, "x string", parse_timestamp("x"))
    assert got == [dt.datetime(2023, 12, 1, 10, 30), dt.datetime(2023, 12, 1), None, None, None]
    assert values(spark, rows, "x string", date_key(parse_timestamp("x"))) == [20231201, 20231201, None, None, None]


@pytest.mark.parametrize("band, kind, cases", [
    (value_tier, "double", [(None, "bronze"), (99.99, "bronze"), (100.0, "silver"), (499.99, "silver"), (500.0, "gold"),
                            (999.99, "gold"), (1000.0, "platinum")]),
    (price_tier, "double", [(None, "economy"), (24.99, "economy"), (25.0, "budget"), (99.99, "budget"),
                            (100.0, "mid_range"), (499.99, "mid_range"), (500.0, "premium")]),
    (stock_status, "int", [(None, "well_stocked"), (0, "out_of_stock"), (9, "low_stock"), (10, "normal"),
                           (49, "normal"), (50, "well_stocked"), (-1, "low_stock")]),
    (customer_segment, "int", [(None, "established"), (29, "new"), (30, "regular"), (364, "regular"),
                               (365, "established")]),
])
def test_bands(spark, band, kind, cases):
    got = values(spark, [(value,) for value, _ in cases], f"x {kind}", band(F.col("x")))
    assert got == [label for _, label in cases]


def test_customer_status_and_behavior(spark):
    rows = [(None, None), (1, 90), (1, 91), (1, 365), (1, 366), (2, None)]
    got = values(spark, rows, "n long, idle int", customer_status(F.col("n"), F.col("idle")))
    assert got == ["prospect", "active", "at_risk", "at_risk", "churned", "active"]
    rows = [("churned", "platinum", "new"), ("active", "platinum", "new"), ("active", "gold", "new"),
            ("prospect", "bronze", "established")]
    got = values(spark, rows, "a string, b string, c string", behavior_segment(F.col("a"), F.col("b"), F.col("c")))
    assert got == ["inactive", "vip", "new", "regular"]


def test_money_beyond_nine_trillion(spark):
    rows = [(9.3e12 + 0.37,), (-9.3e12 - 0.37,), (1.5e15,), (123456789.125,), (1e26,), (1e31,)]
    assert values(spark, rows, "x double", money("x")) == [
        9300000000000.37, -9300000000000.37, 1.5e15, 123456789.13, 1e26, None]
    df = spark.createDataFrame([(9.3e12,), (2e20,), (0.25,), (-1e9,), (float("nan"),), (None,)], "x double")
    assert df.agg(sum_exact("x"), sum_cents("x")).first()[:] == (2e20 + 9.299e12, 2e20 + 9.299e12)
    assert values(spark, [(1e13, 1e13), (1e13, 1e13 + 1), (1e13, 5.0)], "a double, b double", within_cent("a", "b")) == [
        True, False, False]
    assert values(spark, [(1e13, 0.25), (0.1, 0.2), (1.0, None)], "a double, b double", add_amounts(["a", "b"], ["a"])) == [
        0.25, 0.2, None]


def test_ratios_are_rounded_once(spark):
    rows = [(0.0049999996,), (0.0149999999,), (33.3349999997,), (0.005,), (-0.0149999999,)]
    assert values(spark, rows, "x double", money("x")) == [0.0, 0.01, 33.33, 0.01, -0.01]
    assert list(map(repr, values(spark, [(-0.001,), (-0.0,)], "x double", money("x")))) == ["0.0", "0.0"]
    halves = [(k + 0.005 * s,) for k in (0, 7, 1234, 99_999, 8_765_432) for s in (1, -1)]
    exact = [float((Decimal(str(x)) * 100).quantize(0, ROUND_HALF_UP)) / 100 for x, in halves]
    assert values(spark, halves, "x double", money("x")) == exact
