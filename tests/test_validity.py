"""Versions valid at a moment, against a search by hand, and stable keys over two loads of a lake."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockpond.operators import merge_history, valid_version
from stockpond.plans import lake as runs
from stockpond.sources import read_layer
from tests.test_files import lake, put  # noqa: F401
from stockpond.contracts import source_table

DAY = dt.datetime(2020, 1, 1)


def by_hand(key, at, versions):
    own = sorted((v for v in versions if v[0] == key), key=lambda v: (v[1] is not None, v[1] or DAY, v[2]))
    if not own or key is None:
        return None
    if at is None:
        return own[-1][2]
    found = own[0][2]
    for _, since, name in own[1:]:
        if since is not None and since <= at or since is None:
            found = name
    return found


def test_against_a_search_by_hand(spark, plan_of):
    rng = random.Random(1)
    versions = [(rng.choice("abcde"), None if rng.random() < 0.05 else DAY + dt.timedelta(days=rng.randrange(-900, 900)), n)
                for n in range(60)]
    versions.append((None, DAY, 99))
    rows = [(n, rng.choice(["a", "b", "c", "d", "e", "x", None]),
             None if rng.random() < 0.1 else DAY + dt.timedelta(hours=rng.randrange(-30000, 30000))) for n in range(400)]
    history = spark.createDataFrame(versions, "k string, effective_from timestamp, version int")
    df = spark.createDataFrame(rows, "n int, k string, at timestamp")
    found = valid_version(df, history, "k", "at", ["version"])
    assert found.columns == ["n", "k", "at", "version"]
    got = {r.n: r.version for r in found.collect()}
    want = {n: by_hand(k, at, versions) for n, k, at in rows}
    assert got == {n: v for n, v in want.items() if v is not None}
    text = plan_of(found)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_empty_sides_and_rows_without_moments(spark):
    history = spark.createDataFrame([("a", DAY, 1), ("a", DAY + dt.timedelta(days=9), 2)], "k string, effective_from timestamp, version int")
    df = spark.createDataFrame([(1, "a", None)], "n int, k string, at timestamp")
    assert [r.version for r in valid_version(df, history, "k", "at", ["version"]).collect()] == [2]
    assert valid_version(df.where("n > 1"), history, "k", "at", ["version"]).isEmpty()
    assert valid_version(df, history.where("version > 5"), "k", "at", ["version"]).isEmpty()


def test_deliveries_that_contradict_themselves(spark):
    history = spark.createDataFrame([(1, "a", "x", DAY, None, True)],
                                    "id int, k string, v string, effective_from timestamp, effective_to timestamp, is_current boolean")
    twice = spark.createDataFrame([("a", "y"), ("a", "z")], "k string, v string")
    with pytest.raises(Exception, match="two rows of one member"):
        merge_history(history, twice, "k", "id", ["v"], "2021-01-01").collect()
    with pytest.raises(Exception, match="older than the version"):
        merge_history(history, twice.limit(1), "k", "id", ["v"], "2019-01-01").collect()


def test_keys_stay_and_sales_keep_their_versions(spark, lake):  # noqa: F811
    runs.run_bronze(spark, lake)
    runs.run_silver(spark, lake, as_of="2024-03-01")
    reports = runs.run_gold(spark, lake, as_of="2024-03-01", effective="2024-03-01")
    assert reports["fact_sales"].rows == 3 and reports["dim_product_history"].rows == 2
    first = {r.product_id: r.product_key for r in read_layer(spark, lake.path("gold", "dim_product")).collect()}
    assert first == {"P1": 1, "P2": 2}

    # a new product that sorts first, another cost of P1, and an order after the change
    put(Path(lake.path("raw", "products")), "later.csv", ",".join(source_table("products").columns) + "\n"
        "P0,s0,Zero,,Books,,B,10,4,5,True,2024-03-02\nP1,s1,One,,Books,,B,10,6,5,True,2023-01-01\n")
    put(Path(lake.path("raw", "orders")), "later.csv", ",".join(source_table("orders").columns)
        + "\nO3,C1,2024-03-05T10:00:00,pending,paypal,10,1,0,0,11,EUR,de,Berlin\n")
    put(Path(lake.path("raw", "order_items")), "later.csv", ",".join(source_table("order_items").columns)
        + "\nI4,O3,P1,1,10,0,10\n")
    for folder in ("products", "orders", "order_items"):
        for old in Path(lake.path("raw", folder)).glob(f"{folder}.csv"):
            old.rename(old.with_suffix(".done"))
    runs.run_bronze(spark, lake, ["products", "orders", "order_items"], match_pattern=False)
    runs.run_silver(spark, lake, as_of="2024-03-06")
    runs.run_gold(spark, lake, as_of="2024-03-06", effective="2024-03-02")
    dims = {r.product_id: r.product_key for r in read_layer(spark, lake.path("gold", "dim_product")).collect()}
    assert dims["P2"] == 2 and sorted(dims.values()) == [2, *sorted({3, 4})] and len(set(dims.values())) == 3
    fact = {r.order_item_id: r for r in read_layer(spark, lake.path("gold", "fact_sales")).collect()}
    assert (fact["I1"].product_key, fact["I1"].cost_of_goods) == (1, 4.0)
    assert (fact["I4"].product_key, fact["I4"].cost_of_goods) == (dims["P1"], 6.0)
    keys = {r.customer_id: r.customer_key for r in read_layer(spark, lake.path("gold", "dim_customer")).collect()}
    assert keys == {"C1": 1, "C2": 2}


def test_versions_are_not_broadcast_however_small_their_files(spark, plan_of, tmp_path):
    """Repeated per year they are many times the size of the stored history, on the driver as well."""
    spark.createDataFrame([("a", DAY, None, True, 1)], "k string, effective_from timestamp, effective_to timestamp, is_current boolean, id int").write.parquet(str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h"))
    spark.createDataFrame([("a", DAY, "x")], "k string, at timestamp, v string").write.parquet(str(tmp_path / "r"))
    rows = spark.read.parquet(str(tmp_path / "r"))
    plan = plan_of(valid_version(rows, history, "k", "at", ["id"]))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    merged = merge_history(history.withColumn("v", F.lit("w")), rows, "k", "id", ["v"], "2021-01-01")
    assert plan_of(merged).count("SortMergeJoin") >= 2
    assert sorted((r.k, r.v, r.is_current) for r in merged.collect()) == [("a", "w", False), ("a", "x", True)]
