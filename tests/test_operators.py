"""Operators against brute force on small tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from stockpond.operators import (
    cast_columns,
    drop_incomplete,
    earliest_per_key,
    latest_per_key,
    merge_history,
    missing_keys,
    number_rows,
    number_rows_sparse,
    rank_within,
    salted_join,
    skew_join,
    stamp_lineage,
    top_per_group,
    trim_columns,
)
from stockpond.operators.joins import hot_keys


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def skewed(spark):
    """2,000 rows, more than a third of them with one key, some without any."""
    rng = random.Random(7)
    keys = ["hot"] * 800 + [None] * 100 + [f"k{rng.randrange(200)}" for _ in range(1100)]
    rows = [(i, key, rng.randrange(50)) for i, key in enumerate(keys)]
    rng.shuffle(rows)
    return table(spark, rows, "id long, k string, v int").repartition(6)


def test_cast_and_trim_skip_absent_columns(spark):
    df = table(spark, [("1", " a "), ("x", None)], "n string, t string")
    got = trim_columns(cast_columns(df, {"n": "int", "zzz": "int"}), ["t", "zzz"]).collect()
    assert [tuple(r) for r in got] == [(1, "a"), (None, None)]


def test_drop_incomplete_reports_what_it_dropped(spark, tmp_path):
    df = table(spark, [(1, "a"), (None, "b"), (2, None), (3, "c")], "n int, t string")
    observed = Observation()
    assert drop_incomplete(df, ["n", "t"], observed).count() == 2
    assert observed.get == {"rows_read": 4, "rows_dropped": 2}
    assert drop_incomplete(df, ["n"]).count() == 3


def test_stamp_lineage(spark):
    row = stamp_lineage(spark.range(1), "somewhere", date_column="_processing_date").first()
    assert row["_source_file"] == "somewhere" and row["_processing_date"] == row["_ingested_at"].date()


def test_dedup_matches_brute_force_and_is_idempotent(skewed):
    latest = latest_per_key(skewed, ["k"], ["v"])
    expected = {}
    for row in skewed.collect():
        if row.k not in expected or (row.v, row.id) > (expected[row.k].v, expected[row.k].id):
            expected[row.k] = row
    assert {r.k: tuple(r) for r in latest.collect()} == {k: tuple(r) for k, r in expected.items()}
    assert latest_per_key(latest, ["k"], ["v"]).exceptAll(latest).isEmpty()


def test_dedup_earliest_puts_missing_last(spark):
    df = table(spark, [("a", None), ("a", 2), ("a", 1), ("b", None)], "k string, v int")
    assert sorted(tuple(r) for r in earliest_per_key(df, ["k"], ["v"]).collect()) == [("a", 1), ("b", None)]


def test_numbering_equals_the_global_window(skewed):
    order = ["k", "id"]
    numbered = number_rows(skewed, "n", order)
    expected = skewed.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("n"), "id", "k", "v")
    assert numbered.columns == ["n", "id", "k", "v"]
    assert sorted(numbered.select("n", "id").collect()) == sorted(expected.select("n", "id").collect())


def test_numbering_descending_and_after_an_offset(spark):
    df = table(spark, [(i,) for i in range(100)], "v int").repartition(5)
    got = {r.v: r.n for r in number_rows(df, "n", [F.col("v").desc()], after=1000).collect()}
    assert got == {v: 1100 - v for v in range(100)}


def test_numbering_gives_the_same_keys_to_every_reader(skewed):
    numbered = number_rows(skewed, "n")
    assert numbered.exceptAll(numbered).isEmpty()
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 2001))
    assert {(r.n, r.id) for r in numbered.collect()} == {(r.n, r.id) for r in numbered.collect()}


def test_numbering_cuts_through_equal_rows(spark):
    """Copies of one key are numbered by several tasks, and ahead of the greater keys."""
    rows = spark.range(0, 6000, 1, 6).select(F.when(F.col("id") % 3 == 0, "z").otherwise("hot").alias("k"))
    numbered = number_rows(rows, "n", ["k"], ties=True)
    got = sorted((r.n, r.k) for r in numbered.collect())
    assert [n for n, _ in got] == list(range(1, 6001))
    assert [k for _, k in got] == ["hot"] * 4000 + ["z"] * 2000


def test_numbering_an_empty_table(spark):
    assert number_rows(spark.range(0), "n", ["id"]).collect() == []


def test_sparse_numbers_are_unique_and_stable(skewed):
    numbered = number_rows_sparse(skewed, "n")
    first = {(r.n, r.id) for r in numbered.collect()}
    assert first == {(r.n, r.id) for r in numbered.collect()} and len({n for n, _ in first}) == 2000
    assert min(n for n, _ in first) >= 1


def test_rank_within_equals_the_window_even_for_a_hot_group(skewed):
    order = [F.col("v").desc(), F.col("id")]
    ranked = rank_within(skewed, ["k"], order, "rank")
    window = Window.partitionBy("k").orderBy(*order)
    expected = skewed.select("id", F.row_number().over(window).cast("bigint").alias("rank"))
    assert sorted(ranked.select("id", "rank").collect()) == sorted(expected.collect())


def test_top_per_group(skewed):
    top = top_per_group(skewed.where("k is not null"), ["k"], [F.col("v").desc(), F.col("id")], 3, "rank")
    ranked = rank_within(skewed.where("k is not null"), ["k"], [F.col("v").desc(), F.col("id")], "rank")
    assert sorted(top.select("id", "rank").collect()) == sorted(ranked.where("rank <= 3").select("id", "rank").collect())


def test_hot_keys_are_found(skewed):
    assert [r.k for r in hot_keys(skewed, "k", 0.05).collect()] == ["hot"]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_the_plain_join(skewed, spark, how):
    lookup = table(spark, [("hot", 1), *[(f"k{i}", i) for i in range(0, 200, 2)]], "k string, w int")
    salted = salted_join(skewed, lookup, "k", how, share=0.05, salts=8)
    plain = skewed.join(lookup, "k", how)
    assert sorted(salted.select("id", "w").collect(), key=str) == sorted(plain.select("id", "w").collect(), key=str)


def test_salted_join_repeats_several_matches(spark):
    left = table(spark, [("a",)] * 50 + [("b",)], "k string")
    right = table(spark, [("a", 1), ("a", 2), ("b", 3)], "k string, w int")
    got = salted_join(left, right, "k", share=0.5, salts=4).groupBy("k", "w").count().collect()
    assert sorted(tuple(r) for r in got) == [("a", 1, 50), ("a", 2, 50), ("b", 3, 1)]
    with pytest.raises(ValueError):
        salted_join(left, right, "k", "full")


@pytest.mark.parametrize("limit", [10_000, 0])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_the_plain_join(skewed, spark, how, limit):
    lookup = table(spark, [("hot", 1), ("hot", 2), (None, 3), *[(f"k{i}", i) for i in range(0, 200, 2)]], "k string, w int")
    met, plain = skew_join(skewed, lookup, "k", how, share=0.05, broadcast_rows=limit, salts=8), skewed.join(lookup, "k", how)
    assert met.columns == plain.columns
    assert sorted(met.collect(), key=str) == sorted(plain.collect(), key=str)
    assert skew_join(skewed.limit(0), lookup, "k", how).isEmpty()
    with pytest.raises(ValueError):
        skew_join(skewed, lookup, "k", "full")


@pytest.mark.parametrize("limit", [10_000, 0])
def test_skew_join_spreads_equal_rows(spark, tmp_path, limit):
    """Three of ten lines on one order, all equal: no task gets more than twice the mean."""
    rows = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 10 < 3, 1).otherwise(F.col("id")).alias("k"), F.lit(7).alias("v"))
    rows.write.parquet(str(tmp_path / "lines"))
    lines, orders = spark.read.parquet(str(tmp_path / "lines")), spark.range(200_000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        met = skew_join(lines, orders, "k", share=0.05, broadcast_rows=limit)
        sizes = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
        plain = [r["count"] for r in lines.join(orders, "k").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == sum(plain) == 200_000
    assert max(sizes) < 2 * sum(sizes) / len(sizes) and max(sizes) < max(plain) / 1.5


def test_missing_keys_count_null_once(spark):
    left = table(spark, [("a",), ("x",), ("x",), (None,), (None,)], "fk string")
    right = table(spark, [("a",), ("a",), (None,)], "pk string")
    assert sorted((r.fk for r in missing_keys(left, "fk", right, "pk").collect()), key=str) == [None, "x"]


def history(spark, rows):
    return table(spark, rows, "key long, id string, city string, size int, effective_from date, effective_to date, "
                              "is_current boolean").withColumns({
        c: F.col(c).cast("date") for c in ("effective_from", "effective_to")
    })


def test_history_opens_closes_and_keeps(spark):
    import datetime as dt

    start, closed, moment = dt.date(2020, 1, 1), dt.date(2021, 1, 1), dt.date(2024, 3, 1)
    dimension = history(spark, [
        (1, "same", "x", None, start, None, True),
        (2, "moved", "x", 1, start, closed, False),
        (3, "moved", "y", 1, closed, None, True),
        (4, "absent", "x", 1, start, None, True),
        (5, "gained", None, 1, start, None, True),
    ])
    incoming = table(spark, [("same", "x", None), ("moved", "z", 1), ("gained", "c", 1), ("new", "n", 2)],
                     "id string, city string, size int")
    merged = merge_history(dimension, incoming, "id", "key", ["city", "size"], "2024-03-01")
    assert sorted(tuple(r) for r in merged.collect()) == [
        (1, "same", "x", None, start, None, True),
        (2, "moved", "x", 1, start, closed, False),
        (3, "moved", "y", 1, closed, moment, False),
        (4, "absent", "x", 1, start, None, True),
        (5, "gained", None, 1, start, moment, False),
        (6, "gained", "c", 1, moment, None, True),
        (7, "moved", "z", 1, moment, None, True),
        (8, "new", "n", 2, moment, None, True),
    ]
    again = merge_history(merged, incoming, "id", "key", ["city", "size"], "2024-03-02")
    assert sorted(again.collect()) == sorted(merged.collect())


def test_history_keeps_one_version_of_the_null_member(spark):
    incoming = table(spark, [(None, "x", 1)], "id string, city string, size int")
    once = merge_history(history(spark, []), incoming, "id", "key", ["city", "size"], "2024-03-01")
    again = merge_history(once, incoming, "id", "key", ["city", "size"], "2024-03-02")
    assert [(r.key, r.id, r.is_current) for r in again.collect()] == [(1, None, True)]
    moved = merge_history(again, table(spark, [(None, "y", 1)], "id string, city string, size int"),
                          "id", "key", ["city", "size"], "2024-03-03")
    assert sorted((r.key, r.city, r.is_current) for r in moved.collect()) == [(1, "x", False), (2, "y", True)]
