"""Versioned and bucketed tables: failed writes, readers in flight, merges that touch few buckets, cleanup."""

from __future__ import annotations

import os
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockpond.contracts import LakeConfig
from stockpond.plans import lake as runs
from stockpond.session import hadoop_path
from stockpond.sources import (
    ConcurrentWriteError,
    current_version,
    merge_buckets,
    path_exists,
    read_layer,
    read_version,
    register_table,
    remove_old_versions,
    replace_buckets,
    replace_table,
    versions,
    write_table,
)


def values(df) -> list:
    return sorted(tuple(r) for r in df.collect())


def test_failed_write_keeps_the_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        replace_table(broken, path)
    assert values(read_layer(spark, path)) == [(0,), (1,), (2,)]
    assert current_version(spark, path).number == 1
    assert replace_table(spark.range(4), path).rows == 4
    assert read_layer(spark, path).count() == 4


def test_a_table_is_replaced_from_itself_and_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    early = read_layer(spark, path)
    replace_table(early.withColumn("id", F.col("id") + 10), path)
    assert values(early) == [(0,), (1,), (2,)]
    assert values(read_layer(spark, path)) == [(10,), (11,), (12,)]
    assert values(read_version(spark, path, 1)) == [(0,), (1,), (2,)]


def test_second_of_two_writers_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    replace_table(spark.range(1), path)
    plain = versions.write_table

    def slow(df, *args, **options):
        monkeypatch.setattr(versions, "write_table", plain)
        replace_table(spark.range(5), path)  # another writer is faster
        return plain(df, *args, **options)

    monkeypatch.setattr(versions, "write_table", slow)
    with pytest.raises(ConcurrentWriteError):
        replace_table(spark.range(9), path)
    assert read_layer(spark, path).count() == 5


def test_commits_at_once_let_one_through(spark, tmp_path):
    root = str(tmp_path / "t")
    replace_table(spark.range(1), root)
    before, outcomes = current_version(spark, root), []

    def commit():
        try:
            versions._commit(spark, root, before, versions.Version(2, before.folders, before.schema))
            outcomes.append("done")
        except ConcurrentWriteError:
            outcomes.append("refused")

    threads = [threading.Thread(target=commit) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(outcomes) == ["done", "refused", "refused", "refused"]


def test_empty_and_partitioned_tables(spark, tmp_path):
    empty = spark.range(3).where("id > 5").withColumn("day", F.lit("a"))
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    assert replace_table(empty, one, partition_by=["day"]).rows == 0
    assert read_layer(spark, one).columns == ["id", "day"] and read_layer(spark, one).isEmpty()
    replace_buckets(empty, two, "id", 4)
    assert read_layer(spark, two).columns == ["id", "day"] and read_layer(spark, two).isEmpty()
    replace_table(spark.range(3).withColumn("day", F.lit("b")), one, partition_by=["day"])
    assert path_exists(spark, f"{one}/day=b") and not path_exists(spark, f"{one}/day=a")
    with pytest.raises(FileNotFoundError):
        read_version(spark, str(tmp_path / "none"))


def files_of(spark, path: str) -> dict[str, float]:
    return {f: os.stat(f.removeprefix("file://")).st_mtime_ns for f in read_layer(spark, path).inputFiles()}


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("old").alias("v"))
    replace_buckets(rows, path, "k", 8)
    before = files_of(spark, path)
    arrivals = spark.createDataFrame([("k7", "new"), ("k7777", "new")], "k string, v string")

    def merge(existing, fresh):
        return existing.join(fresh.select("k"), "k", "left_anti").unionByName(fresh)

    touched = {r[0] for r in arrivals.select(versions.bucket_of("k", 8)).collect()}
    report = merge_buckets(path, arrivals, merge)
    after = files_of(spark, path)
    kept = {f for f in before if int(Path(f).parent.name.split("=")[1]) not in touched}
    assert len(kept) == 8 - len(touched) and {f: before[f] for f in kept} == {f: after[f] for f in kept}
    assert not (set(after) - kept) & set(before)
    got = {r.k: r.v for r in read_layer(spark, path).collect()}
    assert len(got) == 201 and {k for k, v in got.items() if v == "new"} == {"k7", "k7777"}
    assert report.rows < 201
    # a merge that leaves a bucket empty, and keys that are null
    merge_buckets(path, arrivals, lambda existing, fresh: existing.limit(0))
    left = read_layer(spark, path)
    assert left.count() == 201 - report.rows
    merge_buckets(path, spark.createDataFrame([(None, "null")], "k string, v string"), lambda a, b: a.unionByName(b))
    assert read_layer(spark, path).where("k is null").count() == 1
    with pytest.raises(ValueError, match="other buckets"):
        merge_buckets(path, arrivals, lambda a, b: rows)


def test_merge_needs_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(1), path)
    with pytest.raises(ValueError, match="no bucketed table"):
        merge_buckets(path, spark.range(1), lambda a, b: b)


def test_cleanup_keeps_what_is_in_use(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(50).select(F.col("id").cast("string").alias("k"))
    replace_buckets(rows, path, "k", 4)
    for n in range(3):
        merge_buckets(path, spark.createDataFrame([(str(100 + n),)], "k string"), lambda a, b: a.unionByName(b))
    everything = values(read_layer(spark, path))
    write_table(rows, f"{path}/write-0left-by-a-failure")
    assert remove_old_versions(spark, path, keep=1) >= 2
    assert values(read_layer(spark, path)) == everything and len(everything) == 53
    assert remove_old_versions(spark, path, keep=1) == 0
    with pytest.raises(Exception):
        read_version(spark, path, 1)
    with pytest.raises(ValueError):
        remove_old_versions(spark, path, keep=0)


def test_buckets_are_partitions_in_the_catalog(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_buckets(spark.range(30).select(F.col("id").alias("k")), path, "k", 3)
    merge_buckets(path, spark.createDataFrame([(99,)], "k bigint"), lambda a, b: a.unionByName(b))
    table = register_table(spark, "bucketed_t", path)
    assert table.columns == ["k", "_bucket"] and spark.sql("SELECT sum(k) FROM bucketed_t").first()[0] == 435 + 99
    spark.sql("DROP TABLE bucketed_t")


def test_history_survives_a_failed_load(spark, tmp_path, monkeypatch):
    lake = LakeConfig(str(tmp_path))
    for name, key, natural in (("dim_product", "product_key", "product_id"), ("dim_customer", "customer_key", "customer_id")):
        tracked = runs.dimensions.TRACKED_ATTRIBUTES[name]
        row = spark.range(2).select(
            F.col("id").alias(key), F.col("id").cast("string").alias(natural), *[F.lit("x").alias(c) for c in tracked],
            F.lit("2024-01-01").cast("timestamp").alias("effective_from"), F.lit(None).cast("timestamp").alias("effective_to"),
            F.lit(True).alias("is_current"))
        replace_table(row, lake.path("gold", name))
    runs.run_history(spark, lake, "2024-01-01")
    changed = read_layer(spark, lake.path("gold", "dim_product")).withColumn(
        "name", F.when(F.col("product_id") == "1", F.raise_error(F.lit("boom")).cast("string")).otherwise(F.lit("y")))
    monkeypatch.setattr(runs, "read_layer", lambda s, p: changed if p.endswith("/dim_product") else read_layer(s, p))
    with pytest.raises(Exception, match="boom"):
        runs.run_history(spark, lake, "2024-02-01")
    monkeypatch.undo()
    history = read_layer(spark, lake.path("gold", "dim_product_history"))
    assert history.count() == 2 and history.where("is_current and name = 'x'").count() == 2


def test_one_day_is_listed_alone(spark, tmp_path, plan_of):
    path = str(tmp_path / "b")
    days = spark.range(6).select("id", F.expr("date_add(date'2024-01-01', cast(id % 3 as int))").alias("_ingestion_date"))
    write_table(days, path, partition_by=["_ingestion_date"])
    one = read_layer(spark, path, "2024-01-02")
    assert "b/_ingestion_date=2024-01-02]" in plan_of(one)
    assert sorted(r.id for r in one.collect()) == [1, 4] and dict(one.dtypes)["_ingestion_date"] == "date"
    assert read_layer(spark, path, "2030-01-01").isEmpty()
    _, fs = hadoop_path(spark, path)
    assert fs.exists(hadoop_path(spark, path)[0])


def test_silver_rows_are_shuffled_once(spark, tmp_path, bronze, plan_of, monkeypatch):
    """The tasks that deduplicate a table write its buckets, in a rebuild and in a merge of a day."""
    lake, plans, plain = LakeConfig(str(tmp_path), silver_buckets=4), [], versions.write_table

    def spy(df, path, **options):
        gathered = df.hint("rebalance", versions.BUCKET) if options.get("gather", True) else df
        plans.append(plan_of(gathered))
        return plain(df, path, **options)

    monkeypatch.setattr(versions, "write_table", spy)
    for day in (1, 2):
        rows = bronze("orders", *[{"order_id": f"O{k}", "status": f"day {day}"} for k in range(day, 40 * day)])
        write_table(rows.withColumn("_ingestion_date", F.lit(f"2024-03-0{day}").cast("date")),
                    lake.path("bronze", "orders"), mode="append", partition_by=["_ingestion_date"])
        runs.run_silver(spark, lake, ["orders"], processing_date=f"2024-03-0{day}")
    assert len(plans) == 2 and not any("REBALANCE" in text for text in plans)
    found = dict(read_layer(spark, lake.path("silver", "orders")).select("order_id", "status").collect())
    assert len(found) == 79 and found["O1"] == "day 1" and {found[f"O{k}"] for k in range(2, 80)} == {"day 2"}
    assert current_version(spark, lake.path("silver", "orders")).buckets == 4
