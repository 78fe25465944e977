"""Scans, sinks, catalog, incremental ingestion and whole runs on files."""

from __future__ import annotations

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockpond.contracts import LakeConfig, QualityLimits, source_table
from stockpond.plans import lake as runs
from stockpond.plans.bronze import ingest_table
from stockpond.quality import DataQualityError
from stockpond.session import hadoop_path, input_bytes, scratch_path, shared_folder, shuffle_sizing, stage
from stockpond.sources import is_empty_source, path_exists, read_files, read_layer, read_raw, refresh_partitions, register_table, write_table
from stockpond.streaming import ingest_new_files

ITEMS = "order_item_id,order_id,product_id,quantity,unit_price,discount_percent,line_total\n"


def put(folder, name: str, text: str):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def test_raw_csv_keeps_text_and_quotes(spark, tmp_path):
    header = ",".join(source_table("products").columns) + "\n"
    path = put(tmp_path / "p", "products.csv", header + 'P1,S,"Box, ""big""",émotion,books,,B,09.50,1,1,True,2024-01-01\n')
    row = read_raw(spark, "products", path).first()
    assert (row["name"], row["description"], row["price"], row["subcategory"]) == ('Box, "big"', "émotion", "09.50", None)


def test_a_swapped_header_is_an_error(spark, tmp_path):
    path = put(tmp_path / "i", "a.csv", ITEMS.replace("order_item_id,order_id", "order_id,order_item_id") + "O1,I1,P1,1,1,0,1\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_raw(spark, "order_items", path).collect()


def test_line_breaks_inside_quotes_need_multi_line(spark, tmp_path):
    path = put(tmp_path / "i", "a.csv", ITEMS + 'I1,O1,"P\n1",1,1,0,1\n')
    assert read_raw(spark, "order_items", path).count() == 2
    assert read_raw(spark, "order_items", path, multi_line=True).first()["product_id"] == "P\n1"


def test_corrupt_records_are_kept_as_text(spark, tmp_path):
    path = put(tmp_path / "i", "a.csv", ITEMS + "I1,O1,P1,1,1,0,1\nI2,O2\n")
    rows = read_raw(spark, "order_items", path, keep_corrupt=True).cache()
    assert {r.order_item_id: r._corrupt_record for r in rows.collect()} == {"I1": None, "I2": "I2,O2"}


def test_json_and_unknown_tables(spark, tmp_path):
    path = put(tmp_path / "j", "a.json", '{"order_item_id": "I1", "quantity": 2, "other": 1}\n')
    row = read_raw(spark, "order_items", path, "json").first()
    assert (row["order_item_id"], row["quantity"], row["order_id"]) == ("I1", "2", None)
    with pytest.raises(ValueError, match="unknown table"):
        read_raw(spark, "returns", path)


def test_only_files_named_like_the_table(spark, tmp_path):
    folder = tmp_path / "mixed"
    put(folder, "order_items_1.csv", ITEMS + "I1,O1,P1,1,1,0,1\n")
    path = put(folder, "orders.csv", "nothing\n")
    assert read_raw(spark, "order_items", path, match_pattern=True).count() == 1


def test_reading_with_or_without_types(spark, tmp_path):
    path = put(tmp_path / "f", "a.csv", "n,t\n1,2024-01-01 00:00:00\n2,\n")
    assert dict(read_files(spark, path).dtypes) == {"n": "int", "t": "timestamp"}
    assert dict(read_files(spark, path, infer_schema=False).dtypes) == {"n": "string", "t": "string"}
    assert read_files(spark, path, "a int, b string", header=False).columns == ["a", "b"]


def test_empty_and_missing_sources_are_skipped(spark, tmp_path):
    empty = put(tmp_path / "raw", "a.csv", ITEMS)
    target = str(tmp_path / "bronze")
    assert is_empty_source(read_raw(spark, "order_items", empty)) and not path_exists(spark, target)
    assert ingest_table(spark, "order_items", empty, target) is None
    assert ingest_table(spark, "order_items", str(tmp_path / "none"), target) is None
    assert not path_exists(spark, target)


def test_ingest_appends_or_replaces_the_day(spark, tmp_path):
    raw, target = put(tmp_path / "raw", "a.csv", ITEMS + "I1,O1,P1,1,1,0,1\n"), str(tmp_path / "bronze")
    assert ingest_table(spark, "order_items", raw, target).rows == 1
    assert ingest_table(spark, "order_items", raw, target).rows == 1
    written = read_layer(spark, target)
    assert written.count() == 2
    assert all(r._source_file.endswith("a.csv") and r._ingestion_date == r._ingested_at.date() for r in written.collect())
    ingest_table(spark, "order_items", raw, target, replace_day=True)
    assert read_layer(spark, target).count() == 1


def test_write_modes_and_metrics(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "v int, day string")
    found = write_table(days, path, partition_by=["day"], metrics={"most": F.max("v")})
    assert (found.rows, found.metrics) == (3, {"most": 3})
    write_table(days.where("day = 'a'").withColumn("v", F.lit(9)), path, partition_by=["day"], replace_only_written=True)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(3, "b"), (9, "a"), (9, "a")]
    write_table(days.where("day = 'b'"), path, partition_by=["day"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(3, "b")]
    write_table(days, path + "2", mode="append")
    write_table(days, path + "2", mode="append")
    assert spark.read.parquet(path + "2").count() == 6


def test_one_ingestion_day_is_pruned(spark, tmp_path, plan_of):
    path = str(tmp_path / "b")
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "v int, _ingestion_date date")
    write_table(rows, path, partition_by=["_ingestion_date"])
    day = read_layer(spark, path, "2024-01-02")
    assert [r.v for r in day.collect()] == [2] and read_layer(spark, path, "").count() == 2
    assert "PartitionFilters: [isnotnull(_ingestion_date" in plan_of(day)


def test_catalog_sees_new_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.createDataFrame([(1, "x")], "v int, p string").write.partitionBy("p").parquet(path)
    assert register_table(spark, "catalog_test", path, ["p"]).count() == 1
    spark.createDataFrame([(2, 5, "y")], "v int, w int, p string").write.mode("append").partitionBy("p").parquet(path)
    assert read_layer(spark, path, merge_schema=True).columns == ["v", "w", "p"]
    refresh_partitions(spark, "catalog_test")
    assert spark.sql("SELECT sum(v) FROM catalog_test WHERE p = 'y'").first()[0] == 2
    spark.range(1).write.saveAsTable("managed_test")
    with pytest.raises(ValueError, match="managed"):
        register_table(spark, "managed_test", path)
    assert register_table(spark, "catalog_test", path, ["p"], merge_schema=True).columns == ["v", "w", "p"]
    assert spark.sql("SELECT sum(w) FROM catalog_test").first()[0] == 5


def test_catalog_takes_quotes_in_paths_and_columns(spark, tmp_path):
    path = str(tmp_path / "it's")
    spark.createDataFrame([(1, "x")], "`a``b` int, p string").write.partitionBy("p").parquet(path)
    assert register_table(spark, "catalog_quotes", path, ["p"]).collect() == [(1, "x")]
    spark.sql("DROP TABLE catalog_quotes")


def test_incremental_ingest_takes_each_file_once(spark, tmp_path):
    raw, bronze, state = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "state")

    def run():
        ingest_new_files(spark, "order_items", str(raw), bronze, state, timeout_seconds=120)
        return sorted(r.order_item_id for r in spark.read.parquet(bronze).collect())

    put(raw, "a.csv", ITEMS + "I1,O1,P1,1,1,0,1\nI2,O1,P1,1,1,0,1\n")
    assert run() == ["I1", "I2"] and run() == ["I1", "I2"]
    put(raw, "b.csv", ITEMS + "I3,O1,P1,1,1,0,1\n")
    assert run() == ["I1", "I2", "I3"]
    assert "_ingestion_date" in spark.read.parquet(bronze).columns


def test_scratch_paths_are_shared_and_distinct(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_folder(spark))


@pytest.fixture
def lake(tmp_path):
    raw = tmp_path / "raw"
    put(raw / "customers", "customers.csv",
        "customer_id,email,first_name,last_name,phone,country,city,address,created_at,updated_at\n"
        "C1,A@X.com,ann,lee,,de,Berlin,,2023-01-01,2023-02-01\nC2,b@x.com,bob,ray,,nl,Delft,,2024-02-20,\n")
    put(raw / "products", "products.csv", ",".join(source_table("products").columns) + "\n"
        "P1,s1,One,,Books,,B,10,4,5,True,2023-01-01\nP2,s2,Two,,toys,,B,20,5,0,False,2023-01-01\n")
    put(raw / "orders", "orders.csv", ",".join(source_table("orders").columns) + "\n"
        "O1,C1,2024-02-01T10:00:00,delivered,paypal,30,5.7,0,0,35.7,EUR,de,Berlin\n"
        "O2,C2,2024-02-02T10:00:00,Shipped,paypal,20,4.2,4.99,0,29.19,EUR,nl,Delft\n")
    put(raw / "order_items", "order_items.csv", ITEMS
        + "I1,O1,P1,1,10,0,10\nI2,O1,P2,1,20,0,20\nI3,O2,P2,1,20,0,20\nI1,O1,P1,1,10,0,10\n")
    return LakeConfig(str(tmp_path), QualityLimits(), 2024, 2024)


def test_whole_run(spark, lake):
    reports = runs.run_all(spark, lake, as_of="2024-03-01")
    assert {name: r.rows for name, r in reports["bronze"].items()} == {
        "customers": 2, "products": 2, "orders": 2, "order_items": 4}
    assert {name: r.rows for name, r in reports["silver"].items()} == {
        "customers": 2, "products": 2, "orders": 2, "order_items": 3}
    assert {name: r.rows for name, r in reports["gold"].items()} == {
        "dim_date": 366, "dim_product": 2, "dim_customer": 2, "fact_sales": 3, "agg_daily_sales": 2,
        "agg_product_performance": 2}
    keys, totals = runs.check_load(spark, lake)
    assert all(r.null_keys == 0 and r.orphan_rows == 0 for r in keys.collect())
    assert totals.first().total_revenue == 50.0
    checks = read_layer(spark, lake.path("quality", "silver_checks"))
    assert checks.count() == 38 and checks.where("not passed").isEmpty()
    assert path_exists(spark, lake.path("gold", "fact_sales/date_key=20240201"))

    # all tables can be queried by name
    assert len(runs.register_layers(spark, lake, "shop")) == 10
    assert len(runs.register_layers(spark, lake, "shop")) == 10
    best = spark.sql("""SELECT p.name, sum(f.net_revenue) AS revenue FROM shop.fact_sales f
                        JOIN shop.dim_product p USING (product_key) WHERE f.date_key >= 20240201
                        GROUP BY p.name ORDER BY revenue DESC LIMIT 1""").first()
    assert best[:] == ("Two", 40.0)

    # histories start with one open version per member
    assert {n: r.rows for n, r in runs.run_history(spark, lake, "2024-03-01").items()} == {
        "dim_product": 2, "dim_customer": 2}

    # another delivery: one changed and one new order, merged from its ingestion day only
    put(Path(lake.path("raw", "orders")), "orders2.csv", ",".join(source_table("orders").columns)
        + "\nO2,C2,2024-02-02T10:00:00,delivered,paypal,20,4.2,4.99,0,29.19,EUR,nl,Delft\n"
        "O3,C1,2024-02-03T10:00:00,pending,paypal,5,1,0,0,6,EUR,de,Berlin\n")
    runs.run_bronze(spark, lake, ["orders"])
    today = read_layer(spark, lake.path("bronze", "orders")).agg(F.max("_ingestion_date")).first()[0]
    runs.run_silver(spark, lake, ["orders"], processing_date=today.isoformat())
    status = {r.order_id: r.status for r in read_layer(spark, lake.path("silver", "orders")).collect()}
    assert status == {"O1": "delivered", "O2": "delivered", "O3": "pending"}
    again = runs.run_gold(spark, lake, as_of="2024-03-01")
    assert again["fact_sales"].rows == 3

    # a price changes: the old version is closed, the customers stay as they are
    put(Path(lake.path("raw", "products")), "products2.csv", ",".join(source_table("products").columns)
        + "\nP1,s1,One,,Books,,B,12,4,5,True,2023-01-01\n")
    runs.run_bronze(spark, lake, ["products"])
    runs.run_silver(spark, lake, ["products"], processing_date=today.isoformat())
    runs.run_gold(spark, lake, as_of="2024-03-02")
    assert {n: r.rows for n, r in runs.run_history(spark, lake, "2024-03-02").items()} == {
        "dim_product": 3, "dim_customer": 2}
    versions = read_layer(spark, lake.path("gold", "dim_product_history")).where("product_id = 'P1'").collect()
    assert {(r.product_key, r.price, r.is_current) for r in versions} == {(1, 10.0, False), (3, 12.0, True)}
    _, fs = hadoop_path(spark, shared_folder(spark))
    left = fs.listStatus(hadoop_path(spark, scratch_path(spark, "x").rsplit("/", 1)[0])[0])
    assert not [s for s in left if "history" in s.getPath().getName() or "sale_key" in s.getPath().getName()]


def test_gate_stops_a_run(spark, lake):
    put(Path(lake.path("raw", "order_items")), "bad.csv", ITEMS + "I9,OX,P1,1,1,0,1\n")
    runs.run_bronze(spark, lake)
    runs.run_silver(spark, lake, as_of="2024-03-01")
    with pytest.raises(DataQualityError, match="ref_integrity_order_id"):
        runs.run_quality(spark, lake)
    relaxed = LakeConfig(lake.root, QualityLimits(fail_on_error=False))
    assert runs.run_quality(spark, relaxed).where("not passed").count() == 1
    late = runs.run_quality(spark, relaxed, as_of="2100-01-01").where("not passed and severity = 'warning'")
    assert late.count() == 4 and late.where("check_name = 'freshness__ingested_at'").count() == 4


def test_the_key_gate_sees_what_silver_hides(spark, lake):
    runs.run_bronze(spark, lake)  # one of four order items came twice
    with pytest.raises(DataQualityError, match="order_items.bronze_unique_order_item_id"):
        runs.run_key_gate(spark, lake)
    checks = read_layer(spark, lake.path("quality", "bronze_checks"))
    assert checks.count() == 8 and checks.where("not passed").first()["failed_count"] == 1
    day = str(read_layer(spark, lake.path("bronze", "orders")).first()["_ingestion_date"])
    relaxed = LakeConfig(lake.root, QualityLimits(max_duplicate_percentage=25.0))
    assert runs.run_key_gate(spark, relaxed, processing_date=day).where("passed").count() == 8
    assert runs.run_key_gate(spark, relaxed, ["orders"], processing_date="1999-01-01").count() == 0
    with pytest.raises(DataQualityError, match="bronze_unique"):
        runs.run_all(spark, LakeConfig(lake.root, gate_keys=True), as_of="2024-03-01")
    assert not path_exists(spark, lake.path("silver", "orders"))
    with pytest.raises(FileNotFoundError, match="no bronze"):
        runs.run_key_gate(spark, lake, [])


def test_gold_needs_every_silver_table(spark, lake):
    with pytest.raises(FileNotFoundError, match="customers"):
        runs.run_gold(spark, lake)
    assert runs.run_silver(spark, lake) == dict.fromkeys(["customers", "products", "orders", "order_items"])
    with pytest.raises(ValueError, match="unknown table"):
        runs.run_bronze(spark, lake, ["returns"])


def test_marts_of_a_run(spark, lake, by_key):
    with pytest.raises(FileNotFoundError):
        runs.run_marts(spark, lake)
    reports = runs.run_all(spark, lake, as_of="2024-03-01", with_marts=True)
    assert {name: r.rows for name, r in reports["marts"].items()} == {
        "agg_weekly_sales": 2, "agg_monthly_sales": 2, "agg_category_performance": 2, "agg_daily_revenue": 2,
        "agg_orders_per_customer": 1, "agg_customer_lifetime_value": 2, "top_products": 2, "best_sellers": 2}
    gold = {name: read_layer(spark, lake.path("gold", name)) for name in reports["marts"]}
    weeks = by_key(gold["agg_weekly_sales"], "shipping_country")
    assert {c: (str(r["period_start"]), r["net_revenue"]) for c, r in weeks.items()} == {
        "DE": ("2024-01-29", 30.0), "NL": ("2024-01-29", 20.0)}
    spend = by_key(gold["agg_customer_lifetime_value"], "customer_id")
    assert spend["C1"]["customer_lifetime_value"] == 35.7
    assert [r.product_id for r in gold["best_sellers"].orderBy(F.desc("total_revenue")).collect()] == ["P2", "P1"]
    assert len(runs.register_layers(spark, lake, "shop_with_marts")) == 18
    spark.sql("DROP DATABASE shop_with_marts CASCADE")


def test_shuffles_fit_the_input(spark, tmp_path):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.range(100_000).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    size = input_bytes(spark, [table])
    assert size == sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    with shuffle_sizing(spark, [table]) as least:
        assert least == int(before)
    for tasks in (50, 500):
        with shuffle_sizing(spark, [table], growth=1, task_bytes=-(-size // tasks)) as number:
            assert tasks - 1 <= number <= tasks and spark.conf.get(name) == str(number)
            plan = table.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(id#" in plan and f", {number})" in plan
        assert spark.conf.get(name) == before
    assert input_bytes(spark, [spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")]) == 0


def test_staged_tables_leave_no_shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles() -> set[int]:
        files = blocks.getAllFiles()
        names = [files.apply(k).getName() for k in range(files.size())]
        return {int(n.split("_")[1]) for n in names if n.startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, last = spark.conf.get(name, None), max(shuffles(), default=-1)
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    for _ in range(2):  # the plan may be run again
        assert {r["k"]: r["count"] for r in stage(grouped, "grouped").collect()} == {k: 143 if k < 6 else 142 for k in range(7)}
    deadline = time.monotonic() + 20
    while max(shuffles(), default=-1) > last and time.monotonic() < deadline:  # files are removed in the background
        time.sleep(0.1)
    assert max(shuffles(), default=-1) <= last
    assert spark.conf.get(name, None) in (before, "false")
