"""Physical plans: what has to hold for large tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from stockpond.operators import latest_per_key, top_per_group
from stockpond.plans import dimensions, marts
from stockpond.plans.silver import build_silver
from stockpond.quality import check_order_items
from testbed import tables as T

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def silver(spark):
    return {table: T.silver_table(spark, SF, table) for table in T.RAW}


@pytest.fixture(scope="module")
def fact(spark):
    return T.sales(spark, SF)


def before(text: str, first: str, second: str) -> bool:
    """In a formatted plan operators are numbered from the leaves up."""
    number = lambda name: min(int(n) for n in re.findall(rf"\((\d+)\) {name}\b", text))
    return number(first) < number(second)


def test_dedup_limits_groups_before_the_shuffle(silver, plan_of):
    for table, df in silver.items():
        text = plan_of(df)
        assert before(text, "WindowGroupLimit", "Exchange"), table
        assert text.count("Exchange hashpartitioning") <= 2 * (1 + (table == "customers"))


def test_no_plan_runs_python_or_pairs_everything(silver, fact, plan_of):
    frames = [*silver.values(), fact, marts.daily_sales(fact),
              dimensions.customer_profiles(silver["customers"], silver["orders"], T.AS_OF),
              check_order_items(silver["order_items"], silver["orders"], silver["products"])]
    for df in frames:
        text = plan_of(df)
        for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
            assert banned not in text


def test_fact_does_not_window_in_one_task(fact, plan_of):
    """The only single-partition step is the prefix sum over partition sizes."""
    text = plan_of(fact)
    for single in re.findall(r"Exchange\n.*\n.*SinglePartition", text):
        assert "_part" in single and "_size" in single


def test_customers_meet_orders_before_lines(fact, plan_of):
    text = plan_of(fact)
    final = text[text.rindex("SortMergeJoin"):] if "SortMergeJoin" in text else text
    assert "order_id" in final


def test_filters_and_columns_reach_the_files(spark, tmp_path, silver, plan_of):
    path = str(tmp_path / "orders")
    silver["orders"].write.parquet(path)
    orders = spark.read.parquet(path)
    recent = orders.where((F.col("status") == "shipped") & (F.col("total_amount") > 50)).select("order_id")
    text = plan_of(recent)
    assert "EqualTo(status,shipped)" in text and "GreaterThan(total_amount,50.0)" in text
    assert "ReadSchema: struct<order_id:string,status:string,total_amount:double>" in text
    metrics = plan_of(dimensions.customer_metrics(orders))
    assert "ReadSchema: struct<order_id:string,customer_id:string,order_date:timestamp,total_amount:double>" in metrics


def test_date_partitions_are_pruned(spark, tmp_path, fact, plan_of):
    path = str(tmp_path / "fact")
    monthly = fact.withColumn("month_key", F.expr("date_key div 100"))
    monthly.write.partitionBy("month_key").parquet(path)
    assert "PartitionFilters: [isnotnull(month_key" in plan_of(spark.read.parquet(path).where("month_key = 200101"))


def test_aggregates_combine_before_the_shuffle(fact, plan_of):
    for df in (marts.daily_revenue(fact), marts.daily_sales(fact), marts.business_totals(fact)):
        assert "partial_" in plan_of(df)


def test_distinct_counts_do_not_copy_lines(fact, plan_of):
    for df in (marts.daily_sales(fact), marts.sales_by_period(fact, "month"), marts.orders_per_customer(fact)):
        assert "Expand" not in plan_of(df)


def test_top_k_is_limited_early(fact, silver, plan_of):
    products = dimensions.dim_product(silver["products"])
    assert "TakeOrderedAndProject" in plan_of(marts.best_sellers(fact, products))
    few = top_per_group(products, ["category"], [F.col("price").desc()], 3, "rank")
    text = plan_of(few)
    shuffles = [int(n) for n in re.findall(r"\((\d+)\) Exchange\nInput.*\nArguments: hashpartitioning\(category", text)]
    limits = [int(n) for n in re.findall(r"\((\d+)\) WindowGroupLimit", text)]
    assert min(limits) < min(shuffles)


def test_row_level_checks_share_one_scan(spark, tmp_path, silver, plan_of):
    path = str(tmp_path / "items")
    silver["order_items"].write.parquet(path)
    items = spark.read.parquet(path)
    from stockpond.quality import InRange, NotNull, RowCount, evaluate

    results = evaluate(items, "t", [NotNull("quantity"), InRange("unit_price", low=0), RowCount()])
    assert plan_of(results).count("Scan parquet") == 2  # tree line and details of one scan


def test_hot_join_keys_are_split(spark, plan_of):
    """A key with most of the rows is split over several tasks by adaptive execution."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    kept = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id") + 2)
        left = spark.range(0, 60000, 1, 8).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        right = spark.range(0, 60003, 1, 8).select(F.col("id").alias("k"), F.col("id").alias("w"))
        joined = left.join(right, "k")
        assert joined.agg(F.count("v")).first()[0] == 60000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_key_does_not_reach_one_task_in_dedup(spark):
    """Each map task hands over at most one row per key."""
    rows = spark.range(0, 40000, 1, 8).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    kept = latest_per_key(rows, ["k"], ["v"])
    assert kept.collect()[0].v == 39999
    shuffled = written_rows(kept)
    assert shuffled <= 8


def written_rows(df) -> int:
    """Rows that all shuffles of an executed plan wrote."""
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.getClass().getSimpleName()
    node = plan.executedPlan() if text.startswith("AdaptiveSparkPlan") else plan
    total, todo = 0, [node]
    while todo:
        node = todo.pop()
        if "ShuffleQueryStage" in node.getClass().getSimpleName():
            total += int(node.shuffle().metrics().apply("shuffleRecordsWritten").value())
            continue
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_builders_are_lazy(bronze):
    """Silver builders start no job."""
    df = bronze("orders", {"order_id": "O1"})
    tracker = df.sparkSession.sparkContext.statusTracker()
    earlier = len(tracker.getJobIdsForGroup(None))
    build_silver("orders", df)
    assert len(tracker.getJobIdsForGroup(None)) == earlier
