"""Scans, sinks, catalog and incremental ingestion, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockpond.operators import stamp_lineage
from stockpond.plans.bronze import ingest_table, with_file_lineage
from stockpond.plans.silver import build_silver, merge_silver
from stockpond.session import hadoop_path, scratch_path
from stockpond.sources import FailureBudget, ingest_with_quarantine, read_files, read_layer, read_raw, register_table, write_table
from stockpond.streaming import ingest_new_files
from testbed import sql as S
from testbed import tables as T
from testbed.registry import query

RAW_PRODUCTS_SQL = f"""
    SELECT 'PROD-' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS product_id,
      CASE WHEN p_partkey % 5 <> 0 THEN p_name || ' from stock' END AS description, p_type AS category,
      p_brand AS brand, CASE WHEN p_partkey % 101 = 0 THEN NULL WHEN p_partkey % 103 = 0 THEN 0.0::DOUBLE
        ELSE {S.PRICE} END AS price
    FROM part"""


def products_seen(raw):
    """Values of raw products that survive any file format; blanks at the ends do not survive CSV."""
    return raw.select(
        "product_id", "description", F.trim("category").alias("category"), F.trim("brand").alias("brand"),
        F.col("price").try_cast("double").alias("price"),
    )


def raw_files(spark, sf_dir, table, file_format="csv"):
    """Write a raw table as files of the given format and return the folder."""
    path = scratch_path(spark, f"raw-{table}")
    contract = T.RAW[table](spark, sf_dir).drop("_ingested_at", "_source_file")
    contract.write.format(file_format).option("header", True).option("escape", '"').save(path)
    return path


def name_parts(spark, folder, table):
    """Name the part files of a folder after their table, as a source system would."""
    jpath, fs = hadoop_path(spark, folder)
    for status in fs.listStatus(jpath):
        part = status.getPath()
        if part.getName().startswith("part-"):
            fs.rename(part, hadoop_path(spark, f"{folder}/{table}_{part.getName()}")[0])


@query("bronze_scan_csv", RAW_PRODUCTS_SQL)
def bronze_scan_csv(spark, sf_dir):
    return products_seen(read_raw(spark, "products", raw_files(spark, sf_dir, "products")))


@query("bronze_scan_json", RAW_PRODUCTS_SQL)
def bronze_scan_json(spark, sf_dir):
    return products_seen(read_raw(spark, "products", raw_files(spark, sf_dir, "products", "json"), "json"))


@query("scan_csv_infer", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def scan_csv_infer(spark, sf_dir):
    """Types come back from the text by inference."""
    path = scratch_path(spark, "orders-csv")
    T.load(spark, sf_dir, "orders").drop("o_orderdate").write.option("header", True).csv(path)
    return read_files(spark, path).select(
        F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderstatus", "o_totalprice",
        "o_orderpriority",
    )


@query("scan_path_glob", RAW_PRODUCTS_SQL)
def scan_path_glob(spark, sf_dir):
    """Only files named like the table are read from a folder that holds two tables."""
    folder = scratch_path(spark, "mixed-raw")
    for table in ("orders", "products"):
        raw = T.RAW[table](spark, sf_dir).drop("_ingested_at", "_source_file")
        raw.write.option("header", True).option("escape", '"').csv(f"{folder}/{table}")
        name_parts(spark, f"{folder}/{table}", table)
    return products_seen(read_raw(spark, "products", f"{folder}/*", match_pattern=True))


@query("scan_partition_pruned", """
    SELECT 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_id, DATE '2001-08-01' AS _ingestion_date
    FROM orders WHERE o_orderstatus = 'O'""")
def scan_partition_pruned(spark, sf_dir):
    """One ingestion day of a bronze table."""
    path = scratch_path(spark, "bronze-orders")
    orders = T.raw_orders(spark, sf_dir).withColumn("_ingestion_date", F.col("_ingested_at").cast("date"))
    write_table(orders, path, partition_by=["_ingestion_date"])
    return read_layer(spark, path, ingestion_date="2001-08-01").select("order_id", "_ingestion_date")


@query("bronze_metadata", S.with_tables(S.RAW_ITEMS, """
    SELECT order_item_id, product_id, TIMESTAMP '2001-08-02 06:00:00' AS _ingested_at,
      'order_items.csv' AS _source_file, DATE '2001-08-02' AS _ingestion_date FROM raw_items"""))
def bronze_metadata(spark, sf_dir):
    items = T.raw_order_items(spark, sf_dir).select("order_item_id", "product_id")
    return T.comparable(stamp_lineage(items, "order_items.csv", at=T.delivered(2)))


@query("file_lineage", """
    SELECT count(*) AS rows, true AS all_from_csv, count(*) AS dated FROM part""")
def file_lineage(spark, sf_dir):
    """Every row knows the file it came from and the day it came in."""
    raw = with_file_lineage(read_raw(spark, "products", raw_files(spark, sf_dir, "products")))
    return raw.agg(
        F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("_source_file").endswith(".csv")).alias("all_from_csv"),
        F.count("_ingestion_date").alias("dated"),
    )


@query("sink_append_roundtrip", S.with_tables(S.SILVER_PRODUCTS, """
    SELECT product_id, brand, price, deliveries FROM silver_products, (SELECT 2::BIGINT AS deliveries)"""))
def sink_append_roundtrip(spark, sf_dir):
    """Two ingest runs append every row twice; silver keeps one."""
    raw, bronze = raw_files(spark, sf_dir, "products"), scratch_path(spark, "bronze-products")
    for _ in range(2):
        ingest_table(spark, "products", raw, bronze)
    written = read_layer(spark, bronze)
    deliveries = written.groupBy("product_id").agg(F.count(F.lit(1)).alias("deliveries"))
    return build_silver("products", written).join(deliveries, "product_id").select(
        "product_id", "brand", "price", "deliveries"
    )


@query("sink_dynamic_overwrite", """
    SELECT o_orderstatus, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
      * CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS total
    FROM orders GROUP BY o_orderstatus""")
def sink_dynamic_overwrite(spark, sf_dir):
    """Rewriting the open orders with a total of zero leaves the other partitions alone."""
    path = scratch_path(spark, "orders-by-status")
    orders = T.load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_table(orders, path, partition_by=["o_orderstatus"])
    corrected = orders.where("o_orderstatus = 'O'").withColumn("o_totalprice", F.lit(0.0))
    write_table(corrected, path, partition_by=["o_orderstatus"], replace_only_written=True)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query("sink_overwrite_roundtrip", S.with_tables(S.SILVER_ORDERS, """
    SELECT order_id, customer_id, order_date, status, total_amount FROM silver_orders"""))
def sink_overwrite_roundtrip(spark, sf_dir):
    """A second full write replaces the first."""
    path = scratch_path(spark, "silver-orders")
    orders = T.silver_table(spark, sf_dir, "orders")
    write_table(orders.unionByName(orders), path)
    write_table(orders, path)
    return T.comparable(read_layer(spark, path)).select(
        "order_id", "customer_id", "order_date", "status", "total_amount"
    )


@query("sink_fact_partitioned", S.with_tables(S.FACT, """
    SELECT date_key, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS items FROM fact
    WHERE date_key >= 20010101 GROUP BY date_key"""))
def sink_fact_partitioned(spark, sf_dir):
    """The written fact, with its partitions pruned to the last year."""
    path = scratch_path(spark, "fact-sales")
    write_table(T.sales(spark, sf_dir), path, partition_by=["date_key"])
    return read_layer(spark, path).where("date_key >= 20010101").groupBy(F.col("date_key").cast("bigint").alias("date_key")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("items")
    )


@query("observe_counts", """
    SELECT count(*) AS rows, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, max(l_orderkey) AS last_order
    FROM lineitem""")
def observe_counts(spark, sf_dir):
    """Counts measured by the write itself."""
    report = write_table(
        T.load(spark, sf_dir, "lineitem"), scratch_path(spark, "lineitem"),
        metrics={"returned": F.count_if(F.col("l_returnflag") == "R"), "last_order": F.max("l_orderkey")},
    )
    row = (report.rows, report.metrics["returned"], report.metrics["last_order"])
    return spark.createDataFrame([row], "rows bigint, returned bigint, last_order bigint")


@query("catalog_sql_query", """
    SELECT o_orderpriority, o_orderstatus, count(*) AS orders FROM orders GROUP BY ALL""")
def catalog_sql_query(spark, sf_dir):
    """A written table, registered and queried by name."""
    path = scratch_path(spark, "orders-table")
    name = "stockpond_" + path.rsplit("-", 1)[-1]
    write_table(T.load(spark, sf_dir, "orders"), path, partition_by=["o_orderstatus"])
    register_table(spark, name, path, partition_by=["o_orderstatus"])
    return spark.sql(f"SELECT o_orderpriority, o_orderstatus, count(*) AS orders FROM {name} GROUP BY ALL")


@query("bronze_incremental", S.with_tables(S.SILVER_ORDERS, """
    SELECT order_id, count(*) AS deliveries FROM (
      SELECT order_id FROM silver_orders
      UNION ALL SELECT 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') FROM orders WHERE o_orderstatus = 'O')
    GROUP BY order_id"""))
def bronze_incremental(spark, sf_dir):
    """Files of two deliveries, taken in by three calls: each file counts once."""
    raw, bronze = scratch_path(spark, "arrivals"), scratch_path(spark, "bronze-orders")
    checkpoint = scratch_path(spark, "ingest-state")
    orders = T.raw_orders(spark, sf_dir)
    for day in (1, 2):
        delivery = orders.where(F.col("_ingested_at") == T.delivered(day)).drop("_ingested_at", "_source_file")
        delivery.write.mode("append").option("header", True).option("escape", '"').csv(raw)
        ingest_new_files(spark, "orders", raw, bronze, checkpoint, timeout_seconds=300)
    ingest_new_files(spark, "orders", raw, bronze, checkpoint, timeout_seconds=300)
    return spark.read.parquet(bronze).groupBy("order_id").agg(F.count(F.lit(1)).alias("deliveries"))


@query("bronze_mixed_ingest", S.with_tables(S.SILVER_ORDERS, """
    SELECT order_id, count(*) AS deliveries FROM (
      SELECT order_id FROM silver_orders
      UNION ALL SELECT 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') FROM orders WHERE o_orderstatus = 'O')
    GROUP BY order_id"""))
def bronze_mixed_ingest(spark, sf_dir):
    """The first delivery by a plain run, the second by a stream into the same table: all rows are there."""
    bronze, checkpoint = scratch_path(spark, "bronze-orders"), scratch_path(spark, "ingest-state")
    orders = T.raw_orders(spark, sf_dir)
    for day in (1, 2):
        raw = scratch_path(spark, f"arrivals-{day}")
        delivery = orders.where(F.col("_ingested_at") == T.delivered(day)).drop("_ingested_at", "_source_file")
        delivery.write.option("header", True).option("escape", '"').csv(raw)
        if day == 1:
            ingest_table(spark, "orders", raw, bronze)
        else:
            ingest_new_files(spark, "orders", raw, bronze, checkpoint, timeout_seconds=300)
    return read_layer(spark, bronze).groupBy("order_id").agg(F.count(F.lit(1)).alias("deliveries"))


@query("bronze_quarantine", """
    SELECT 'PROD-' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS product_id, p_brand AS brand,
      CASE WHEN p_partkey % 7 = 0 THEN 'quarantine' ELSE 'bronze' END AS layer,
      CASE WHEN p_partkey % 7 = 0 THEN length(p_brand) + 15 END AS bad_length
    FROM part""")
def bronze_quarantine(spark, sf_dir):
    """Every seventh record is cut off after two columns: good and quarantined rows together are all rows."""
    raw, bronze, apart = (scratch_path(spark, label) for label in ("damaged", "bronze-products", "quarantine-products"))
    products = T.raw_products(spark, sf_dir).drop("_ingested_at", "_source_file")
    whole = F.to_csv(F.struct(*products.columns), {"escape": '"'})
    brand = F.trim("brand")
    lines = products.withColumn("cut", F.substring("product_id", 6, 9).cast("bigint") % 7 == 0).select(
        F.when(F.col("cut"), F.concat_ws(",", "product_id", brand)).otherwise(whole).alias("line"),
        (F.xxhash64("product_id") % 4).alias("part"), F.lit(1).alias("place"))
    titles = spark.range(-3, 4).select(F.lit(",".join(products.columns)), F.col("id"), F.lit(0))
    lines.union(titles).repartition(4, "part").sortWithinPartitions("part", "place").select("line").write.text(raw)
    ingest_with_quarantine(spark, "products", raw, bronze, apart, "first", FailureBudget(0.5))
    ingest_with_quarantine(spark, "products", raw, bronze, apart, "first", FailureBudget(0.5))  # changes nothing
    text = F.col("_corrupt_record")
    kept = read_layer(spark, bronze).select("product_id", F.trim("brand").alias("brand"), F.lit("bronze").alias("layer"),
                                            F.lit(None).cast("bigint").alias("bad_length"))
    return kept.unionByName(read_layer(spark, apart).select(
        F.substring_index(text, ",", 1).alias("product_id"), F.substring_index(text, ",", -1).alias("brand"),
        F.lit("quarantine").alias("layer"), F.length(text).cast("bigint").alias("bad_length")))


@query("silver_incremental_merge", S.with_tables(S.SILVER_ORDERS, """
    SELECT order_id, customer_id, status, total_amount FROM silver_orders"""))
def silver_incremental_merge(spark, sf_dir):
    """Silver of the first delivery, merged with the second, equals a full rebuild."""
    raw = T.raw_orders(spark, sf_dir)
    first = build_silver("orders", raw.where(F.col("_ingested_at") == T.delivered(1)))
    second = build_silver("orders", raw.where(F.col("_ingested_at") == T.delivered(2)))
    return merge_silver("orders", first, second).select("order_id", "customer_id", "status", "total_amount")
