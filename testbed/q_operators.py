"""Column, filter, dedup, key and join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockpond.functions import add_amounts, money, parse_flag, percent_of, sum_cents, sum_exact, within_cent
from stockpond.operators import (
    cast_columns,
    drop_incomplete,
    earliest_per_key,
    latest_per_key,
    missing_keys,
    number_rows,
    number_rows_sparse,
    rank_within,
    salted_join,
    trim_columns,
)
from stockpond.plans.silver import deduplicate
from testbed import sql as S
from testbed import tables as T
from testbed.registry import query


@query("cast_columns", S.with_tables(S.RAW_ITEMS, """
    SELECT order_item_id, TRY_CAST(quantity_text AS BIGINT) AS quantity, unit_price, discount_percent, line_total
    FROM raw_items"""))
def cast_text(spark, sf_dir):
    items = T.raw_order_items(spark, sf_dir).select(
        "order_item_id", "quantity", "unit_price", "discount_percent", "line_total"
    )
    return cast_columns(items, {
        "quantity": "bigint", "unit_price": "double", "discount_percent": "double", "line_total": "double",
        "not_a_column": "int",
    })


@query("null_safe_trim", """
    SELECT 'PROD-' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS product_id, trim(' ' || p_name || ' ') AS name,
      trim(p_brand || '  ') AS brand, CASE WHEN p_partkey % 5 <> 0 THEN p_name || ' from stock' END AS description
    FROM part""")
def null_safe_trim(spark, sf_dir):
    products = T.raw_products(spark, sf_dir).select("product_id", "name", "brand", "description")
    return trim_columns(products, ["name", "brand", "description", "not_a_column"])


@query("filter_not_null", S.with_tables(S.RAW_ITEMS, """
    SELECT order_item_id, order_id, product_id, CAST(NULLIF(quantity_text, 'many') AS BIGINT) AS quantity
    FROM raw_items WHERE product_id IS NOT NULL AND quantity_text <> 'many'"""))
def filter_not_null(spark, sf_dir):
    items = T.raw_order_items(spark, sf_dir).select("order_item_id", "order_id", "product_id", "quantity")
    return drop_incomplete(cast_columns(items, {"quantity": "bigint"}), ["product_id", "quantity"])


@query("predicates", S.with_tables(S.SILVER_ORDERS, """
    SELECT order_id, customer_id IS NULL AS is_guest, order_date IS NOT NULL AS is_dated,
      status IN ('shipped', 'delivered') AS is_sent, NOT status IN ('shipped', 'delivered') AS is_open,
      subtotal >= 20 AND subtotal <= 100 AS is_usual, NOT (subtotal >= 20 AND subtotal <= 100) AS is_unusual,
      regexp_matches(payment_method, '_card$') AS is_card, payment_method <> 'voucher' AS is_money
    FROM silver_orders
    WHERE is_total_valid IS NOT NULL AND (status IS NULL OR status <> 'lost')"""))
def predicates(spark, sf_dir):
    sent, usual = F.col("status").isin("shipped", "delivered"), F.col("subtotal").between(20, 100)
    orders = T.silver_table(spark, sf_dir, "orders")
    return orders.where(
        F.col("is_total_valid").isNotNull() & (F.col("status").isNull() | (F.col("status") != "lost"))
    ).select(
        "order_id",
        F.col("customer_id").isNull().alias("is_guest"),
        F.col("order_date").isNotNull().alias("is_dated"),
        sent.alias("is_sent"),
        (~sent).alias("is_open"),
        usual.alias("is_usual"),
        (~usual).alias("is_unusual"),
        F.col("payment_method").rlike("_card$").alias("is_card"),
        (F.col("payment_method") != "voucher").alias("is_money"),
    )


@query("parse_flags", """
    SELECT 'PROD-' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS product_id, p_partkey % 5 IN (0, 1, 2) AS is_active
    FROM part""")
def parse_flags(spark, sf_dir):
    return T.raw_products(spark, sf_dir).select("product_id", parse_flag("is_active").alias("is_active"))


@query("distinct_lookup", S.with_tables(S.SILVER_PRODUCTS, "SELECT DISTINCT product_id, cost FROM silver_products"))
def distinct_lookup(spark, sf_dir):
    return T.silver_table(spark, sf_dir, "products").select("product_id", "cost").distinct()


@query("dedup_orders", S.with_tables(S.SILVER_ORDERS, "SELECT order_id, customer_id, status FROM silver_orders"))
def dedup_orders(spark, sf_dir):
    kept = deduplicate(T.raw_orders(spark, sf_dir), "orders")
    return kept.select("order_id", "customer_id", F.lower(F.trim("status")).alias("status"))


@query("dedup_order_items", S.with_tables(S.SILVER_ITEMS, """
    SELECT order_item_id, order_id, product_id, unit_price, _ingested_at FROM silver_items"""))
def dedup_order_items(spark, sf_dir):
    kept = deduplicate(T.raw_order_items(spark, sf_dir), "order_items")
    return T.comparable(kept.select(
        "order_item_id", "order_id", "product_id", F.col("unit_price").try_cast("double").alias("unit_price"),
        "_ingested_at",
    ))


@query("dedup_latest", """
    SELECT user_id, event_type, event_id, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS n
      FROM events) WHERE n = 1""")
def dedup_latest(spark, sf_dir):
    events = T.load(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return latest_per_key(events, ["user_id", "event_type"], ["ts"])


@query("dedup_earliest", """
    SELECT user_id, event_type, event_id, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id DESC) AS n
      FROM events) WHERE n = 1""")
def dedup_earliest(spark, sf_dir):
    events = T.load(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return earliest_per_key(events, ["user_id", "event_type"], ["ts"])


@query("surrogate_keys", """
    SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_key, o_orderkey, o_orderdate FROM orders""")
def surrogate_keys(spark, sf_dir):
    orders = T.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return number_rows(orders, "order_key", ["o_orderdate", "o_orderkey"])


@query("surrogate_keys_unordered", """
    SELECT count(*) AS rows, 1::BIGINT AS first_key, count(*) AS last_key, count(*) AS keys FROM lineitem""")
def surrogate_keys_unordered(spark, sf_dir):
    """Arrival order is not defined, so the check is that the keys are exactly 1..n."""
    numbered = number_rows(T.load(spark, sf_dir, "lineitem"), "line_key")
    return numbered.agg(
        F.count(F.lit(1)).alias("rows"), F.min("line_key").alias("first_key"), F.max("line_key").alias("last_key"),
        F.count_distinct("line_key").alias("keys"),
    )


@query("sparse_ids", """
    SELECT count(*) AS rows, count(*) AS keys, true AS positive FROM lineitem""")
def sparse_ids(spark, sf_dir):
    """Values are free, so the check is that they are unique and positive."""
    numbered = number_rows_sparse(T.load(spark, sf_dir, "lineitem"), "line_key")
    return numbered.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("line_key").alias("keys"),
        (F.min("line_key") > 0).alias("positive"),
    )


@query("surrogate_lookup_join", S.with_tables(S.SILVER_CUSTOMERS + "," + S.SILVER_ORDERS, """
    SELECT order_id, customer_key FROM silver_orders JOIN (
      SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key FROM silver_customers)
    USING (customer_id)"""))
def surrogate_lookup_join(spark, sf_dir):
    orders = T.silver_table(spark, sf_dir, "orders").select("order_id", "customer_id")
    return orders.join(T.customer_keys(spark, sf_dir), "customer_id").select("order_id", "customer_key")


@query("skewed_lookup_join", """
    SELECT e.event_id, e.event_type, u.events AS events_of_type
    FROM events e JOIN (SELECT event_type, count(*) AS events FROM events GROUP BY event_type) u USING (event_type)""")
def skewed_lookup_join(spark, sf_dir):
    """Few event types, each with a large share of the rows: every key is hot."""
    events = T.load(spark, sf_dir, "events").select("event_id", "event_type")
    per_type = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events_of_type"))
    return salted_join(events, per_type, "event_type").select("event_id", "event_type", "events_of_type")


@query("missing_references", S.with_tables(S.SILVER_ITEMS + "," + S.SILVER_PRODUCTS, """
    SELECT DISTINCT product_id FROM silver_items
    WHERE product_id IS NULL OR product_id NOT IN (SELECT product_id FROM silver_products)"""))
def missing_references(spark, sf_dir):
    return missing_keys(
        T.silver_table(spark, sf_dir, "order_items"), "product_id",
        T.silver_table(spark, sf_dir, "products"), "product_id",
    )


@query("rank_within_group", """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_returnflag, l_extendedprice,
      row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
        l_partkey, l_suppkey) AS price_rank
    FROM lineitem""")
def rank_within_group(spark, sf_dir):
    """Three return flags hold a third of the lines each; every line gets its rank."""
    lines = T.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice"
    )
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
             F.col("l_suppkey")]
    return T.comparable(rank_within(lines, ["l_returnflag"], order, "price_rank", ties=True))


@query("ratio_rounding", """
    WITH shares AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(round(l_extendedprice * 100) AS HUGEINT) AS part, CAST(round(o_totalprice * 100) AS HUGEINT) AS whole
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN whole > 0 THEN CAST((20000 * part + whole) // (2 * whole) AS DOUBLE) / 100 ELSE 0.0::DOUBLE END AS share
    FROM shares""")
def ratio_rounding(spark, sf_dir):
    """Shares of lines in their orders to two places; the twin divides whole cents exactly."""
    lines, orders = T.load(spark, sf_dir, "lineitem"), T.load(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", percent_of("l_extendedprice", "o_totalprice").alias("share"))


@query("money_extremes", """
    WITH amounts AS (
      SELECT l_returnflag, l_linenumber % 2 = 0 AS even, CAST(round(l_extendedprice * 100) AS HUGEINT) * 10000000 AS whole
      FROM lineitem),
    big AS (
      SELECT *, CAST(whole AS DECIMAL(38, 2)) + CASE WHEN even THEN 0.37 ELSE -0.12 END AS exact FROM amounts)
    SELECT l_returnflag, count(*) AS rows, CAST(sum(whole) AS DOUBLE) AS total,
      count(*) FILTER (WHERE whole >= 9200000000000) AS beyond,
      max(CAST(exact AS DOUBLE)) AS highest, min(CAST(exact AS DOUBLE)) AS lowest,
      CAST(0 AS BIGINT) AS lost, CAST(sum(whole * 10) AS DOUBLE) AS added,
      count(*) FILTER (WHERE even) AS apart
    FROM big GROUP BY l_returnflag""")
def money_extremes(spark, sf_dir):
    """Amounts from billions to trillions of millions: none gets lost in rounding, sums and comparisons."""
    price = F.round(F.col("l_extendedprice") * 100, 0).cast("decimal(20,0)") * 10_000_000
    even = F.col("l_linenumber") % 2 == 0
    cents = F.when(even, F.lit(0.37).cast("decimal(3,2)")).otherwise(F.lit(-0.12).cast("decimal(3,2)"))
    big = T.load(spark, sf_dir, "lineitem").select(
        "l_returnflag", even.alias("even"), price.cast("double").alias("whole"), (price + cents).cast("double").alias("exact"))
    near = F.when(F.col("even"), F.col("whole") + 1).otherwise(F.col("whole"))
    return big.select(
        "*", money("exact").alias("rounded"), within_cent("whole", near).alias("same"),
        add_amounts(["whole"] * 11, ["whole"]).alias("ten")).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"), sum_cents("whole").alias("total"),
        F.count_if(F.col("whole") >= 9_200_000_000_000).alias("beyond"),
        F.max("rounded").alias("highest"), F.min("rounded").alias("lowest"),
        F.count_if(F.col("rounded").isNull() | F.col("ten").isNull()).alias("lost"), sum_exact("ten").alias("added"),
        F.count_if(~F.col("same")).alias("apart"))
