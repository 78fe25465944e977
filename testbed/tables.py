"""The given tables in the shape of the shop's raw tables.

Every column is text, as it arrives in bronze, with the faults real sources
have: padding, mixed case, unreadable numbers and dates, missing values,
unknown references, repeated deliveries. All rows of the given tables are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, ShortType, TimestampType

from stockpond.contracts import COUNTRY_NAMES
from stockpond.functions.money import money
from stockpond.operators.numbering import number_rows
from stockpond.plans import dimensions, facts, silver
from stockpond.sources import spread_rows

AS_OF = "2001-08-02"
CLOCK_COLUMNS = ("_processed_at", "_created_at")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spread_rows(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def comparable(df: DataFrame) -> DataFrame:
    """Without clock columns, with plain timestamps and bigint integers."""
    kept = []
    for f in df.schema.fields:
        if f.name in CLOCK_COLUMNS:
            continue
        column = F.col(f.name)
        if isinstance(f.dataType, TimestampType):
            column = column.cast("timestamp_ntz").alias(f.name)
        elif isinstance(f.dataType, (IntegerType, ShortType)):
            column = column.cast("bigint").alias(f.name)
        kept.append(column)
    return df.select(*kept)


def every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def code(prefix: str, key: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), width, "0"))


def customer_id(key: str) -> Column:
    return code("CUST-", key, 9)


def product_id(key: str) -> Column:
    return code("PROD-", key, 9)


def order_id(key: str) -> Column:
    return code("ORD-", key, 12)


def country_code(nation_key: str, otherwise: Column) -> Column:
    codes = F.array(*[F.lit(code) for code, _ in COUNTRY_NAMES])
    known = F.col(nation_key) < len(COUNTRY_NAMES)
    return F.when(known, F.element_at(codes, F.col(nation_key).cast("int") + 1)).otherwise(otherwise)


def day_text(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int")).cast("string")


def delivered(day: int) -> Column:
    return F.lit(f"2001-08-{day:02d} 06:00:00").cast("timestamp")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery per customer, and an older one for every third."""
    key, nation = "c_custkey", load(spark, sf_dir, "nation")
    deliveries = F.when(every(key, 3), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    people = (
        load(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("delivery", F.explode(deliveries))
    )
    email = (
        F.when(every(key, 11), None)
        .when(every(key, 7), F.concat(F.lit("User"), key, F.lit("-at-nowhere")))
        .when(every(key, 13), F.concat(F.lit("user"), key, F.lit("@one@Two.org")))
        .otherwise(F.concat(F.lit("  User"), key, F.lit("@Example"), "c_nationkey", F.lit(".COM ")))
    )
    joined_on = F.col(key) % 2400
    return people.select(
        customer_id(key).alias("customer_id"),
        email.alias("email"),
        F.when(~every(key, 13), F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))).alias("first_name"),
        F.col("n_name").alias("last_name"),
        F.concat(code("+49 ", key, 9), F.lit(" ")).alias("phone"),
        F.concat(F.lit(" "), F.lower(country_code("c_nationkey", F.col("n_name")))).alias("country"),
        F.when(F.col("delivery") == 1, "Old Town")
        .otherwise(F.concat(F.lit(" City "), (F.col(key) % 7).cast("string"))).alias("city"),
        F.when(~every(key, 4), F.concat(F.col("c_name"), F.lit(" Street "))).alias("address"),
        F.when(every(key, 17), "not-a-date").otherwise(day_text("1995-01-01", joined_on)).alias("created_at"),
        F.when(~every(key, 5), day_text("1995-01-31", joined_on)).alias("updated_at"),
        F.when(F.col("delivery") == 1, delivered(1)).otherwise(delivered(2)).alias("_ingested_at"),
        F.lit("customers.csv").alias("_source_file"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "p_partkey"
    price = money(F.col("p_retailprice") * F.col("p_size") / 50)
    cost = money(price * (F.lit(0.4) + F.lit(0.01) * (F.col(key) % 40)))
    flag = F.element_at(
        F.array(F.lit("True"), F.lit("1"), F.lit("YES"), F.lit("False"), F.lit(None).cast("string")),
        (F.col(key) % 5 + 1).cast("int"),
    )
    return load(spark, sf_dir, "part").select(
        product_id(key).alias("product_id"),
        F.concat(F.lit(" sku-"), (F.col(key) - F.col(key) % 2).cast("string"), F.lit(" ")).alias("sku"),
        F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("name"),
        F.when(~every(key, 5), F.concat(F.col("p_name"), F.lit(" from stock"))).alias("description"),
        F.concat(F.lit(" "), "p_type").alias("category"),
        F.concat(F.col("p_type"), F.lit(" "), "p_brand", F.lit(" ")).alias("subcategory"),
        F.concat(F.col("p_brand"), F.lit("  ")).alias("brand"),
        F.when(every(key, 101), "n/a").when(every(key, 103), "0").otherwise(price.cast("string")).alias("price"),
        F.when(~every(key, 107), cost.cast("string")).alias("cost"),
        F.when(~every(key, 109), ((F.col("p_size") - 1) * 2).cast("string")).alias("stock_quantity"),
        flag.alias("is_active"),
        day_text("1994-01-01", F.col(key) % 300).alias("created_at"),
        delivered(2).alias("_ingested_at"),
        F.lit("products.csv").alias("_source_file"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery per order, and an earlier, still pending one for open orders."""
    key, buyer = "o_orderkey", "o_custkey"
    deliveries = F.when(F.col("o_orderstatus") == "O", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    subtotal = F.col("subtotal")
    parts = F.col("subtotal") + F.col("tax") + F.col("shipping") - F.col("discount")
    total = money(parts + F.when(every(key, 5), 0.02).otherwise(0.0))
    status = (
        F.when(F.col("delivery") == 1, "pending")
        .when(every(key, 29), "LOST")
        .when(every(key, 31), None)
        .when(F.col("o_orderstatus") == "F", "DELIVERED ")
        .when(F.col("o_orderstatus") == "O", " Shipped")
        .otherwise("Confirmed")
    )
    payment = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Credit_Card")
        .when(F.col("o_orderpriority") == "2-HIGH", " debit_card")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "PayPal")
        .when(F.col("o_orderpriority") == "5-LOW", "bank_transfer ")
        .otherwise("Voucher")
    )
    placed = load(spark, sf_dir, "orders").withColumns({
        "delivery": F.explode(deliveries),
        "ship_to": F.col(buyer) % len(COUNTRY_NAMES),
        "subtotal": F.when(every(key, 43), 0.0).otherwise(money(F.col("o_totalprice") / 4000)),
    }).withColumns({
        "tax": money(subtotal * 0.19),
        "shipping": F.when(every(key, 4), 4.99).otherwise(0.0),
        "discount": F.when(subtotal > 100, money(subtotal * 0.05)).otherwise(0.0),
    })
    return placed.select(
        order_id(key).alias("order_id"),
        F.when(every(key, 41), "CUST-UNKNOWN").when(~every(buyer, 10), customer_id(buyer)).alias("customer_id"),
        F.when(every(key, 211), "unknown").otherwise(F.col("o_orderdate").cast("string")).alias("order_date"),
        status.alias("status"),
        payment.alias("payment_method"),
        subtotal.cast("string").alias("subtotal"),
        F.when(~every(key, 37), F.col("tax").cast("string")).alias("tax_amount"),
        F.col("shipping").cast("string").alias("shipping_amount"),
        F.col("discount").cast("string").alias("discount_amount"),
        total.cast("string").alias("total_amount"),
        F.lit("EUR").alias("currency"),
        F.concat(F.lower(country_code("ship_to", F.lit(""))), F.lit(" ")).alias("shipping_country"),
        F.concat(F.lit("City "), (F.col(buyer) % 7).cast("string")).alias("shipping_city"),
        F.when(F.col("delivery") == 1, delivered(1)).otherwise(delivered(2)).alias("_ingested_at"),
        F.lit("orders.csv").alias("_source_file"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; a line number occurs more than once in an order, the last shipped one counts."""
    supplier = "l_suppkey"
    unit_price = money(F.col("l_extendedprice") / F.col("l_quantity"))
    line_total = money(F.col("l_quantity") * F.col("price") * (1 - F.col("l_discount")))
    off_by = F.when(every(supplier, 61), 0.02).otherwise(0.0)
    product = (
        F.when(every(supplier, 50), "PROD-UNKNOWN").when(~every(supplier, 53), product_id("l_partkey"))
    )
    return load(spark, sf_dir, "lineitem").withColumn("price", unit_price).select(
        F.concat(code("ITEM-", "l_orderkey", 12), F.lit("-"), F.col("l_linenumber").cast("string")).alias("order_item_id"),
        F.when(every(supplier, 47), "ORD-UNKNOWN").otherwise(order_id("l_orderkey")).alias("order_id"),
        product.alias("product_id"),
        F.when(every(supplier, 59), "0").when(every(supplier, 67), "many")
        .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.col("price").cast("string").alias("unit_price"),
        money(F.col("l_discount") * 100).cast("string").alias("discount_percent"),
        money(line_total + off_by).cast("string").alias("line_total"),
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"),
        F.lit("order_items.csv").alias("_source_file"),
    )


RAW = {
    "customers": raw_customers,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
}


def silver_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return silver.build_silver(table, RAW[table](spark, sf_dir), AS_OF)


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_product(silver_table(spark, sf_dir, "products"))


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_customer(
        silver_table(spark, sf_dir, "customers"), silver_table(spark, sf_dir, "orders"), AS_OF
    )


def sales(spark: SparkSession, sf_dir: str, products: DataFrame | None = None) -> DataFrame:
    """Sales lines with dimension keys, before numbering."""
    return facts.sales_lines(
        silver_table(spark, sf_dir, "order_items"),
        silver_table(spark, sf_dir, "orders"),
        customer_keys(spark, sf_dir),
        product_dim(spark, sf_dir) if products is None else products,
    )


def customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer ids with the surrogate keys of the customer dimension."""
    ids = silver_table(spark, sf_dir, "customers").select("customer_id")
    return number_rows(ids, "customer_key", ["customer_id"])
