"""Silver tables, dimensions, fact and business tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockpond.functions.money import money
from stockpond.operators import merge_history
from stockpond.operators.numbering import number_rows
from stockpond.contracts import LakeConfig
from stockpond.plans import dimensions, facts, lake, marts
from stockpond.session import scratch_path, stage
from stockpond.sources import read_layer, replace_table, write_table
from testbed import sql as S
from testbed import tables as T
from testbed.registry import query

SILVER_SQL = {
    "silver_customers": (
        S.SILVER_CUSTOMERS,
        "SELECT customer_id, email, email_domain, is_valid_email, first_name, last_name, full_name, phone, country, "
        "city, address, created_at, updated_at, account_age_days, segment, _source_file, _ingested_at "
        "FROM silver_customers",
    ),
    "silver_products": (S.SILVER_PRODUCTS, "SELECT * FROM silver_products"),
    "silver_orders": (S.SILVER_ORDERS, "SELECT * FROM silver_orders"),
    "silver_order_items": (S.SILVER_ITEMS, "SELECT * FROM silver_items"),
}


@query("silver_customers", S.with_tables(*SILVER_SQL["silver_customers"]))
def silver_customers(spark, sf_dir):
    return T.comparable(T.silver_table(spark, sf_dir, "customers"))


@query("silver_products", S.with_tables(*SILVER_SQL["silver_products"]))
def silver_products(spark, sf_dir):
    return T.comparable(T.silver_table(spark, sf_dir, "products"))


@query("silver_orders", S.with_tables(*SILVER_SQL["silver_orders"]))
def silver_orders(spark, sf_dir):
    return T.comparable(T.silver_table(spark, sf_dir, "orders"))


@query("silver_order_items", S.with_tables(*SILVER_SQL["silver_order_items"]))
def silver_order_items(spark, sf_dir):
    return T.comparable(T.silver_table(spark, sf_dir, "order_items"))


@query("order_totals_rollup", S.with_tables(
    S.SILVER_ITEMS + "," + S.SILVER_ORDERS + "," + S.SILVER_CUSTOMERS + f""",
    sums AS (SELECT order_id, {S.add_up('line_total', 6)} AS lines FROM silver_items GROUP BY order_id),
    priced AS (
      SELECT o.order_id, o.customer_id, country, lines AS subtotal,
        {S.cents("lines * CASE WHEN country IN ('NL', 'BE') THEN 0.21::DOUBLE ELSE 0.19::DOUBLE END")} AS tax_amount,
        CASE WHEN lines > 50 THEN 0.0::DOUBLE ELSE {S.cents('o.shipping_amount')} END AS shipping_amount,
        CASE WHEN lines > 200 THEN {S.cents('lines * 0.05::DOUBLE')} ELSE 0.0::DOUBLE END AS discount_amount
      FROM silver_orders o LEFT JOIN silver_customers c ON o.customer_id = c.customer_id
        JOIN sums s ON o.order_id = s.order_id)""",
    f"""SELECT order_id, customer_id, country, {S.cents('subtotal')} AS subtotal, tax_amount, shipping_amount,
      discount_amount, {S.cents('subtotal + tax_amount + shipping_amount - discount_amount')} AS total_amount,
      'EUR' AS currency FROM priced"""))
def order_totals_rollup(spark, sf_dir):
    orders = T.silver_table(spark, sf_dir, "orders").withColumnRenamed("shipping_amount", "shipping_quote")
    return T.comparable(facts.order_totals(
        T.silver_table(spark, sf_dir, "order_items"), orders, T.silver_table(spark, sf_dir, "customers")
    ))


def date_dimension(spark, sf_dir):
    return dimensions.dim_date(dimensions.calendar_covering(T.load(spark, sf_dir, "orders"), "o_orderdate"))


@query("dim_date", S.with_tables(S.DATES, "SELECT * FROM dim_date"))
def dim_date(spark, sf_dir):
    return T.comparable(date_dimension(spark, sf_dir))


@query("dim_date_holidays", S.with_tables(S.DATES, """
    SELECT date, date_key, day_of_week, isodow(date) AS iso_day_of_week, holiday_name,
      holiday_name IS NOT NULL AS is_holiday
    FROM (SELECT *, CASE WHEN month = 1 AND day_of_month = 1 THEN 'New Year'
                         WHEN month = 5 AND day_of_month = 1 THEN 'Labour Day'
                         WHEN month = 12 AND day_of_month = 25 THEN 'Christmas Day'
                         WHEN month = 12 AND day_of_month = 26 THEN 'Second Christmas Day' END AS holiday_name
          FROM dim_date)"""))
def dim_date_holidays(spark, sf_dir):
    dates = date_dimension(spark, sf_dir)
    month_day = F.date_format("date", "MM-dd")
    name = (
        F.when(month_day == "01-01", "New Year").when(month_day == "05-01", "Labour Day")
        .when(month_day == "12-25", "Christmas Day").when(month_day == "12-26", "Second Christmas Day")
    )
    holidays = dates.select("date", name.alias("holiday_name")).where(F.col("holiday_name").isNotNull())
    return T.comparable(dimensions.with_holidays(dates, holidays)).select(
        "date", "date_key", "day_of_week", "iso_day_of_week", "holiday_name", "is_holiday"
    )


@query("dim_product", S.with_tables(S.DIM_PRODUCT, "SELECT * FROM dim_product"))
def dim_product(spark, sf_dir):
    return T.comparable(T.product_dim(spark, sf_dir))


@query("dim_customer", S.with_tables(S.DIM_CUSTOMER, "SELECT * FROM dim_customer"))
def dim_customer(spark, sf_dir):
    return T.comparable(T.customer_dim(spark, sf_dir))


@query("customer_metrics", S.with_tables(S.CUSTOMER_METRICS, "SELECT * FROM customer_metrics"))
def customer_metrics(spark, sf_dir):
    return T.comparable(dimensions.customer_metrics(T.silver_table(spark, sf_dir, "orders")))


@query("behavior_segment", S.with_tables(S.PROFILES, """
    SELECT customer_id, customer_status, value_tier, segment,
      CASE WHEN customer_status = 'churned' THEN 'inactive' WHEN value_tier = 'platinum' THEN 'vip'
           WHEN segment = 'new' THEN 'new' ELSE 'regular' END AS behavior_segment
    FROM profiles"""))
def behavior_segment(spark, sf_dir):
    profiles = dimensions.customer_profiles(
        T.silver_table(spark, sf_dir, "customers"), T.silver_table(spark, sf_dir, "orders"), T.AS_OF
    )
    return dimensions.with_behavior_segment(profiles).select(
        "customer_id", "customer_status", "value_tier", "segment", "behavior_segment"
    )


@query("country_name_lookup", S.with_tables(S.SILVER_CUSTOMERS, """
    SELECT customer_id, country, CASE country WHEN 'DE' THEN 'Germany' WHEN 'FR' THEN 'France'
      WHEN 'GB' THEN 'United Kingdom' WHEN 'ES' THEN 'Spain' WHEN 'IT' THEN 'Italy' WHEN 'NL' THEN 'Netherlands'
      WHEN 'PL' THEN 'Poland' WHEN 'BE' THEN 'Belgium' WHEN 'AT' THEN 'Austria' WHEN 'PT' THEN 'Portugal' END
      AS country_name FROM silver_customers"""))
def country_name_lookup(spark, sf_dir):
    customers = T.silver_table(spark, sf_dir, "customers").select("customer_id", "country")
    return dimensions.with_country_name(customers).select("customer_id", "country", "country_name")


@query("fact_sales", S.with_tables(S.FACT, "SELECT * FROM fact"))
def fact_sales(spark, sf_dir):
    return T.comparable(number_rows(T.sales(spark, sf_dir), "sale_key", ["order_item_id"]))


@query("allocation_residual", S.with_tables(S.FACT, f"""
    SELECT f.order_id, {S.cents('tax_amount - tax')} AS tax_residual,
      {S.cents('shipping_amount - shipping')} AS shipping_residual
    FROM (SELECT order_id, {S.add_up('allocated_tax')} AS tax, {S.add_up('allocated_shipping')} AS shipping
          FROM fact GROUP BY order_id) f JOIN silver_orders o ON f.order_id = o.order_id"""))
def allocation_residual(spark, sf_dir):
    return facts.allocation_residuals(T.sales(spark, sf_dir), T.silver_table(spark, sf_dir, "orders"))


SALES_MEASURES = f"""count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_items_sold,
      {S.add_up('gross_revenue')} AS gross_revenue, {S.add_up('net_revenue')} AS net_revenue,
      {S.add_up('profit')} AS total_profit,
      {S.add_up('profit_margin_pct')} / count(profit_margin_pct) AS avg_profit_margin,
      count(DISTINCT customer_key) AS unique_customers"""


def sales_sql(group: str) -> str:
    return S.with_tables(S.FACT, f"""
    SELECT *, {S.cents('net_revenue / total_orders')} AS avg_order_value,
      {S.cents('total_items_sold / total_orders')} AS items_per_order
    FROM (SELECT {group}, shipping_country, {SALES_MEASURES} FROM fact GROUP BY ALL)""")


@query("daily_sales", sales_sql("date_key"))
def daily_sales(spark, sf_dir):
    return T.comparable(marts.daily_sales(T.sales(spark, sf_dir)))


@query("weekly_sales", sales_sql("CAST(date_trunc('week', order_date) AS DATE) AS period_start"))
def weekly_sales(spark, sf_dir):
    return T.comparable(marts.sales_by_period(T.sales(spark, sf_dir), "week"))


@query("monthly_sales", sales_sql("CAST(date_trunc('month', order_date) AS DATE) AS period_start"))
def monthly_sales(spark, sf_dir):
    return T.comparable(marts.sales_by_period(T.sales(spark, sf_dir), "month"))


PRODUCT_TOTALS = S.FACT + f""",
product_totals AS (
  SELECT product_id, name, category, subcategory, brand, total_quantity_sold, total_revenue, total_profit,
    number_of_orders, unique_customers, avg_selling_price, avg_discount_pct,
    CASE WHEN total_revenue > 0 THEN {S.cents('total_profit / total_revenue * 100')}
         ELSE 0.0::DOUBLE END AS profit_margin_pct,
    row_number() OVER (PARTITION BY category ORDER BY total_revenue DESC NULLS LAST, product_id) AS position
  FROM (
    SELECT product_key, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
      {S.add_up('net_revenue')} AS total_revenue, {S.add_up('profit')} AS total_profit,
      count(DISTINCT order_id) AS number_of_orders, count(DISTINCT customer_key) AS unique_customers,
      {S.add_up('unit_price')} / count(unit_price) AS avg_selling_price,
      {S.add_up('discount_percent')} / count(discount_percent) AS avg_discount_pct
    FROM fact GROUP BY product_key) JOIN dim_product USING (product_key))"""


@query("product_performance", S.with_tables(
    PRODUCT_TOTALS, "SELECT * EXCLUDE (position), position AS revenue_rank_in_category FROM product_totals"))
def product_performance(spark, sf_dir):
    products = T.product_dim(spark, sf_dir)
    return T.comparable(marts.product_performance(T.sales(spark, sf_dir, products), products))


@query("top_products", S.with_tables(PRODUCT_TOTALS, """
    SELECT category, position AS rank, product_id, name, total_revenue, total_quantity_sold
    FROM product_totals WHERE position <= 10"""))
def top_products(spark, sf_dir):
    products = T.product_dim(spark, sf_dir)
    return T.comparable(marts.top_products(T.sales(spark, sf_dir, products), products, 10))


@query("best_sellers", S.with_tables(PRODUCT_TOTALS, """
    SELECT product_id, name, category, total_revenue, total_quantity_sold FROM product_totals
    ORDER BY total_revenue DESC NULLS LAST, product_id LIMIT 10"""))
def best_sellers(spark, sf_dir):
    products = T.product_dim(spark, sf_dir)
    return T.comparable(marts.best_sellers(T.sales(spark, sf_dir, products), products, 10))


@query("daily_revenue", S.with_tables(
    S.FACT, f"SELECT date_key, {S.add_up('net_revenue')} AS daily_revenue FROM fact GROUP BY date_key"))
def daily_revenue(spark, sf_dir):
    return T.comparable(marts.daily_revenue(T.sales(spark, sf_dir)))


@query("orders_per_customer", S.with_tables(S.FACT, f"""
    SELECT total_orders, total_customers, {S.cents('total_orders / total_customers')} AS orders_per_customer
    FROM (SELECT count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_key) AS total_customers FROM fact)
    """))
def orders_per_customer(spark, sf_dir):
    return marts.orders_per_customer(T.sales(spark, sf_dir))


@query("customer_lifetime_value", S.with_tables(S.SILVER_ORDERS, f"""
    SELECT customer_id, coalesce({S.add_up('total_amount', 6)}, 0.0::DOUBLE) AS customer_lifetime_value
    FROM silver_orders WHERE customer_id IS NOT NULL GROUP BY customer_id"""))
def customer_lifetime_value(spark, sf_dir):
    return marts.customer_lifetime_value(T.silver_table(spark, sf_dir, "orders"))


@query("category_performance", S.with_tables(S.FACT + "," + S.DATES, f"""
    SELECT category, year_month, revenue, profit, items_sold,
      CASE WHEN revenue > 0 THEN {S.cents('profit / revenue * 100')} ELSE 0.0::DOUBLE END AS profit_margin_pct
    FROM (SELECT category, year_month, {S.add_up('net_revenue')} AS revenue, {S.add_up('profit')} AS profit,
            CAST(sum(quantity) AS BIGINT) AS items_sold
          FROM fact JOIN dim_product USING (product_key) LEFT JOIN dim_date USING (date_key)
          GROUP BY category, year_month)"""))
def category_performance(spark, sf_dir):
    products = T.product_dim(spark, sf_dir)
    return marts.category_performance(T.sales(spark, sf_dir, products), products, date_dimension(spark, sf_dir))


@query("category_performance_short_calendar", S.with_tables(S.FACT, f"""
    SELECT category, year_month, revenue, profit, items_sold,
      CASE WHEN revenue > 0 THEN {S.cents('profit / revenue * 100')} ELSE 0.0::DOUBLE END AS profit_margin_pct
    FROM (SELECT category, strftime(order_date, '%Y-%m') AS year_month, {S.add_up('net_revenue')} AS revenue,
            {S.add_up('profit')} AS profit, CAST(sum(quantity) AS BIGINT) AS items_sold
          FROM fact JOIN dim_product USING (product_key) GROUP BY category, year_month)"""))
def category_performance_short_calendar(spark, sf_dir):
    """Sales outside the calendar are kept: it ends with 1996 here."""
    products = T.product_dim(spark, sf_dir)
    days = dimensions.dim_date(dimensions.calendar(spark, 1995, 1996))
    return marts.category_performance(T.sales(spark, sf_dir, products), products, days)


@query("business_totals", S.with_tables(S.FACT, f"""
    SELECT *, {S.cents('total_profit / total_revenue * 100')} AS profit_margin_pct
    FROM (SELECT count(*) AS fact_rows, {S.add_up('net_revenue')} AS total_revenue,
            {S.add_up('profit')} AS total_profit FROM fact)"""))
def business_totals(spark, sf_dir):
    return marts.business_totals(T.sales(spark, sf_dir))


@query("fact_orphan_keys", S.with_tables(S.FACT, """
    SELECT 'customer_key' AS key, count(*) AS fact_rows,
      count(*) FILTER (WHERE f.customer_key IS NULL) AS null_keys,
      count(*) FILTER (WHERE d.customer_key IS NULL) AS orphan_rows
    FROM fact f LEFT JOIN (SELECT customer_key FROM dim_customer WHERE is_valid_email) d
      ON f.customer_key = d.customer_key
    UNION ALL
    SELECT 'product_key', count(*), count(*) FILTER (WHERE f.product_key IS NULL),
      count(*) FILTER (WHERE d.product_key IS NULL)
    FROM fact f LEFT JOIN dim_product d ON f.product_key = d.product_key"""))
def fact_orphan_keys(spark, sf_dir):
    """The customer side is checked against reachable customers, so that there are orphans to find."""
    products, customers = T.product_dim(spark, sf_dir), T.customer_dim(spark, sf_dir)
    fact = facts.sales_lines(
        T.silver_table(spark, sf_dir, "order_items"), T.silver_table(spark, sf_dir, "orders"), customers, products
    )
    return facts.orphan_keys(
        fact, [(customers.where("is_valid_email"), "customer_key"), (products, "product_key")]
    )


PARTNER_HISTORY = """
    WITH partners AS (
      SELECT c_custkey, 'CUST-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS partner_id, c_name AS name,
        c_nationkey AS nation, c_acctbal < 0 AS moved FROM customer),
    delivered AS (
      SELECT partner_id, name, CASE WHEN moved THEN 'moved' ELSE 'nation ' || nation END AS place FROM partners
      UNION ALL
      SELECT 'SUPP-' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0'), s_name, 'nation ' || s_nationkey FROM supplier),
    existing AS (
      SELECT row_number() OVER (ORDER BY partner_id) AS partner_key, partner_id, name, 'nation ' || nation AS place,
        moved FROM partners),
    opened AS (
      SELECT d.* FROM delivered d LEFT JOIN existing e USING (partner_id)
      WHERE e.partner_id IS NULL OR e.name <> d.name OR e.place <> d.place)
    SELECT partner_key, partner_id, name, place, TIMESTAMP '2001-01-01' AS effective_from,
      CASE WHEN moved THEN TIMESTAMP '2001-08-02' END AS effective_to, NOT moved AS is_current FROM existing
    UNION ALL
    SELECT (SELECT count(*) FROM existing) + row_number() OVER (ORDER BY partner_id), partner_id, name, place,
      TIMESTAMP '2001-08-02', NULL, true FROM opened"""


@query("scd2_merge", PARTNER_HISTORY)
def scd2_merge(spark, sf_dir):
    """Customers as first loaded; a delivery moves those in debt and brings the suppliers as new partners."""
    first_load, delivery = partners(spark, sf_dir)
    return T.comparable(merge_history(first_load, delivery, "partner_id", "partner_key", ["name", "place"], T.AS_OF))


@query("history_second_load", PARTNER_HISTORY)
def history_second_load(spark, sf_dir):
    """The same history as a table that is replaced by its next state, read back from there."""
    path = scratch_path(spark, "partner-history")
    first_load, delivery = partners(spark, sf_dir)
    replace_table(first_load, path)
    replace_table(
        merge_history(read_layer(spark, path), delivery, "partner_id", "partner_key", ["name", "place"], T.AS_OF), path)
    return T.comparable(read_layer(spark, path))


def partners(spark, sf_dir):
    """(first load with its keys, delivery): customers and suppliers as partners with a place."""
    nation = F.concat(F.lit("nation "), F.col("c_nationkey").cast("string"))
    customers = T.load(spark, sf_dir, "customer").select(
        T.customer_id("c_custkey").alias("partner_id"), F.col("c_name").alias("name"), nation.alias("place"),
        (F.col("c_acctbal") < 0).alias("moved"),
    )
    suppliers = T.load(spark, sf_dir, "supplier").select(
        T.code("SUPP-", "s_suppkey", 9).alias("partner_id"), F.col("s_name").alias("name"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("place"),
    )
    first_load = number_rows(customers.drop("moved"), "partner_key", ["partner_id"]).withColumns({
        "effective_from": F.lit("2001-01-01").cast("timestamp"),
        "effective_to": F.lit(None).cast("timestamp"),
        "is_current": F.lit(True),
    })
    delivery = customers.withColumn("place", F.when(F.col("moved"), "moved").otherwise(F.col("place"))).drop("moved")
    return first_load, delivery.unionByName(suppliers)


def lake_with_bronze(spark, sf_dir, tables):
    """A lake whose bronze tables hold the deliveries of the given tables by day."""
    config = LakeConfig(scratch_path(spark, "lake"))
    for table in tables:
        raw = T.RAW[table](spark, sf_dir)
        day = F.greatest(F.col("_ingested_at").cast("date"), F.lit("2001-08-01").cast("date"))  # two folders, not one a day
        # Two days only, so no task makes many files and the rows need no shuffle.
        write_table(raw.withColumn("_ingestion_date", day), config.path("bronze", table),
                    partition_by=["_ingestion_date"], gather=False)
    return config


@query("silver_bucket_merge", S.with_tables(*SILVER_SQL["silver_orders"]))
def silver_bucket_merge(spark, sf_dir):
    """Two ingestion days, the second merged into the buckets that it touches, equal a rebuild."""
    config = lake_with_bronze(spark, sf_dir, ["orders"])
    for day in ("2001-08-01", "2001-08-02"):
        lake.run_silver(spark, config, ["orders"], T.AS_OF, processing_date=day)
    return T.comparable(read_layer(spark, config.path("silver", "orders")))


@query("lake_run", sales_sql("date_key"))
def lake_run(spark, sf_dir):
    """Silver and gold as tables of a lake, each read from what the step before wrote; daily sales at the end."""
    config = lake_with_bronze(spark, sf_dir, T.RAW)
    lake.run_silver(spark, config, as_of=T.AS_OF)
    lake.run_gold(spark, config, as_of=T.AS_OF)
    return T.comparable(read_layer(spark, config.path("gold", "agg_daily_sales")))


CHANGED_ON = "1998-07-01"
VERSIONED_FACT = S.FACT + f""",
products_marked AS (SELECT *, CAST(substr(product_id, 6) AS BIGINT) % 3 = 0 AS changed FROM dim_product),
customers_marked AS (
  SELECT *, coalesce(CAST(substr(customer_id, 6) AS BIGINT) % 4 = 0 AND effective_from < TIMESTAMP '{CHANGED_ON}', false)
    AS changed FROM dim_customer),
product_versions AS (
  SELECT product_id, product_key, cost, TIMESTAMP '0001-01-01' AS since,
    CASE WHEN changed THEN TIMESTAMP '{CHANGED_ON}' ELSE TIMESTAMP '9999-12-31' END AS until FROM products_marked
  UNION ALL
  SELECT product_id, (SELECT count(*) FROM dim_product) + row_number() OVER (ORDER BY product_id),
    {S.cents('cost + 1')}, TIMESTAMP '{CHANGED_ON}', TIMESTAMP '9999-12-31' FROM products_marked WHERE changed),
customer_versions AS (
  SELECT customer_id, customer_key, TIMESTAMP '0001-01-01' AS since,
    CASE WHEN changed THEN TIMESTAMP '{CHANGED_ON}' ELSE TIMESTAMP '9999-12-31' END AS until FROM customers_marked
  UNION ALL
  SELECT customer_id, (SELECT count(*) FROM dim_customer) + row_number() OVER (ORDER BY customer_id),
    TIMESTAMP '{CHANGED_ON}', TIMESTAMP '9999-12-31' FROM customers_marked WHERE changed)"""


@query("fact_valid_versions", S.with_tables(VERSIONED_FACT, f"""
    SELECT *, {S.cents('net_revenue - cost_of_goods')} AS profit
    FROM (
      SELECT order_item_id, order_date, c.customer_key, p.product_key, {S.cents('line_total')} AS net_revenue,
        {S.cents('l.quantity * p.cost')} AS cost_of_goods
      FROM (SELECT i.*, o.customer_id, o.order_date, coalesce(order_date, TIMESTAMP '9999-12-30') AS placed
            FROM silver_items i JOIN silver_orders o ON i.order_id = o.order_id) l
        JOIN customer_versions c ON l.customer_id = c.customer_id AND placed >= c.since AND placed < c.until
        JOIN product_versions p ON l.product_id = p.product_id AND placed >= p.since AND placed < p.until)"""))
def fact_valid_versions(spark, sf_dir):
    """Sales lines with the product and customer versions of their order dates; a third of the products changed once."""
    number = {c: F.substring(f"{c}_id", 6, 9).cast("bigint") for c in ("product", "customer")}
    histories = {}
    for name, dim, part, change in (
        ("dim_product", T.product_dim(spark, sf_dir), number["product"] % 3 == 0,
         {"brand": F.lit("Changed"), "cost": money(F.col("cost") + 1)}),
        ("dim_customer", T.customer_dim(spark, sf_dir),
         (number["customer"] % 4 == 0) & (F.col("effective_from") < CHANGED_ON), {"city": F.lit("Moved")}),
    ):
        key, natural, tracked = dimensions.SURROGATE_KEYS[name], dimensions.NATURAL_KEYS[name], dimensions.TRACKED_ATTRIBUTES[name]
        path = scratch_path(spark, f"{name}-history")
        replace_table(dimensions.start_history(dim, key, natural, tracked), path)
        delivery = dim.where(part).withColumns(change)
        replace_table(merge_history(read_layer(spark, path), delivery, natural, key, tracked, CHANGED_ON), path)
        histories[name] = read_layer(spark, path)
    lines = facts.sales_lines(
        T.silver_table(spark, sf_dir, "order_items"), T.silver_table(spark, sf_dir, "orders"),
        histories["dim_customer"], histories["dim_product"], at_order_date=True)
    return T.comparable(lines).select(
        "order_item_id", "order_date", "customer_key", "product_key", "net_revenue", "cost_of_goods", "profit")


HOT_FACT = S.FACT.replace("lines AS (", """hot_items AS (
  SELECT * REPLACE (CASE WHEN TRY_CAST(substr(product_id, 6) AS BIGINT) % 10 < 3
    THEN (SELECT min(order_id) FROM silver_orders JOIN dim_customer USING (customer_id)) ELSE order_id END AS order_id)
  FROM silver_items),
lines AS (""", 1).replace("FROM silver_items i JOIN", "FROM hot_items i JOIN", 1)


@query("fact_hot_order", S.with_tables(HOT_FACT, "SELECT * EXCLUDE (sale_key) FROM fact"))
def fact_hot_order(spark, sf_dir):
    """Sales lines of which about a third belong to one order, as with a placeholder for unknown orders."""
    orders, customers = T.silver_table(spark, sf_dir, "orders"), T.customer_dim(spark, sf_dir)
    hot = orders.join(customers, "customer_id").agg(F.min("order_id")).first()[0]
    moved = F.substring("product_id", 6, 9).try_cast("bigint") % 10 < 3
    items = T.silver_table(spark, sf_dir, "order_items").withColumn("order_id", F.when(moved, F.lit(hot)).otherwise(F.col("order_id")))
    return T.comparable(facts.sales_lines(
        stage(items, "hot-items"), orders, customers, T.product_dim(spark, sf_dir), hot_share=0.05))
