"""SQL twins of the tables the queries use, written from the business rules.

Each constant is a common table expression; ``with_tables`` puts together the
ones a query needs.
"""

from __future__ import annotations


def cents(expr: str) -> str:
    """Half-up rounding to cents through a decimal of nine places, which removes binary noise from amounts below a million."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,9)), 2) AS DOUBLE)"


def dec(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,6))"


def add_up(expr: str, places: int = 2) -> str:
    """Sum that does not depend on the order of the rows."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,{places}))) AS DOUBLE)"


CODES = "['DE','FR','GB','ES','IT','NL','PL','BE','AT','PT']"

EMAIL = """CASE WHEN c_custkey % 11 = 0 THEN NULL
      WHEN c_custkey % 7 = 0 THEN 'User' || c_custkey || '-at-nowhere'
      WHEN c_custkey % 13 = 0 THEN 'user' || c_custkey || '@one@Two.org'
      ELSE '  User' || c_custkey || '@Example' || c_nationkey || '.COM ' END"""

SILVER_CUSTOMERS = f"""
silver_customers AS (
  SELECT *,
    CASE WHEN account_age_days < 30 THEN 'new' WHEN account_age_days < 365 THEN 'regular'
         ELSE 'established' END AS segment
  FROM (
    SELECT *, date_diff('day', created_at, TIMESTAMP '2001-08-02') AS account_age_days FROM (
      SELECT
        'CUST-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS customer_id,
        lower(trim({EMAIL})) AS email,
        regexp_extract(lower(trim({EMAIL})), '@(.+)$', 1) AS email_domain,
        regexp_matches(lower(trim({EMAIL})), '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$') AS is_valid_email,
        CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE lower(c_mktsegment) END AS first_name,
        n_name AS last_name,
        concat_ws(' ',
          CASE WHEN c_custkey % 13 = 0 THEN NULL
               ELSE upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END,
          upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2))) AS full_name,
        '+49 ' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phone,
        CASE WHEN c_nationkey < 10 THEN {CODES}[c_nationkey + 1] ELSE upper(n_name) END AS country,
        'City ' || (c_custkey % 7) AS city,
        CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name || ' Street' END AS address,
        CASE WHEN c_custkey % 17 = 0 THEN NULL
             ELSE CAST(DATE '1995-01-01' + CAST(c_custkey % 2400 AS INTEGER) AS TIMESTAMP) END AS created_at,
        CASE WHEN c_custkey % 5 = 0 THEN NULL
             ELSE CAST(DATE '1995-01-31' + CAST(c_custkey % 2400 AS INTEGER) AS TIMESTAMP) END AS updated_at,
        'customers.csv' AS _source_file,
        TIMESTAMP '2001-08-02 06:00:00' AS _ingested_at
      FROM customer JOIN nation ON c_nationkey = n_nationkey)))"""

PRICE = cents("p_retailprice * p_size / 50")
COST = cents(f"{PRICE} * (0.4::DOUBLE + 0.01::DOUBLE * (p_partkey % 40))")

SILVER_PRODUCTS = f"""
silver_products AS (
  SELECT product_id, sku, name, description, category, subcategory, brand, price, cost,
    CASE WHEN price > 0 THEN {cents('(price - cost) / price * 100')} ELSE 0.0::DOUBLE END AS margin_percent,
    stock_quantity, is_active, created_at, _source_file, _ingested_at
  FROM (
    SELECT
      'PROD-' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS product_id,
      'SKU-' || (p_partkey - p_partkey % 2) AS sku,
      trim(p_name) AS name,
      CASE WHEN p_partkey % 5 = 0 THEN 'No description available' ELSE p_name || ' from stock' END AS description,
      lower(p_type) AS category,
      p_type || ' ' || p_brand AS subcategory,
      p_brand AS brand,
      CASE WHEN p_partkey % 101 = 0 THEN NULL WHEN p_partkey % 103 = 0 THEN 0.0::DOUBLE ELSE {PRICE} END AS price,
      CASE WHEN p_partkey % 107 = 0 THEN NULL ELSE {COST} END AS cost,
      CASE WHEN p_partkey % 109 = 0 THEN NULL ELSE CAST((p_size - 1) * 2 AS BIGINT) END AS stock_quantity,
      p_partkey % 5 IN (0, 1, 2) AS is_active,
      CAST(DATE '1994-01-01' + CAST(p_partkey % 300 AS INTEGER) AS TIMESTAMP) AS created_at,
      'products.csv' AS _source_file,
      TIMESTAMP '2001-08-02 06:00:00' AS _ingested_at
    FROM part))"""

SILVER_ORDERS = f"""
order_amounts AS (
  SELECT *,
    {cents('subtotal + tax + shipping_amount - discount_amount + CASE WHEN o_orderkey % 5 = 0 THEN 0.02::DOUBLE ELSE 0.0::DOUBLE END')} AS total_amount
  FROM (
    SELECT *, {cents('subtotal * 0.19::DOUBLE')} AS tax,
      CASE WHEN o_orderkey % 4 = 0 THEN 4.99::DOUBLE ELSE 0.0::DOUBLE END AS shipping_amount,
      CASE WHEN subtotal > 100 THEN {cents('subtotal * 0.05::DOUBLE')} ELSE 0.0::DOUBLE END AS discount_amount
    FROM (
      SELECT *, CASE WHEN o_orderkey % 43 = 0 THEN 0.0::DOUBLE ELSE {cents('o_totalprice / 4000')} END AS subtotal
      FROM orders))),
silver_orders AS (
  SELECT order_id, customer_id, order_date,
    year(order_date) AS order_year, month(order_date) AS order_month, day(order_date) AS order_day,
    dayofweek(order_date) + 1 AS order_day_of_week, weekofyear(order_date) AS order_week,
    status, payment_method, subtotal, tax_amount, shipping_amount, discount_amount, total_amount,
    CAST(calculated AS DOUBLE) AS calculated_total,
    abs({dec('total_amount')} - calculated) < 0.01 AS is_total_valid,
    currency, shipping_country, shipping_city, _source_file, _ingested_at
  FROM (
    SELECT *,
      {dec('subtotal')} + {dec('tax_amount')} + {dec('shipping_amount')} - {dec('discount_amount')} AS calculated
    FROM (
      SELECT
        'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_id,
        CASE WHEN o_orderkey % 41 = 0 THEN 'CUST-UNKNOWN'
             WHEN o_custkey % 10 <> 0 THEN 'CUST-' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS customer_id,
        CASE WHEN o_orderkey % 211 <> 0 THEN o_orderdate END AS order_date,
        CASE WHEN o_orderkey % 29 = 0 THEN 'lost' WHEN o_orderkey % 31 = 0 THEN NULL
             WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
             ELSE 'confirmed' END AS status,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'debit_card'
             WHEN '3-MEDIUM' THEN 'paypal' WHEN '5-LOW' THEN 'bank_transfer' ELSE 'voucher' END AS payment_method,
        subtotal,
        CASE WHEN o_orderkey % 37 <> 0 THEN tax END AS tax_amount,
        shipping_amount, discount_amount, total_amount,
        'EUR' AS currency,
        {CODES}[o_custkey % 10 + 1] AS shipping_country,
        'City ' || (o_custkey % 7) AS shipping_city,
        'orders.csv' AS _source_file,
        TIMESTAMP '2001-08-02 06:00:00' AS _ingested_at
      FROM order_amounts)))"""

UNIT_PRICE = cents("l_extendedprice / l_quantity")

RAW_ITEMS = f"""
raw_items AS (
  SELECT
    'ITEM-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || l_linenumber AS order_item_id,
    CASE WHEN l_suppkey % 47 = 0 THEN 'ORD-UNKNOWN'
         ELSE 'ORD-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') END AS order_id,
    CASE WHEN l_suppkey % 50 = 0 THEN 'PROD-UNKNOWN' WHEN l_suppkey % 53 = 0 THEN NULL
         ELSE 'PROD-' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') END AS product_id,
    CASE WHEN l_suppkey % 59 = 0 THEN '0' WHEN l_suppkey % 67 = 0 THEN 'many'
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity_text,
    unit_price,
    {cents('l_discount * 100')} AS discount_percent,
    {cents(cents('l_quantity * unit_price * (1 - l_discount)')
           + ' + CASE WHEN l_suppkey % 61 = 0 THEN 0.02::DOUBLE ELSE 0.0::DOUBLE END')} AS line_total,
    l_shipdate AS _ingested_at
  FROM (SELECT *, {UNIT_PRICE} AS unit_price FROM lineitem))"""

SILVER_ITEMS = RAW_ITEMS + f""",
silver_items AS (
  SELECT order_item_id, order_id, product_id, quantity, unit_price, gross_amount, discount_percent,
    discount_amount, line_total, calculated_line_total,
    abs({dec('line_total')} - {dec('calculated_line_total')}) < 0.01 AS is_line_total_valid,
    'order_items.csv' AS _source_file, _ingested_at
  FROM (
    SELECT *, {cents('gross_amount - discount_amount')} AS calculated_line_total FROM (
      SELECT *, {cents('gross_amount * discount_percent / 100')} AS discount_amount FROM (
        SELECT *, {cents('quantity * unit_price')} AS gross_amount FROM (
          SELECT *, TRY_CAST(quantity_text AS BIGINT) AS quantity,
            row_number() OVER (PARTITION BY order_item_id ORDER BY _ingested_at DESC NULLS LAST,
              order_id DESC NULLS LAST, product_id DESC NULLS LAST, quantity_text DESC NULLS LAST,
              CAST(unit_price AS VARCHAR) DESC, CAST(discount_percent AS VARCHAR) DESC,
              CAST(line_total AS VARCHAR) DESC) AS rn
          FROM raw_items) WHERE rn = 1))))"""

DIM_PRODUCT = SILVER_PRODUCTS + """,
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, sku, name, description, brand,
    category, subcategory, price, cost, margin_percent,
    CASE WHEN price >= 500 THEN 'premium' WHEN price >= 100 THEN 'mid_range' WHEN price >= 25 THEN 'budget'
         ELSE 'economy' END AS price_tier,
    margin_percent >= 40 AS is_high_margin,
    stock_quantity,
    CASE WHEN stock_quantity = 0 THEN 'out_of_stock' WHEN stock_quantity < 10 THEN 'low_stock'
         WHEN stock_quantity < 50 THEN 'normal' ELSE 'well_stocked' END AS stock_status,
    is_active, created_at AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current
  FROM silver_products)"""

CUSTOMER_METRICS = SILVER_ORDERS + f""",
customer_metrics AS (
  SELECT customer_id, count(order_id) AS total_orders, {add_up('total_amount', 6)} AS total_spend,
    min(order_date) AS first_order_date, max(order_date) AS last_order_date,
    {add_up('total_amount', 6)} / count(total_amount) AS avg_order_value
  FROM silver_orders GROUP BY customer_id)"""

PROFILES = SILVER_CUSTOMERS + "," + CUSTOMER_METRICS + """,
profiles AS (
  SELECT customer_id, email, full_name, first_name, last_name, phone, country, city, segment,
    CASE WHEN total_spend >= 1000 THEN 'platinum' WHEN total_spend >= 500 THEN 'gold'
         WHEN total_spend >= 100 THEN 'silver' ELSE 'bronze' END AS value_tier,
    CASE WHEN total_orders IS NULL THEN 'prospect'
         WHEN date_diff('day', last_order_date, TIMESTAMP '2001-08-02') > 365 THEN 'churned'
         WHEN date_diff('day', last_order_date, TIMESTAMP '2001-08-02') > 90 THEN 'at_risk'
         ELSE 'active' END AS customer_status,
    is_valid_email, coalesce(total_orders, 0) AS total_orders, coalesce(total_spend, 0.0::DOUBLE) AS total_spend,
    first_order_date, last_order_date, avg_order_value,
    date_diff('day', last_order_date, TIMESTAMP '2001-08-02') AS days_since_last_order,
    created_at AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current
  FROM silver_customers LEFT JOIN customer_metrics USING (customer_id))"""

DIM_CUSTOMER = PROFILES + """,
dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, * FROM profiles)"""

DATES = """
day_range AS (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders),
days AS (
  SELECT CAST(unnest(generate_series(CAST(make_date(lo, 1, 1) AS TIMESTAMP),
    CAST(make_date(hi, 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM day_range),
dim_date AS (
  SELECT date,
    year(date) * 10000 + month(date) * 100 + day(date) AS date_key,
    day(date) AS day_of_month, dayofweek(date) + 1 AS day_of_week, dayofyear(date) AS day_of_year,
    weekofyear(date) AS week_of_year, month(date) AS month, quarter(date) AS quarter, year(date) AS year,
    strftime(date, '%A') AS day_name, strftime(date, '%a') AS day_name_short,
    strftime(date, '%B') AS month_name, strftime(date, '%b') AS month_name_short,
    strftime(date, '%Y-%m') AS year_month,
    year(date) || '-Q' || quarter(date) AS year_quarter,
    year(date) || '-W' || lpad(CAST(weekofyear(date) AS VARCHAR), 2, '0') AS year_week,
    dayofweek(date) IN (0, 6) AS is_weekend, dayofweek(date) NOT IN (0, 6) AS is_weekday,
    day(date) = 1 AS is_month_start, date = last_day(date) AS is_month_end,
    month(date) IN (1, 4, 7, 10) AND day(date) = 1 AS is_quarter_start,
    month(date) IN (3, 6, 9, 12) AND date = last_day(date) AS is_quarter_end,
    month(date) = 1 AND day(date) = 1 AS is_year_start,
    month(date) = 12 AND day(date) = 31 AS is_year_end,
    year(date) AS fiscal_year, quarter(date) AS fiscal_quarter
  FROM days)"""

FACT = SILVER_ITEMS + "," + DIM_CUSTOMER + "," + DIM_PRODUCT + f""",
lines AS (
  SELECT
    year(order_date) * 10000 + month(order_date) * 100 + day(order_date) AS date_key,
    customer_key, product_key, i.order_id, order_item_id, order_date, status, payment_method, shipping_country,
    quantity, unit_price, discount_percent, i.discount_amount,
    {cents('quantity * unit_price')} AS gross_revenue,
    {cents('line_total')} AS net_revenue,
    {cents('quantity * cost')} AS cost_of_goods,
    CASE WHEN subtotal <> 0 THEN {cents('tax_amount * (line_total / subtotal)')} END AS allocated_tax,
    CASE WHEN subtotal <> 0 THEN {cents('shipping_amount * (line_total / subtotal)')} END AS allocated_shipping
  FROM silver_items i JOIN silver_orders o ON i.order_id = o.order_id
    JOIN dim_customer c ON o.customer_id = c.customer_id JOIN dim_product p ON i.product_id = p.product_id),
fact AS (
  SELECT row_number() OVER (ORDER BY order_item_id) AS sale_key, date_key, customer_key, product_key, order_id,
    order_item_id, order_date, status, payment_method, shipping_country, quantity, unit_price, discount_percent,
    gross_revenue, discount_amount, net_revenue, cost_of_goods, profit,
    CASE WHEN net_revenue > 0 THEN {cents('profit / net_revenue * 100')} ELSE 0.0::DOUBLE END AS profit_margin_pct,
    allocated_tax, allocated_shipping
  FROM (SELECT *, {cents('net_revenue - cost_of_goods')} AS profit FROM lines))"""


def with_tables(tables: str, select: str) -> str:
    return f"WITH {tables.strip()}\n{select.strip()}"
