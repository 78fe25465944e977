"""Data-quality checks, suites and record contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockpond.contracts import ORDER_STATUSES, QualityLimits
from stockpond.quality import (
    Fresh,
    InRange,
    InSet,
    References,
    RowCount,
    Severity,
    Unique,
    check_customers,
    check_keys,
    check_order_items,
    check_orders,
    check_products,
    count_violations,
    evaluate,
    gate,
    key_counters,
    not_null,
    report,
    summarize,
    with_violations,
)
from testbed import sql as S
from testbed import tables as T
from testbed.registry import query


def result(table: str, name: str, failed: str, severity: str = "error", limit: float = 0.0, source: str = "") -> str:
    """One check as SQL over ``source``: counts, percentage and verdict."""
    return f"""
    SELECT '{table}' AS table_name, '{name}' AS check_name, '{severity}' AS severity,
      coalesce(CAST(failed AS DOUBLE) / NULLIF(total, 0) * 100, 0.0::DOUBLE) <= {limit} AS passed,
      failed AS failed_count, total AS total_count,
      coalesce(CAST(failed AS DOUBLE) / NULLIF(total, 0) * 100, 0.0::DOUBLE) AS failed_percentage
    FROM (SELECT CAST({failed} AS BIGINT) AS failed, count(*) AS total FROM {source})"""


def nulls(column: str) -> str:
    return f"count(*) FILTER (WHERE {column} IS NULL)"


def breaking(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def repeats(column: str) -> str:
    return f"count(*) - count(DISTINCT {column}) - CAST(bool_or({column} IS NULL) AS INTEGER)"


def orphans(column: str, source: str, reference: str, reference_column: str) -> str:
    return (f"(SELECT count(*) FROM (SELECT DISTINCT {column} AS k FROM {source}) w "
            f"WHERE NOT EXISTS (SELECT 1 FROM {reference} r WHERE r.{reference_column} = w.k))")


def union(*selects: str) -> str:
    return "\n    UNION ALL".join(selects)


def verdicts(results):
    """Results without the free text."""
    return results.drop("message")


STATUSES = ", ".join(f"'{s}'" for s in ORDER_STATUSES)


@query("dq_not_null", S.with_tables(S.SILVER_ITEMS, union(
    result("order_items", "not_null_product_id", nulls("product_id"), source="silver_items"),
    result("order_items", "not_null_quantity", nulls("quantity"), "warning", source="silver_items"),
    result("order_items", "not_null_order_id", nulls("order_id"), source="silver_items"),
    "\n    SELECT 'order_items', 'not_null_colour', 'error', false, 0::BIGINT, 0::BIGINT, 0.0::DOUBLE")))
def dq_not_null(spark, sf_dir):
    return verdicts(evaluate(T.silver_table(spark, sf_dir, "order_items"), "order_items", [
        *not_null("product_id"),
        *not_null("quantity", severity=Severity.WARNING),
        *not_null("order_id", "colour"),
    ]))


@query("dq_unique", union(
    result("lineitem", "unique_l_orderkey+l_linenumber",
           "count(*) - count(DISTINCT (l_orderkey, l_linenumber))", source="lineitem"),
    result("lineitem", "unique_l_partkey", "count(*) - count(DISTINCT l_partkey)", "info", source="lineitem")))
def dq_unique(spark, sf_dir):
    return verdicts(evaluate(T.load(spark, sf_dir, "lineitem"), "lineitem", [
        Unique(["l_orderkey", "l_linenumber"]), Unique(["l_partkey"], Severity.INFO),
    ]))


@query("dq_values_in_set", S.with_tables(S.SILVER_ORDERS, union(
    result("orders", "valid_values_status", breaking(f"status NOT IN ({STATUSES})"), source="silver_orders"),
    result("orders", "valid_values_currency", breaking("currency NOT IN ('EUR')"), source="silver_orders"))))
def dq_values_in_set(spark, sf_dir):
    return verdicts(evaluate(T.silver_table(spark, sf_dir, "orders"), "orders", [
        InSet("status", ORDER_STATUSES), InSet("currency", ["EUR"]),
    ]))


@query("dq_range", S.with_tables(S.SILVER_PRODUCTS, union(
    result("products", "range_price", breaking("price < 25 OR price > 500"), source="silver_products"),
    result("products", "range_cost", breaking("cost < 10"), "warning", source="silver_products"),
    result("products", "range_stock_quantity", "0", source="silver_products"))))
def dq_range(spark, sf_dir):
    return verdicts(evaluate(T.silver_table(spark, sf_dir, "products"), "products", [
        InRange("price", low=25, high=500), InRange("cost", low=10, severity=Severity.WARNING),
        InRange("stock_quantity"),
    ]))


@query("dq_ref_integrity", S.with_tables(S.SILVER_ITEMS + "," + S.SILVER_PRODUCTS + "," + S.SILVER_ORDERS, union(
    result("order_items", "ref_integrity_product_id",
           orphans("product_id", "silver_items", "silver_products", "product_id"), source="silver_items"),
    result("order_items", "ref_integrity_order_id",
           orphans("order_id", "silver_items", "silver_orders", "order_id"), source="silver_items"))))
def dq_ref_integrity(spark, sf_dir):
    return verdicts(evaluate(T.silver_table(spark, sf_dir, "order_items"), "order_items", [
        References("product_id", T.silver_table(spark, sf_dir, "products"), "product_id"),
        References("order_id", T.silver_table(spark, sf_dir, "orders"), "order_id"),
    ]))


@query("dq_row_count", """
    SELECT 'customer' AS table_name, 'row_count' AS check_name, 'error' AS severity, count(*) >= 1 AS passed,
      CASE WHEN count(*) >= 1 THEN 0::BIGINT ELSE 1::BIGINT END AS failed_count, count(*) AS total_count,
      0.0::DOUBLE AS failed_percentage FROM customer
    UNION ALL
    SELECT 'lineitem', 'row_count', 'error', count(*) BETWEEN 1 AND 100,
      CASE WHEN count(*) BETWEEN 1 AND 100 THEN 0::BIGINT ELSE 1::BIGINT END, count(*), 0.0::DOUBLE FROM lineitem""")
def dq_row_count(spark, sf_dir):
    enough = evaluate(T.load(spark, sf_dir, "customer"), "customer", [RowCount(low=1)])
    too_many = evaluate(T.load(spark, sf_dir, "lineitem"), "lineitem", [RowCount(low=1, high=100)])
    return verdicts(enough.unionByName(too_many))


@query("dq_freshness", """
    SELECT 'events' AS table_name, 'freshness_ts' AS check_name, 'warning' AS severity,
      date_diff('microsecond', max(ts), TIMESTAMP '2024-01-31 12:00:00') / 3600000000 <= h AS passed,
      0::BIGINT AS failed_count, count(*) AS total_count, 0.0::DOUBLE AS failed_percentage
    FROM events, (SELECT unnest([24, 48]) AS h) GROUP BY h""")
def dq_freshness(spark, sf_dir):
    events = T.load(spark, sf_dir, "events")
    checks = [Fresh("ts", 24), Fresh("ts", 48)]
    return verdicts(evaluate(events, "events", checks, as_of="2024-01-31 12:00:00"))


@query("dq_thresholds", S.with_tables(S.SILVER_ITEMS + "," + S.SILVER_ORDERS, union(
    result("order_items", "not_null_product_id", nulls("product_id"), limit=5.0, source="silver_items"),
    result("order_items", "not_null_quantity", nulls("quantity"), limit=0.5, source="silver_items"),
    result("orders", "not_null_customer_id", nulls("customer_id"), limit=1.0, source="silver_orders"),
    result("orders", "unique_shipping_city", repeats("shipping_city"), limit=0.1, source="silver_orders"))))
def dq_thresholds(spark, sf_dir):
    items = evaluate(T.silver_table(spark, sf_dir, "order_items"), "order_items", [
        *not_null("product_id", limit=5.0), *not_null("quantity", limit=0.5),
    ])
    orders = evaluate(T.silver_table(spark, sf_dir, "orders"), "orders", [
        *not_null("customer_id", limit=1.0), Unique(["shipping_city"], limit=0.1),
    ])
    return verdicts(items.unionByName(orders))


CUSTOMERS_SUITE = union(
    *[result("customers", f"not_null_{c}", nulls(c), source="silver_customers")
      for c in ("customer_id", "email", "country")],
    result("customers", "unique_customer_id", repeats("customer_id"), source="silver_customers"),
    result("customers", "unique_email", repeats("email"), "warning", source="silver_customers"),
    """
    SELECT 'customers', 'row_count', 'error', count(*) >= 1, CASE WHEN count(*) >= 1 THEN 0::BIGINT ELSE 1::BIGINT END,
      count(*), 0.0::DOUBLE FROM silver_customers""")

PRODUCTS_SUITE = union(
    *[result("products", f"not_null_{c}", nulls(c), source="silver_products")
      for c in ("product_id", "name", "price", "category")],
    result("products", "unique_product_id", repeats("product_id"), source="silver_products"),
    result("products", "unique_sku", repeats("sku"), "warning", source="silver_products"),
    result("products", "range_price", breaking("price < 0"), source="silver_products"),
    result("products", "range_cost", breaking("cost < 0"), source="silver_products"),
    result("products", "range_margin_percent", breaking("margin_percent < -100 OR margin_percent > 100"), "warning",
           source="silver_products"))

ORDERS_SUITE = union(
    *[result("orders", f"not_null_{c}", nulls(c), source="silver_orders")
      for c in ("order_id", "customer_id", "order_date", "total_amount")],
    result("orders", "unique_order_id", repeats("order_id"), source="silver_orders"),
    result("orders", "range_total_amount", breaking("total_amount < 0"), source="silver_orders"),
    result("orders", "range_subtotal", breaking("subtotal < 0"), source="silver_orders"),
    result("orders", "valid_values_status", breaking(f"status NOT IN ({STATUSES})"), source="silver_orders"),
    result("orders", "ref_integrity_customer_id",
           orphans("customer_id", "silver_orders", "silver_customers", "customer_id"), source="silver_orders"))

ITEMS_SUITE = union(
    *[result("order_items", f"not_null_{c}", nulls(c), source="silver_items")
      for c in ("order_item_id", "order_id", "product_id", "quantity")],
    result("order_items", "unique_order_item_id", repeats("order_item_id"), source="silver_items"),
    result("order_items", "range_quantity", breaking("quantity < 1"), source="silver_items"),
    result("order_items", "range_unit_price", breaking("unit_price < 0"), source="silver_items"),
    result("order_items", "range_discount_percent", breaking("discount_percent < 0 OR discount_percent > 100"),
           source="silver_items"),
    result("order_items", "ref_integrity_order_id",
           orphans("order_id", "silver_items", "silver_orders", "order_id"), source="silver_items"),
    result("order_items", "ref_integrity_product_id",
           orphans("product_id", "silver_items", "silver_products", "product_id"), source="silver_items"))


@query("dq_suite_customers", S.with_tables(S.SILVER_CUSTOMERS, CUSTOMERS_SUITE))
def dq_suite_customers(spark, sf_dir):
    return verdicts(check_customers(T.silver_table(spark, sf_dir, "customers")))


@query("dq_suite_products", S.with_tables(S.SILVER_PRODUCTS, PRODUCTS_SUITE))
def dq_suite_products(spark, sf_dir):
    return verdicts(check_products(T.silver_table(spark, sf_dir, "products")))


@query("dq_suite_orders", S.with_tables(S.SILVER_ORDERS + "," + S.SILVER_CUSTOMERS, ORDERS_SUITE))
def dq_suite_orders(spark, sf_dir):
    return verdicts(check_orders(
        T.silver_table(spark, sf_dir, "orders"), T.silver_table(spark, sf_dir, "customers")
    ))


@query("dq_suite_order_items", S.with_tables(
    S.SILVER_ITEMS + "," + S.SILVER_ORDERS + "," + S.SILVER_PRODUCTS, ITEMS_SUITE))
def dq_suite_order_items(spark, sf_dir):
    return verdicts(check_order_items(
        T.silver_table(spark, sf_dir, "order_items"), T.silver_table(spark, sf_dir, "orders"),
        T.silver_table(spark, sf_dir, "products"),
    ))


def two_suites(spark, sf_dir):
    customers = check_customers(T.silver_table(spark, sf_dir, "customers"))
    return customers.unionByName(check_products(T.silver_table(spark, sf_dir, "products")))


TWO_SUITES = (S.SILVER_CUSTOMERS + "," + S.SILVER_PRODUCTS
              + f", results AS ({CUSTOMERS_SUITE} UNION ALL {PRODUCTS_SUITE})")


@query("dq_bronze_keys", S.with_tables(S.RAW_ITEMS + """,
delivered AS (
  SELECT CASE WHEN quantity_text = 'many' THEN NULL WHEN quantity_text = '0' THEN ' ' ELSE order_item_id END AS k,
    _ingested_at AS day FROM raw_items),
keyed AS (SELECT nullif(trim(k), '') AS k, day FROM delivered),
seen AS (SELECT day, k, count(*) AS n FROM keyed GROUP BY day, k),
counted AS (
  SELECT 'order_items' AS table_name, 'order_item_id' AS key, sum(n) AS total,
    sum(CASE WHEN k IS NULL THEN n ELSE 0 END) AS missing, sum(CASE WHEN k IS NULL THEN 0 ELSE n - 1 END) AS repeated
  FROM seen
  UNION ALL SELECT 'orders', 'order_id', count(*) + count(*) FILTER (WHERE o_orderstatus = 'O'), 0, 0 FROM orders)""", """
    SELECT table_name, 'bronze_not_null_' || key AS check_name, 'error' AS severity,
      CAST(missing AS DOUBLE) / CAST(total AS DOUBLE) * 100 <= 1.0 AS passed, CAST(missing AS BIGINT) AS failed_count,
      CAST(total AS BIGINT) AS total_count, CAST(missing AS DOUBLE) / CAST(total AS DOUBLE) * 100 AS failed_percentage
    FROM counted
    UNION ALL
    SELECT table_name, 'bronze_unique_' || key, 'error',
      CAST(repeated AS DOUBLE) / CAST(total AS DOUBLE) * 100 <= 0.1, CAST(repeated AS BIGINT),
      CAST(total AS BIGINT), CAST(repeated AS DOUBLE) / CAST(total AS DOUBLE) * 100
    FROM counted"""))
def dq_bronze_keys(spark, sf_dir):
    """Keys as delivered: blank or missing ones, and those that came twice on a day, before silver drops them."""
    day = F.col("_ingested_at").cast("date")
    key = F.when(F.col("quantity") == "many", None).when(F.col("quantity") == "0", " ").otherwise(F.col("order_item_id"))
    items = T.raw_order_items(spark, sf_dir).withColumns({"order_item_id": key, "_ingestion_date": day})
    orders = T.raw_orders(spark, sf_dir).withColumn("_ingestion_date", day)
    counters = key_counters(items, "order_items", "order_item_id").unionByName(key_counters(orders, "orders", "order_id"))
    return verdicts(check_keys(counters, QualityLimits()))


@query("dq_gate", S.with_tables(TWO_SUITES, """
    SELECT table_name, bool_and(passed OR severity <> 'error') AS passed,
      count(*) FILTER (WHERE NOT passed AND severity = 'error') AS blocking_checks
    FROM results GROUP BY table_name"""))
def dq_gate(spark, sf_dir):
    return gate(two_suites(spark, sf_dir))


@query("dq_gate_with_warnings", S.with_tables(TWO_SUITES, """
    SELECT table_name, bool_and(passed OR severity = 'info') AS passed,
      count(*) FILTER (WHERE NOT passed AND severity <> 'info') AS blocking_checks
    FROM results GROUP BY table_name"""))
def dq_gate_with_warnings(spark, sf_dir):
    return gate(two_suites(spark, sf_dir), include_warnings=True)


@query("dq_summary", S.with_tables(TWO_SUITES, """
    SELECT table_name, max(total_count) AS total_rows, count(*) AS checks,
      count(*) FILTER (WHERE passed) AS checks_passed, count(*) FILTER (WHERE NOT passed) AS checks_failed,
      CASE WHEN bool_and(passed) THEN 'passed' ELSE 'failed' END AS status
    FROM results GROUP BY table_name"""))
def dq_summary(spark, sf_dir):
    return summarize(two_suites(spark, sf_dir))


@query("dq_report", S.with_tables(S.SILVER_CUSTOMERS + f", results AS ({CUSTOMERS_SUITE})", """
    SELECT check_name, CASE WHEN passed THEN 'PASSED' ELSE 'FAILED' END || ' [' || upper(severity) || '] '
      || check_name || ': ' || CASE
        WHEN check_name = 'row_count' THEN 'row count must be at least 1'
        WHEN check_name LIKE 'not_null_%' THEN replace(check_name, 'not_null_', '') || ' must not be null'
        ELSE replace(check_name, 'unique_', '') || ' must be unique' END
      || ' (' || failed_count || '/' || total_count || ' = ' || format('{:.2f}', failed_percentage) || '%)' AS line
    FROM results"""))
def dq_report(spark, sf_dir):
    return report(check_customers(T.silver_table(spark, sf_dir, "customers"))).select("check_name", "line")


def rule(table: str, name: str, broken: str) -> str:
    return f"SELECT '{table}' AS table_name, '{name}' AS rule, {breaking(broken)} AS violations FROM silver"


ITEM_RULES = {
    **{f"{c}_present": f"{c} IS NULL"
       for c in ("order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total")},
    "unit_price_not_negative": "unit_price < 0",
    "line_total_not_negative": "line_total < 0",
    "quantity_at_least_one": "quantity < 1",
    "discount_percent_in_range": "discount_percent < 0 OR discount_percent > 100",
    "line_total_matches": f"abs({S.dec('line_total')} - "
                          f"{S.dec('quantity * unit_price * (1 - discount_percent / 100)')}) > 0.01",
}
ORDER_RULES = {
    **{f"{c}_present": f"{c} IS NULL"
       for c in ("order_id", "customer_id", "order_date", "status", "payment_method", "subtotal", "tax_amount",
                 "shipping_amount", "total_amount", "shipping_country", "shipping_city")},
    **{f"{c}_not_negative": f"{c} < 0"
       for c in ("subtotal", "tax_amount", "shipping_amount", "discount_amount", "total_amount")},
    "status_known": f"status NOT IN ({STATUSES})",
    "payment_method_known": "payment_method NOT IN ('credit_card', 'debit_card', 'paypal', 'bank_transfer', "
                            "'cash_on_delivery')",
    "total_matches_parts": f"abs({S.dec('total_amount')} - ({S.dec('subtotal')} + {S.dec('tax_amount')} + "
                           f"{S.dec('shipping_amount')} - {S.dec('discount_amount')})) > 0.01",
}
PRODUCT_RULES = {
    **{f"{c}_present": f"{c} IS NULL"
       for c in ("product_id", "sku", "name", "category", "price", "cost", "stock_quantity", "created_at")},
    **{f"{c}_not_negative": f"{c} < 0" for c in ("price", "cost", "stock_quantity")},
    "category_known": "category NOT IN ('electronics', 'clothing', 'home_garden', 'sports', 'books', 'toys', "
                      "'beauty', 'food')",
    "price_at_least_half_cost": "price < cost * 0.5::DOUBLE",
}
CUSTOMER_RULES = {
    f"{c}_present": f"{c} IS NULL"
    for c in ("customer_id", "email", "first_name", "last_name", "country", "city", "created_at")
}


def rules_sql(table: str, tables: str, silver: str, rules: dict[str, str]) -> str:
    counts = "\n    UNION ALL ".join(rule(table, name, broken) for name, broken in rules.items())
    return S.with_tables(f"{tables}, silver AS (SELECT * FROM {silver})", counts)


@query("contract_violations", rules_sql("order_items", S.SILVER_ITEMS, "silver_items", ITEM_RULES))
def contract_violations(spark, sf_dir):
    return count_violations(T.silver_table(spark, sf_dir, "order_items"), "order_items")


@query("contract_violations_orders", rules_sql("orders", S.SILVER_ORDERS, "silver_orders", ORDER_RULES))
def contract_violations_orders(spark, sf_dir):
    return count_violations(T.silver_table(spark, sf_dir, "orders"), "orders")


@query("contract_violations_products", rules_sql("products", S.SILVER_PRODUCTS, "silver_products", PRODUCT_RULES))
def contract_violations_products(spark, sf_dir):
    return count_violations(T.silver_table(spark, sf_dir, "products"), "products")


@query("contract_violations_customers", rules_sql("customers", S.SILVER_CUSTOMERS, "silver_customers", CUSTOMER_RULES))
def contract_violations_customers(spark, sf_dir):
    return count_violations(T.silver_table(spark, sf_dir, "customers"), "customers")


@query("row_violations", S.with_tables(S.SILVER_ITEMS, "SELECT order_item_id, concat_ws(',', " + ", ".join(
    f"CASE WHEN {broken} THEN '{name}' END" for name, broken in ITEM_RULES.items()
) + ") AS violations FROM silver_items"))
def row_violations(spark, sf_dir):
    """The broken rules of every single row."""
    checked = with_violations(T.silver_table(spark, sf_dir, "order_items"), "order_items")
    return checked.select("order_item_id", F.concat_ws(",", "violations").alias("violations"))
