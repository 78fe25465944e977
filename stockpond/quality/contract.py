"""Record contracts: which rules a row breaks.

Rules are column conditions that hold for a good row. A condition that is
null (a part is missing) counts as kept; missing required fields have rules
of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpond.contracts import ORDER_STATUSES, PAYMENT_METHODS, PRODUCT_CATEGORIES
from stockpond.functions.money import PER_CENT, differ_by


def _present(*columns: str) -> dict[str, Column]:
    return {f"{c}_present": F.col(c).isNotNull() for c in columns}


def _not_negative(*columns: str) -> dict[str, Column]:
    return {f"{c}_not_negative": F.col(c) >= 0 for c in columns}


def _about_equal(left: Column, right: Column) -> Column:
    """At most one cent apart."""
    return differ_by(left, right) <= PER_CENT


def _customers() -> dict[str, Column]:
    return _present("customer_id", "email", "first_name", "last_name", "country", "city", "created_at")


def _products() -> dict[str, Column]:
    return {
        **_present("product_id", "sku", "name", "category", "price", "cost", "stock_quantity", "created_at"),
        **_not_negative("price", "cost", "stock_quantity"),
        "category_known": F.col("category").isin(*PRODUCT_CATEGORIES),
        "price_at_least_half_cost": F.col("price") >= F.col("cost") * 0.5,
    }


def _orders() -> dict[str, Column]:
    parts = F.col("subtotal") + F.col("tax_amount") + F.col("shipping_amount") - F.col("discount_amount")
    return {
        **_present("order_id", "customer_id", "order_date", "status", "payment_method", "subtotal",
                   "tax_amount", "shipping_amount", "total_amount", "shipping_country", "shipping_city"),
        **_not_negative("subtotal", "tax_amount", "shipping_amount", "discount_amount", "total_amount"),
        "status_known": F.col("status").isin(*ORDER_STATUSES),
        "payment_method_known": F.col("payment_method").isin(*PAYMENT_METHODS),
        "total_matches_parts": _about_equal(F.col("total_amount"), parts),
    }


def _order_items() -> dict[str, Column]:
    gross = F.col("quantity") * F.col("unit_price")
    expected = gross * (1 - F.col("discount_percent") / 100)
    return {
        **_present("order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total"),
        **_not_negative("unit_price", "line_total"),
        "quantity_at_least_one": F.col("quantity") >= 1,
        "discount_percent_in_range": F.col("discount_percent").between(0, 100),
        "line_total_matches": _about_equal(F.col("line_total"), expected),
    }


RECORD_RULES = {
    "customers": _customers,
    "products": _products,
    "orders": _orders,
    "order_items": _order_items,
}


def with_violations(df: DataFrame, table: str) -> DataFrame:
    """Add ``violations``, the names of the rules each row breaks."""
    broken = [F.when(~rule, F.lit(name)) for name, rule in RECORD_RULES[table]().items()]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def count_violations(df: DataFrame, table: str) -> DataFrame:
    """Rows that break each rule, for all rules, in one pass and one row per rule."""
    rules = RECORD_RULES[table]()
    counted = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return counted.select(F.inline(pairs)).select(F.lit(table).alias("table_name"), "rule", "violations")
