"""Gold aggregates and business figures."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpond.functions.money import mean_exact, money, percent_of, sum_cents, sum_exact
from stockpond.functions.temporal import month_of_key
from stockpond.operators.ranking import rank_within, top_per_group


def _by_order(fact: DataFrame, by: Sequence[str], sums: Mapping[str, tuple[Callable, Callable, str]]) -> DataFrame:
    """Sums per group, with ``total_orders`` and ``unique_customers``.

    Distinct counts in one step would copy every line once per counted column.
    Here lines become orders, orders customers and customers groups, each step
    on what the one before left; an order belongs to one customer. ``sums`` has
    a sum of lines, the sum that adds such sums, and the column, by name.
    """
    order = [*by, "customer_key", "order_id"]
    once = [first(column).alias(name) for name, (first, _, column) in sums.items()]
    per_order = fact.groupBy(*order).agg(*once) if once else fact.select(*order).distinct()
    again = [more(name).alias(name) for name, (_, more, _) in sums.items()]
    per_customer = per_order.groupBy(*by, "customer_key").agg(F.count("order_id").alias("total_orders"), *again)
    return per_customer.groupBy(*by).agg(
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
        F.count("customer_key").alias("unique_customers"), *again)


_SALES_SUMS = {
    "total_items_sold": (F.sum, F.sum, "quantity"),
    "gross_revenue": (sum_cents, sum_cents, "gross_revenue"),
    "net_revenue": (sum_cents, sum_cents, "net_revenue"),
    "total_profit": (sum_cents, sum_cents, "profit"),
    "_margins": (sum_cents, sum_cents, "profit_margin_pct"),
    "_margin_lines": (F.count, F.sum, "profit_margin_pct"),
}


def _sales(fact: DataFrame, by: Sequence[str]) -> DataFrame:
    return _by_order(fact, by, _SALES_SUMS).select(
        *by, "total_orders", "total_items_sold", "gross_revenue", "net_revenue", "total_profit",
        F.try_divide("_margins", "_margin_lines").alias("avg_profit_margin"), "unique_customers")


def _with_order_ratios(sales: DataFrame) -> DataFrame:
    return sales.withColumns({
        "avg_order_value": money(F.try_divide("net_revenue", "total_orders")),
        "items_per_order": money(F.try_divide("total_items_sold", "total_orders")),
        "_created_at": F.current_timestamp(),
    })


def daily_sales(fact: DataFrame) -> DataFrame:
    """Sales per day and shipping country."""
    return _with_order_ratios(_sales(fact, ["date_key", "shipping_country"]))


def sales_by_period(fact: DataFrame, grain: str) -> DataFrame:
    """Sales per ``week`` (from Monday) or ``month`` and shipping country.

    Distinct orders and customers cannot be added up from days, so this reads
    the fact itself.
    """
    period = F.date_trunc(grain, "order_date").cast("date")
    return _with_order_ratios(_sales(fact.withColumn("period_start", period), ["period_start", "shipping_country"]))


def product_totals(fact: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Sales per product; attributes are joined to the totals, not to every line."""
    # An order holds a product in one line mostly, so there are no orders to reduce the lines to first.
    totals = fact.groupBy("product_key").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        sum_cents("net_revenue").alias("total_revenue"),
        sum_cents("profit").alias("total_profit"),
        F.count_distinct("order_id").alias("number_of_orders"),
        F.count_distinct("customer_key").alias("unique_customers"),
        mean_exact("unit_price").alias("avg_selling_price"),
        mean_exact("discount_percent").alias("avg_discount_pct"),
    )
    attributes = product_dim.select("product_key", "product_id", "name", "category", "subcategory", "brand")
    return totals.join(attributes, "product_key").select(
        "product_id", "name", "category", "subcategory", "brand",
        "total_quantity_sold", "total_revenue", "total_profit", "number_of_orders", "unique_customers",
        "avg_selling_price", "avg_discount_pct",
        percent_of("total_profit", "total_revenue").alias("profit_margin_pct"),
    )


def _best_first() -> list[Column]:
    return [F.col("total_revenue").desc_nulls_last(), F.col("product_id").asc()]


def product_performance(fact: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Product totals with the revenue rank of every product in its category."""
    totals = product_totals(fact, product_dim).withColumn("_created_at", F.current_timestamp())
    return rank_within(totals, ["category"], _best_first(), "revenue_rank_in_category")


def top_products(fact: DataFrame, product_dim: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best sellers of each category by revenue."""
    best = top_per_group(product_totals(fact, product_dim), ["category"], _best_first(), k, "rank")
    return best.select("category", "rank", "product_id", "name", "total_revenue", "total_quantity_sold")


def best_sellers(fact: DataFrame, product_dim: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best sellers over all categories."""
    columns = ["product_id", "name", "category", "total_revenue", "total_quantity_sold"]
    return product_totals(fact, product_dim).orderBy(*_best_first()).limit(k).select(columns)


def daily_revenue(fact: DataFrame) -> DataFrame:
    return fact.groupBy("date_key").agg(sum_cents("net_revenue").alias("daily_revenue"))


def orders_per_customer(fact: DataFrame) -> DataFrame:
    """Average number of orders of the customers who ordered; one row."""
    counted = _by_order(fact, [], {}).select("total_orders", F.col("unique_customers").alias("total_customers"))
    ratio = money(F.try_divide("total_orders", "total_customers"))
    return counted.withColumn("orders_per_customer", ratio)


def customer_lifetime_value(orders: DataFrame) -> DataFrame:
    """Total spend per customer over orders of every status."""
    return orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.coalesce(sum_exact("total_amount"), F.lit(0.0)).alias("customer_lifetime_value")
    )


def category_performance(fact: DataFrame, product_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Revenue, profit and items per category and month.

    The fact is added up per product and day first; the dimensions then meet
    that smaller table. Sales of days that the calendar lacks belong to the
    month of their date key, sales without a day to no month.
    """
    per_product_day = fact.groupBy("product_key", "date_key").agg(
        sum_cents("net_revenue").alias("revenue"),
        sum_cents("profit").alias("profit"),
        F.sum("quantity").alias("items_sold"),
    )
    return (
        per_product_day.join(product_dim.select("product_key", "category"), "product_key")
        .join(date_dim.select("date_key", "year_month"), "date_key", "left")
        .groupBy("category", F.coalesce("year_month", month_of_key("date_key")).alias("year_month"))
        .agg(
            sum_cents("revenue").alias("revenue"),
            sum_cents("profit").alias("profit"),
            F.sum("items_sold").alias("items_sold"),
        )
        .withColumn("profit_margin_pct", percent_of("profit", "revenue"))
    )


def business_totals(fact: DataFrame) -> DataFrame:
    """Revenue, profit and margin of the whole fact; one row."""
    totals = fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        sum_cents("net_revenue").alias("total_revenue"),
        sum_cents("profit").alias("total_profit"),
    )
    return totals.withColumn("profit_margin_pct", percent_of("total_profit", "total_revenue"))
