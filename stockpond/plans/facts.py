"""Gold facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpond.functions.money import money, percent_of, sum_cents, sum_exact
from stockpond.functions.temporal import date_key
from stockpond.operators.joins import hot_keys, skew_join
from stockpond.operators.numbering import number_rows
from stockpond.operators.validity import valid_version

# Order pricing rules.
REDUCED_RATE, FULL_RATE, FULL_RATE_COUNTRIES = 0.19, 0.21, ("NL", "BE")
FREE_SHIPPING_ABOVE, DISCOUNT_ABOVE, DISCOUNT_RATE = 50, 200, 0.05


def _current(dimension: DataFrame) -> DataFrame:
    """The valid version of each member, where a dimension keeps history."""
    return dimension.where("is_current") if "is_current" in dimension.columns else dimension


def sales_lines(
    items: DataFrame,
    orders: DataFrame,
    customer_dim: DataFrame,
    product_dim: DataFrame,
    at_order_date: bool = False,
    hot_share: float | None = None,
) -> DataFrame:
    """One row per order item with dimension keys and measures, not numbered yet.

    Each lookup is joined to the table that carries its key, so customers meet
    the smaller orders table and only narrow rows reach the join on order_id.
    Lines of unknown orders, customers or products drop out. With
    ``at_order_date`` the dimensions are Type 2 histories, and keys and cost are
    those of the versions valid when the order was placed. With a ``hot_share``
    the items should be a stored table: a first pass over their order ids finds
    orders with that share of the lines or more, whose lines then stay out of
    the shuffle.
    """
    headers = orders.select(
        "order_id", "customer_id", "order_date", "status", "payment_method", "shipping_country",
        "subtotal", "tax_amount", "shipping_amount",
    )
    lines = items.select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price",
        "discount_percent", "discount_amount", "line_total",
    )
    hot = hot_keys(items, "order_id", hot_share) if hot_share else None

    def with_headers(lines: DataFrame) -> DataFrame:
        return lines.join(headers, "order_id") if hot is None else skew_join(lines, headers, "order_id", hot=hot)

    if at_order_date:
        headers = valid_version(headers, customer_dim, "customer_id", "order_date", ["customer_key"])
        joined = valid_version(with_headers(lines), product_dim, "product_id", "order_date", ["product_key", "cost"])
    else:
        headers = headers.join(_current(customer_dim).select("customer_id", "customer_key"), "customer_id")
        lines = lines.join(_current(product_dim).select("product_id", "product_key", "cost"), "product_id")
        joined = with_headers(lines)

    share = F.try_divide(F.col("line_total"), F.col("subtotal"))
    measured = joined.withColumns({
        "gross_revenue": money(F.col("quantity") * F.col("unit_price")),
        "net_revenue": money("line_total"),
        "cost_of_goods": money(F.col("quantity") * F.col("cost")),
        "allocated_tax": money(F.col("tax_amount") * share),
        "allocated_shipping": money(F.col("shipping_amount") * share),
    }).withColumn("profit", money(F.col("net_revenue") - F.col("cost_of_goods")))
    return measured.select(
        date_key("order_date").alias("date_key"),
        "customer_key",
        "product_key",
        "order_id",
        "order_item_id",
        "order_date",
        "status",
        "payment_method",
        "shipping_country",
        "quantity",
        "unit_price",
        "discount_percent",
        "gross_revenue",
        "discount_amount",
        "net_revenue",
        "cost_of_goods",
        "profit",
        percent_of("profit", "net_revenue").alias("profit_margin_pct"),
        "allocated_tax",
        "allocated_shipping",
        F.current_timestamp().alias("_created_at"),
    )


def fact_sales(
    items: DataFrame,
    orders: DataFrame,
    customer_dim: DataFrame,
    product_dim: DataFrame,
    at_order_date: bool = False,
    hot_share: float | None = None,
) -> DataFrame:
    """Numbered sales fact; the dimensions supply the keys, so fact and dimensions always agree."""
    lines = sales_lines(items, orders, customer_dim, product_dim, at_order_date, hot_share)
    return number_rows(lines, "sale_key", ["order_item_id"])


def allocation_residuals(fact: DataFrame, orders: DataFrame) -> DataFrame:
    """Per order in the fact, what rounding per line left of its tax and shipping."""
    allocated = fact.groupBy("order_id").agg(
        sum_cents("allocated_tax").alias("allocated_tax"),
        sum_cents("allocated_shipping").alias("allocated_shipping"),
    )
    return orders.select("order_id", "tax_amount", "shipping_amount").join(allocated, "order_id").select(
        "order_id",
        money(F.col("tax_amount") - F.col("allocated_tax")).alias("tax_residual"),
        money(F.col("shipping_amount") - F.col("allocated_shipping")).alias("shipping_residual"),
    )


def order_totals(
    items: DataFrame, orders: DataFrame, customers: DataFrame, shipping_quote: str = "shipping_quote"
) -> DataFrame:
    """Order amounts by the pricing rules, rolled up from the lines.

    ``orders`` carries order_id, customer_id and a shipping quote that applies
    to small orders. Lines are added up before any join. Orders of unknown
    customers have no country and the rate of most countries.
    """
    subtotals = items.groupBy("order_id").agg(sum_exact("line_total").alias("subtotal"))
    placed = orders.select("order_id", "customer_id", F.col(shipping_quote).alias("_quote")).join(
        customers.select("customer_id", "country"), "customer_id", "left"
    )
    rate = F.when(F.col("country").isin(*FULL_RATE_COUNTRIES), FULL_RATE).otherwise(REDUCED_RATE)
    subtotal = F.col("subtotal")
    priced = placed.join(subtotals, "order_id").withColumns({
        "tax_amount": money(subtotal * rate),
        "shipping_amount": F.when(subtotal > FREE_SHIPPING_ABOVE, 0.0).otherwise(money("_quote")),
        "discount_amount": F.when(subtotal > DISCOUNT_ABOVE, money(subtotal * DISCOUNT_RATE)).otherwise(0.0),
    })
    total = F.col("subtotal") + F.col("tax_amount") + F.col("shipping_amount") - F.col("discount_amount")
    return priced.select(
        "order_id",
        "customer_id",
        "country",
        money("subtotal").alias("subtotal"),
        "tax_amount",
        "shipping_amount",
        "discount_amount",
        money(total).alias("total_amount"),
        F.lit("EUR").alias("currency"),
    )


def orphan_keys(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Per dimension key, the fact rows with a null key and those without a dimension row.

    The fact is reduced to rows per key before it meets a dimension, so a hot
    key is one row of the join.
    """
    found = None
    for dimension, key in dimensions:
        per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        known = dimension.select(F.col(key).alias("_known"), F.lit(True).alias("_found"))
        row = per_key.join(known, F.col(key) == F.col("_known"), "left").agg(
            F.lit(key).alias("key"),
            F.sum("_rows").alias("fact_rows"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_rows"))), F.lit(0)).alias("null_keys"),
            F.coalesce(F.sum(F.when(F.col("_found").isNull(), F.col("_rows"))), F.lit(0)).alias("orphan_rows"),
        )
        found = row if found is None else found.unionByName(row)
    return found
