"""Silver layer: one typed, cleaned row per key.

Bronze text is deduplicated first, so only raw columns are shuffled; casting
and derivation follow in one projection. Unreadable values become null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpond.contracts import source_table
from stockpond.functions.bands import customer_segment
from stockpond.functions.money import add_amounts, money, percent_of, within_cent
from stockpond.functions.temporal import as_of_date, parse_timestamp
from stockpond.functions.text import clean_code, email_domain, is_valid_email, parse_flag, person_name
from stockpond.operators.dedup import latest_per_key

NO_DESCRIPTION = "No description available"  # fixed value


def deduplicate(bronze: DataFrame, table: str) -> DataFrame:
    """Last ingested record of each key; on a tie the latest by the table's own timestamp."""
    contract = source_table(table)
    then = [parse_timestamp(contract.recency).desc_nulls_last()] if contract.recency else []
    return latest_per_key(bronze, [contract.key], ["_ingested_at"], then)


def _number(name: str, kind: str = "double") -> Column:
    return F.col(name).try_cast(kind)


def silver_customers(bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    cleaned = deduplicate(bronze, "customers").withColumns({
        "email": clean_code("email"),
        "created_at": parse_timestamp("created_at"),
        "updated_at": parse_timestamp("updated_at"),
    })
    age = F.datediff(as_of_date(as_of), F.col("created_at"))
    return cleaned.select(
        "customer_id",
        "email",
        email_domain(F.col("email")).alias("email_domain"),
        is_valid_email(F.col("email")).alias("is_valid_email"),
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        person_name("first_name", "last_name").alias("full_name"),
        F.trim("phone").alias("phone"),
        clean_code("country", "upper").alias("country"),
        F.trim("city").alias("city"),
        F.trim("address").alias("address"),
        "created_at",
        "updated_at",
        age.alias("account_age_days"),
        customer_segment(age).alias("segment"),
        "_source_file",
        "_ingested_at",
        F.current_timestamp().alias("_processed_at"),
    )


def silver_products(bronze: DataFrame) -> DataFrame:
    price, cost = _number("price"), _number("cost")
    return deduplicate(bronze, "products").select(
        "product_id",
        clean_code("sku", "upper").alias("sku"),
        F.trim("name").alias("name"),
        F.coalesce("description", F.lit(NO_DESCRIPTION)).alias("description"),
        clean_code("category").alias("category"),
        F.trim("subcategory").alias("subcategory"),
        F.trim("brand").alias("brand"),
        price.alias("price"),
        cost.alias("cost"),
        percent_of(price - cost, price).alias("margin_percent"),
        _number("stock_quantity", "int").alias("stock_quantity"),
        parse_flag("is_active").alias("is_active"),
        parse_timestamp("created_at").alias("created_at"),
        "_source_file",
        "_ingested_at",
        F.current_timestamp().alias("_processed_at"),
    )


def silver_orders(bronze: DataFrame) -> DataFrame:
    amounts = ("subtotal", "tax_amount", "shipping_amount", "discount_amount", "total_amount")
    typed = deduplicate(bronze, "orders").withColumns({
        "order_date": parse_timestamp("order_date"),
        **{name: _number(name) for name in amounts},
    })
    expected = add_amounts(["subtotal", "tax_amount", "shipping_amount"], ["discount_amount"])
    return typed.select(
        "order_id",
        "customer_id",
        "order_date",
        F.year("order_date").alias("order_year"),
        F.month("order_date").alias("order_month"),
        F.dayofmonth("order_date").alias("order_day"),
        F.dayofweek("order_date").alias("order_day_of_week"),
        F.weekofyear("order_date").alias("order_week"),
        clean_code("status").alias("status"),
        clean_code("payment_method").alias("payment_method"),
        *amounts,
        expected.alias("calculated_total"),
        within_cent("total_amount", expected).alias("is_total_valid"),
        "currency",
        clean_code("shipping_country", "upper").alias("shipping_country"),
        "shipping_city",
        "_source_file",
        "_ingested_at",
        F.current_timestamp().alias("_processed_at"),
    )


def silver_order_items(bronze: DataFrame) -> DataFrame:
    typed = deduplicate(bronze, "order_items").withColumns({
        "quantity": _number("quantity", "int"),
        "unit_price": _number("unit_price"),
        "discount_percent": _number("discount_percent"),
        "line_total": _number("line_total"),
    })
    gross = money(F.col("quantity") * F.col("unit_price"))
    discount = money(F.col("gross_amount") * F.col("discount_percent") / 100)
    return (
        typed.withColumn("gross_amount", gross)
        .withColumn("discount_amount", discount)
        .withColumn("calculated_line_total", money(F.col("gross_amount") - F.col("discount_amount")))
        .select(
            "order_item_id",
            "order_id",
            "product_id",
            "quantity",
            "unit_price",
            "gross_amount",
            "discount_percent",
            "discount_amount",
            "line_total",
            "calculated_line_total",
            within_cent("line_total", "calculated_line_total").alias("is_line_total_valid"),
            "_source_file",
            "_ingested_at",
            F.current_timestamp().alias("_processed_at"),
        )
    )


SILVER_BUILDERS = {
    "customers": silver_customers,
    "products": silver_products,
    "orders": silver_orders,
    "order_items": silver_order_items,
}


def build_silver(table: str, bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    """Silver form of a bronze table; an unknown name is an error."""
    source_table(table)
    builder = SILVER_BUILDERS[table]
    return builder(bronze, as_of) if table == "customers" else builder(bronze)


def merge_silver(table: str, existing: DataFrame, arrivals: DataFrame, as_of: str | None = None) -> DataFrame:
    """Silver table after rows of further ingestion days: the latest row of each key wins."""
    contract = source_table(table)
    then = [F.col(contract.recency).desc_nulls_last()] if contract.recency else []
    merged = latest_per_key(existing.unionByName(arrivals), [contract.key], ["_ingested_at"], then)
    if table == "customers":  # ages move on for the rows that were already there
        age = F.datediff(as_of_date(as_of), F.col("created_at"))
        merged = merged.withColumns({"account_age_days": age, "segment": customer_segment(age)})
    return merged
