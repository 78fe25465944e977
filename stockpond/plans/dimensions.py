"""Gold dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpond.contracts import COUNTRY_NAMES
from stockpond.functions.bands import (
    HIGH_MARGIN_PERCENT,
    behavior_segment,
    customer_status,
    price_tier,
    stock_status,
    value_tier,
)
from stockpond.functions.money import mean_exact, sum_exact
from stockpond.functions.temporal import as_of_date, calendar_columns
from stockpond.operators.numbering import number_rows

# Attributes whose changes open a new version of a member.
TRACKED_ATTRIBUTES = {
    "dim_product": ("sku", "name", "category", "subcategory", "brand", "price", "cost", "margin_percent", "is_active"),
    "dim_customer": ("email", "full_name", "country", "city", "segment"),
}
NATURAL_KEYS = {"dim_product": "product_id", "dim_customer": "customer_id"}
SURROGATE_KEYS = {"dim_product": "product_key", "dim_customer": "customer_key"}


def calendar(spark: SparkSession, start_year: int = 2020, end_year: int = 2030) -> DataFrame:
    """One row per day of the given years, made inside Spark."""
    bounds = spark.range(1).select(
        F.make_date(F.lit(start_year), F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(F.lit(end_year), F.lit(12), F.lit(31)).alias("last_day"),
    )
    return _days(bounds)


def calendar_covering(df: DataFrame, column: str) -> DataFrame:
    """One row per day of all years in which ``column`` has a value."""
    bounds = df.agg(
        F.trunc(F.min(column), "year").alias("first_day"),
        F.date_sub(F.add_months(F.trunc(F.max(column), "year"), 12), 1).alias("last_day"),
    )
    return _days(bounds)


def _days(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("date"))


def dim_date(days: DataFrame) -> DataFrame:
    return days.select("date", *calendar_columns("date"), F.current_timestamp().alias("_created_at"))


def with_holidays(dates: DataFrame, holidays: DataFrame) -> DataFrame:
    """Add the holiday name and flag from a (date, holiday_name) table, and a Monday = 1 weekday."""
    return dates.join(holidays, "date", "left").withColumns({
        "is_holiday": F.col("holiday_name").isNotNull(),
        "iso_day_of_week": F.weekday("date") + 1,
    })


def product_profiles(products: DataFrame) -> DataFrame:
    """Product attributes with bands; the dimension without its surrogate key."""
    return products.select(
        "product_id",
        "sku",
        "name",
        "description",
        "brand",
        "category",
        "subcategory",
        "price",
        "cost",
        "margin_percent",
        price_tier(F.col("price")).alias("price_tier"),
        (F.col("margin_percent") >= HIGH_MARGIN_PERCENT).alias("is_high_margin"),
        "stock_quantity",
        stock_status(F.col("stock_quantity")).alias("stock_status"),
        "is_active",
        F.col("created_at").alias("effective_from"),
        F.lit(None).cast("timestamp").alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.current_timestamp().alias("_created_at"),
    )


def dim_product(products: DataFrame) -> DataFrame:
    return number_rows(product_profiles(products), "product_key", ["product_id"])


def with_stable_keys(profiles: DataFrame, history: DataFrame, key: str, natural_key: str) -> DataFrame:
    """The dimension with the surrogate keys and start dates that its members' current versions have in the history."""
    current = history.where("is_current").select(
        F.col(natural_key).alias("_member"), key, F.col("effective_from").alias("_since"))
    found = profiles.join(current, F.col(natural_key).eqNullSafe(F.col("_member")))
    rest = [F.col("_since").alias(c) if c == "effective_from" else F.col(c) for c in profiles.columns]
    return found.select(key, *rest)


def start_history(dimension: DataFrame, key: str, natural_key: str, tracked: Sequence[str]) -> DataFrame:
    """Type 2 history of a dimension at its first load: every member with one open version."""
    return dimension.select(key, natural_key, *tracked, "effective_from", "effective_to", "is_current")


def customer_metrics(orders: DataFrame) -> DataFrame:
    """Order count, spend and dates per customer, over orders of every status."""
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        sum_exact("total_amount").alias("total_spend"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        mean_exact("total_amount").alias("avg_order_value"),
    )


def customer_profiles(customers: DataFrame, orders: DataFrame, as_of: str | None = None) -> DataFrame:
    """Customer attributes with metrics and bands; the dimension without its surrogate key."""
    idle_days = F.datediff(as_of_date(as_of), F.col("last_order_date"))
    return customers.join(customer_metrics(orders), "customer_id", "left").select(
        "customer_id",
        "email",
        "full_name",
        "first_name",
        "last_name",
        "phone",
        "country",
        "city",
        "segment",
        value_tier(F.col("total_spend")).alias("value_tier"),
        customer_status(F.col("total_orders"), idle_days).alias("customer_status"),
        "is_valid_email",
        F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce("total_spend", F.lit(0.0)).alias("total_spend"),
        "first_order_date",
        "last_order_date",
        "avg_order_value",
        idle_days.alias("days_since_last_order"),
        F.col("created_at").alias("effective_from"),
        F.lit(None).cast("timestamp").alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.current_timestamp().alias("_created_at"),
    )


def dim_customer(customers: DataFrame, orders: DataFrame, as_of: str | None = None) -> DataFrame:
    return number_rows(customer_profiles(customers, orders, as_of), "customer_key", ["customer_id"])


def with_behavior_segment(profiles: DataFrame) -> DataFrame:
    """Add the four-way behaviour group next to the age-based segment."""
    return profiles.withColumn(
        "behavior_segment", behavior_segment(F.col("customer_status"), F.col("value_tier"), F.col("segment"))
    )


def with_country_name(df: DataFrame, code_column: str = "country") -> DataFrame:
    """Add ``country_name``; unknown codes give null. The code table is fixed, hence small."""
    names = df.sparkSession.createDataFrame(list(COUNTRY_NAMES), f"{code_column} string, country_name string")
    return df.join(F.broadcast(names), code_column, "left")
