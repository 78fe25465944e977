"""Standard check lists of the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockpond.contracts import ORDER_STATUSES, QualityLimits
from stockpond.quality.checks import Fresh, InRange, InSet, References, RowCount, Severity, Unique, not_null
from stockpond.quality.engine import evaluate

STRICT = QualityLimits(max_null_percentage=0.0, max_duplicate_percentage=0.0, max_data_age_hours=None)


def _freshness(limits: QualityLimits) -> list[Fresh]:
    return [] if limits.max_data_age_hours is None else [Fresh("_ingested_at", limits.max_data_age_hours)]


def check_customers(customers: DataFrame, limits: QualityLimits = STRICT, as_of: str | None = None) -> DataFrame:
    return evaluate(customers, "customers", [
        *not_null("customer_id", "email", "country", limit=limits.max_null_percentage),
        Unique(["customer_id"], limit=limits.max_duplicate_percentage),
        Unique(["email"], Severity.WARNING),
        RowCount(low=1),
        *_freshness(limits),
    ], as_of)


def check_products(products: DataFrame, limits: QualityLimits = STRICT, as_of: str | None = None) -> DataFrame:
    return evaluate(products, "products", [
        *not_null("product_id", "name", "price", "category", limit=limits.max_null_percentage),
        Unique(["product_id"], limit=limits.max_duplicate_percentage),
        Unique(["sku"], Severity.WARNING),
        InRange("price", low=0),
        InRange("cost", low=0),
        InRange("margin_percent", low=-100, high=100, severity=Severity.WARNING),
        *_freshness(limits),
    ], as_of)


def check_orders(
    orders: DataFrame, customers: DataFrame, limits: QualityLimits = STRICT, as_of: str | None = None
) -> DataFrame:
    return evaluate(orders, "orders", [
        *not_null("order_id", "customer_id", "order_date", "total_amount", limit=limits.max_null_percentage),
        Unique(["order_id"], limit=limits.max_duplicate_percentage),
        InRange("total_amount", low=0),
        InRange("subtotal", low=0),
        InSet("status", ORDER_STATUSES),
        References("customer_id", customers, "customer_id"),
        *_freshness(limits),
    ], as_of)


def check_order_items(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    limits: QualityLimits = STRICT,
    as_of: str | None = None,
) -> DataFrame:
    return evaluate(items, "order_items", [
        *not_null("order_item_id", "order_id", "product_id", "quantity", limit=limits.max_null_percentage),
        Unique(["order_item_id"], limit=limits.max_duplicate_percentage),
        InRange("quantity", low=1),
        InRange("unit_price", low=0),
        InRange("discount_percent", low=0, high=100),
        References("order_id", orders, "order_id"),
        References("product_id", products, "product_id"),
        *_freshness(limits),
    ], as_of)
