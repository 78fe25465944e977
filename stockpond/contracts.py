"""Table contracts: raw schemas, keys, file patterns, enumerations and run configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class SourceTable:
    """One source entity: its all-string raw columns, its key and its business timestamp."""

    name: str
    columns: tuple[str, ...]
    key: str
    recency: str | None
    file_pattern: str

    @property
    def schema(self) -> StructType:
        return StructType([StructField(c, StringType(), c != self.key) for c in self.columns])


# Column names and order of the source tables.
SOURCE_TABLES = {
    table.name: table
    for table in (
        SourceTable(
            "customers",
            ("customer_id", "email", "first_name", "last_name", "phone",
             "country", "city", "address", "created_at", "updated_at"),
            key="customer_id", recency="updated_at", file_pattern="customers*.csv",
        ),
        SourceTable(
            "products",
            ("product_id", "sku", "name", "description", "category", "subcategory",
             "brand", "price", "cost", "stock_quantity", "is_active", "created_at"),
            key="product_id", recency="created_at", file_pattern="products*.csv",
        ),
        SourceTable(
            "orders",
            ("order_id", "customer_id", "order_date", "status", "payment_method",
             "subtotal", "tax_amount", "shipping_amount", "discount_amount",
             "total_amount", "currency", "shipping_country", "shipping_city"),
            key="order_id", recency="order_date", file_pattern="orders*.csv",
        ),
        SourceTable(
            "order_items",
            ("order_item_id", "order_id", "product_id", "quantity", "unit_price",
             "discount_percent", "line_total"),
            key="order_item_id", recency=None, file_pattern="order_items*.csv",
        ),
    )
}

# Allowed codes.
ORDER_STATUSES = ("pending", "confirmed", "shipped", "delivered", "cancelled", "returned")
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "bank_transfer", "cash_on_delivery")
PRODUCT_CATEGORIES = ("electronics", "clothing", "home_garden", "sports", "books", "toys", "beauty", "food")

# Country codes the shop ships to.
COUNTRY_NAMES = (
    ("DE", "Germany"),
    ("FR", "France"),
    ("GB", "United Kingdom"),
    ("ES", "Spain"),
    ("IT", "Italy"),
    ("NL", "Netherlands"),
    ("PL", "Poland"),
    ("BE", "Belgium"),
    ("AT", "Austria"),
    ("PT", "Portugal"),
)

SILVER_TABLES = tuple(SOURCE_TABLES)
GOLD_PARTITIONS = {
    "dim_date": (),
    "dim_product": (),
    "dim_customer": (),
    "fact_sales": ("date_key",),
    "agg_daily_sales": (),
    "agg_product_performance": (),
}
#: Figures that ``run_marts`` builds from the written gold tables.
MART_TABLES = (
    "agg_weekly_sales", "agg_monthly_sales", "agg_category_performance", "agg_daily_revenue",
    "agg_orders_per_customer", "agg_customer_lifetime_value", "top_products", "best_sellers",
)


def source_table(name: str) -> SourceTable:
    """Contract of a source table; an unknown name is an error."""
    try:
        return SOURCE_TABLES[name]
    except KeyError:
        raise ValueError(f"unknown table {name!r}; known: {', '.join(SOURCE_TABLES)}") from None


@dataclass(frozen=True)
class QualityLimits:
    """Tolerances of a run.

    Percentages apply to required fields and key duplicates; the age is that of
    the newest ingested row, ``None`` leaves it unchecked.
    """

    max_null_percentage: float = 1.0
    max_duplicate_percentage: float = 0.1
    max_data_age_hours: float | None = 48
    fail_on_error: bool = True


@dataclass(frozen=True)
class LakeConfig:
    """Where the layers live and how a run behaves.

    Silver tables lie in ``silver_buckets`` buckets of their key; merging a day
    rewrites the buckets that it touches, so large tables want many. With
    ``gate_keys`` a whole run stops before silver where bronze has too many
    missing or repeated keys. Orders with ``hot_order_share`` or more of all
    lines stay out of the shuffle when the fact is built; ``None`` looks for none.
    """

    root: str
    limits: QualityLimits = field(default_factory=QualityLimits)
    calendar_start_year: int = 2020
    calendar_end_year: int = 2030
    silver_buckets: int = 16
    gate_keys: bool = False
    hot_order_share: float | None = 0.01

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"
