"""Classification of customers and products into named bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band limits, tested from the top of each list.
VALUE_TIERS = ((1000, "platinum"), (500, "gold"), (100, "silver"))
PRICE_TIERS = ((500, "premium"), (100, "mid_range"), (25, "budget"))
SEGMENT_DAYS = ((30, "new"), (365, "regular"))
STOCK_LEVELS = ((10, "low_stock"), (50, "normal"))
STATUS_DAYS = ((365, "churned"), (90, "at_risk"))
HIGH_MARGIN_PERCENT = 40


def _ladder(steps, otherwise: str) -> Column:
    """CASE over (condition, label) pairs; a null condition falls through."""
    first, *rest = steps
    chain = F.when(*first)
    for condition, label in rest:
        chain = chain.when(condition, label)
    return chain.otherwise(otherwise)


def value_tier(spend: Column) -> Column:
    return _ladder([(spend >= low, label) for low, label in VALUE_TIERS], "bronze")


def price_tier(price: Column) -> Column:
    return _ladder([(price >= low, label) for low, label in PRICE_TIERS], "economy")


def customer_segment(age_days: Column) -> Column:
    return _ladder([(age_days < limit, label) for limit, label in SEGMENT_DAYS], "established")


def stock_status(quantity: Column) -> Column:
    """Zero is out of stock; a negative count, like any below ten, is low stock."""
    return _ladder(
        [(quantity == 0, "out_of_stock"), *((quantity < limit, label) for limit, label in STOCK_LEVELS)],
        "well_stocked",
    )


def customer_status(orders: Column, idle_days: Column) -> Column:
    return _ladder(
        [(orders.isNull(), "prospect"), *((idle_days > limit, label) for limit, label in STATUS_DAYS)],
        "active",
    )


def behavior_segment(status: Column, tier: Column, segment: Column) -> Column:
    """Own rule for the four behaviour groups: lapsed first, then top spenders, then newcomers."""
    return _ladder(
        [(status == "churned", "inactive"), (tier == "platinum", "vip"), (segment == "new", "new")],
        "regular",
    )
