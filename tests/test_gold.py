"""Dimensions, facts and aggregates."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockpond.plans import dimensions, facts, marts
from stockpond.plans.silver import build_silver
from tests.conftest import AS_OF


def test_calendar_edges(spark, by_key):
    got = by_key(dimensions.dim_date(dimensions.calendar(spark)), "date")
    assert len(got) == 4018
    leap, new_year, late, end = (got[dt.date(*d)] for d in ((2020, 2, 29), (2021, 1, 1), (2024, 12, 30), (2030, 12, 31)))
    assert (leap["date_key"], leap["is_month_end"], leap["day_of_year"], leap["day_name"]) == (20200229, True, 60, "Saturday")
    assert (leap["is_weekend"], leap["is_weekday"], leap["day_of_week"]) == (True, False, 7)
    assert (new_year["year_week"], new_year["week_of_year"], new_year["is_year_start"]) == ("2021-W53", 53, True)
    assert (late["year_week"], late["year_quarter"], late["month_name_short"]) == ("2024-W01", "2024-Q4", "Dec")
    assert (end["is_year_end"], end["is_quarter_end"], end["fiscal_quarter"], end["year_month"]) == (True, True, 4, "2030-12")
    assert got[dt.date(2024, 4, 1)]["is_quarter_start"] and not got[dt.date(2024, 5, 1)]["is_quarter_start"]
    assert len(leap) == 27


def test_calendar_covers_whole_years_of_a_column(spark):
    df = spark.createDataFrame([("2021-06-30",), ("2023-02-01",), (None,)], "d string").select(F.col("d").cast("date"))
    days = dimensions.calendar_covering(df, "d").agg(F.min("date"), F.max("date"), F.count("date")).first()
    assert days[:] == (dt.date(2021, 1, 1), dt.date(2023, 12, 31), 1095)


def test_holidays(spark, by_key):
    holidays = spark.createDataFrame([(dt.date(2024, 12, 25), "Christmas")], "date date, holiday_name string")
    got = by_key(dimensions.with_holidays(dimensions.dim_date(dimensions.calendar(spark, 2024, 2024)), holidays), "date")
    day = got[dt.date(2024, 12, 25)]
    assert (day["is_holiday"], day["holiday_name"], day["iso_day_of_week"]) == (True, "Christmas", 3)
    assert sum(row["is_holiday"] for row in got.values()) == 1 and got[dt.date(2024, 12, 29)]["iso_day_of_week"] == 7


@pytest.fixture(scope="module")
def silver(bronze):
    """Two reachable customers with orders, one without; items with gaps of every kind."""
    day = "2024-02-01T08:00:00"
    base = {"order_date": day, "status": "delivered", "shipping_country": "de", "discount_amount": "0"}
    return {
        "customers": build_silver("customers", bronze(
            "customers",
            {"customer_id": "C2", "country": "nl", "created_at": "2023-01-01"},
            {"customer_id": "C1", "country": "de", "created_at": "2024-02-20"},
            {"customer_id": "C3", "country": "xx"},
        ), AS_OF),
        "products": build_silver("products", bronze(
            "products",
            {"product_id": "P1", "name": "one", "category": "books", "price": "10", "cost": "4", "stock_quantity": "0"},
            {"product_id": "P2", "name": "two", "category": "books", "price": "600", "cost": None},
            {"product_id": "P3", "name": "three", "category": "toys", "price": "25", "cost": "20"},
        )),
        "orders": build_silver("orders", bronze(
            "orders",
            {"order_id": "O1", "customer_id": "C1", "subtotal": "30", "tax_amount": "5.70", "shipping_amount": "4.99",
             "total_amount": "40.69", **base},
            {"order_id": "O2", "customer_id": "C2", "subtotal": "0", "tax_amount": "1", "shipping_amount": "1",
             "total_amount": "1200", **base},
            {"order_id": "O3", "customer_id": "CX", "subtotal": "5", "total_amount": "5", **base},
            {"order_id": "O4", "customer_id": None, "subtotal": "5", "total_amount": "5", **base},
            {"order_id": "O5", "customer_id": "C1", "subtotal": "1", "total_amount": "60", **base,
             "order_date": "2023-02-01", "status": "cancelled"},
        )),
        "order_items": build_silver("order_items", bronze(
            "order_items",
            {"order_item_id": "I1", "order_id": "O1", "product_id": "P1", "quantity": "2", "unit_price": "10",
             "discount_percent": "0", "line_total": "20"},
            {"order_item_id": "I2", "order_id": "O1", "product_id": "P3", "quantity": "1", "unit_price": "10",
             "discount_percent": "0", "line_total": "10"},
            {"order_item_id": "I3", "order_id": "O2", "product_id": "P2", "quantity": "1", "unit_price": "600",
             "discount_percent": "0", "line_total": "600"},
            {"order_item_id": "I4", "order_id": "O2", "product_id": "PX", "quantity": "1", "unit_price": "1", "line_total": "1"},
            {"order_item_id": "I5", "order_id": "OX", "product_id": "P1", "quantity": "1", "unit_price": "1", "line_total": "1"},
            {"order_item_id": "I6", "order_id": "O3", "product_id": "P1", "quantity": "1", "unit_price": "1", "line_total": "1"},
            {"order_item_id": "I7", "order_id": "O4", "product_id": "P1", "quantity": "1", "unit_price": "1", "line_total": "1"},
            {"order_item_id": "I8", "order_id": "O1", "product_id": None, "quantity": "1", "unit_price": "1", "line_total": "1"},
            {"order_item_id": "I9", "order_id": "O5", "product_id": "P1", "quantity": "1", "unit_price": "0",
             "discount_percent": "0", "line_total": "0"},
        )),
    }


@pytest.fixture(scope="module")
def gold(silver):
    products = dimensions.dim_product(silver["products"])
    customers = dimensions.dim_customer(silver["customers"], silver["orders"], AS_OF)
    fact = facts.fact_sales(silver["order_items"], silver["orders"], customers, products)
    return {"products": products, "customers": customers, "fact": fact}


def test_product_dimension(gold, by_key):
    got = by_key(gold["products"], "product_id")
    assert [got[p]["product_key"] for p in ("P1", "P2", "P3")] == [1, 2, 3]
    assert [got[p]["price_tier"] for p in ("P1", "P2", "P3")] == ["economy", "premium", "budget"]
    assert [got[p]["is_high_margin"] for p in ("P1", "P2", "P3")] == [True, None, False]
    assert (got["P1"]["stock_status"], got["P2"]["stock_status"]) == ("out_of_stock", "well_stocked")
    assert got["P1"]["is_current"] and got["P1"]["effective_to"] is None and len(got["P1"]) == 20


def test_customer_dimension(gold, by_key):
    got = by_key(gold["customers"], "customer_id")
    assert [got[c]["customer_key"] for c in ("C1", "C2", "C3")] == [1, 2, 3]
    assert (got["C1"]["total_orders"], got["C1"]["total_spend"], got["C1"]["value_tier"]) == (2, 100.69, "silver")
    assert (got["C1"]["customer_status"], got["C1"]["days_since_last_order"]) == ("active", 29)
    assert got["C1"]["avg_order_value"] == pytest.approx(50.345) and got["C2"]["value_tier"] == "platinum"
    prospect = got["C3"]
    assert (prospect["customer_status"], prospect["total_orders"], prospect["total_spend"]) == ("prospect", 0, 0.0)
    assert prospect["value_tier"] == "bronze" and prospect["avg_order_value"] is None and len(prospect) == 23


@pytest.mark.parametrize("spend, days, tier, status", [
    ("99.99", 90, "bronze", "active"), ("100", 91, "silver", "at_risk"), ("500", 365, "gold", "at_risk"),
    ("1000", 366, "platinum", "churned"),
])
def test_customer_band_edges(bronze, spend, days, tier, status):
    placed = (dt.date.fromisoformat(AS_OF) - dt.timedelta(days=days)).isoformat()
    orders = build_silver("orders", bronze("orders", {"order_id": "O", "customer_id": "C", "total_amount": spend,
                                                      "order_date": placed}))
    customers = build_silver("customers", bronze("customers", {"customer_id": "C"}), AS_OF)
    row = dimensions.customer_profiles(customers, orders, AS_OF).first()
    assert (row.value_tier, row.customer_status) == (tier, status)


def test_fact(gold, by_key):
    got = by_key(gold["fact"], "order_item_id")
    assert sorted(got) == ["I1", "I2", "I3", "I9"]
    assert [got[i]["sale_key"] for i in sorted(got)] == [1, 2, 3, 4]
    first = got["I1"]
    assert (first["date_key"], first["customer_key"], first["product_key"]) == (20240201, 1, 1)
    assert (first["gross_revenue"], first["net_revenue"], first["cost_of_goods"], first["profit"]) == (20, 20, 8, 12)
    assert (first["profit_margin_pct"], first["allocated_tax"], first["allocated_shipping"]) == (60.0, 3.8, 3.33)
    assert got["I3"]["profit"] is None and got["I3"]["profit_margin_pct"] is None
    assert got["I3"]["allocated_tax"] is None and got["I9"]["profit_margin_pct"] == 0.0
    assert list(first) == [
        "sale_key", "date_key", "customer_key", "product_key", "order_id", "order_item_id", "order_date", "status",
        "payment_method", "shipping_country", "quantity", "unit_price", "discount_percent", "gross_revenue",
        "discount_amount", "net_revenue", "cost_of_goods", "profit", "profit_margin_pct", "allocated_tax",
        "allocated_shipping", "_created_at",
    ]


def test_allocation_residuals(gold, silver, by_key):
    got = by_key(facts.allocation_residuals(gold["fact"], silver["orders"]), "order_id")
    assert got["O1"]["tax_residual"] == 0.0 and got["O1"]["shipping_residual"] == 0.0
    assert got["O2"]["tax_residual"] is None


def test_orphans(gold):
    rows = facts.orphan_keys(gold["fact"], [(gold["customers"].where("customer_id <> 'C1'"), "customer_key"),
                                            (gold["products"], "product_key")]).collect()
    assert sorted(tuple(r) for r in rows) == [("customer_key", 4, 0, 3), ("product_key", 4, 0, 0)]


def test_daily_sales(gold):
    rows = {r.date_key: r for r in marts.daily_sales(gold["fact"]).collect()}
    day = rows[20240201]
    assert (day.total_orders, day.total_items_sold, day.unique_customers) == (2, 4, 2)
    assert (day.net_revenue, day.total_profit, day.avg_order_value, day.items_per_order) == (630.0, 2.0, 315.0, 2.0)
    assert day.avg_profit_margin == (60 - 100) / 2
    total = gold["fact"].agg(F.sum("net_revenue")).first()[0]
    assert sum(r.net_revenue for r in rows.values()) == total


def test_periods(gold):
    weeks = {r.period_start for r in marts.sales_by_period(gold["fact"], "week").collect()}
    months = {r.period_start for r in marts.sales_by_period(gold["fact"], "month").collect()}
    assert weeks == {dt.date(2024, 1, 29), dt.date(2023, 1, 30)} and months == {dt.date(2024, 2, 1), dt.date(2023, 2, 1)}


def test_products_ranked(gold, by_key):
    got = by_key(marts.product_performance(gold["fact"], gold["products"]), "product_id")
    assert {p: got[p]["revenue_rank_in_category"] for p in got} == {"P2": 1, "P1": 2, "P3": 1}
    assert (got["P1"]["total_revenue"], got["P1"]["number_of_orders"], got["P1"]["avg_selling_price"]) == (20.0, 2, 5.0)
    assert got["P1"]["profit_margin_pct"] == 40.0 and got["P2"]["profit_margin_pct"] is None
    assert [r.product_id for r in marts.best_sellers(gold["fact"], gold["products"], 2).collect()] == ["P2", "P1"]
    top = {(r.category, r.product_id) for r in marts.top_products(gold["fact"], gold["products"], 1).collect()}
    assert top == {("books", "P2"), ("toys", "P3")}


def test_business_figures(gold, silver):
    totals = marts.business_totals(gold["fact"]).first()
    assert (totals.fact_rows, totals.total_revenue, totals.total_profit, totals.profit_margin_pct) == (4, 630.0, -2.0, -0.32)
    assert marts.orders_per_customer(gold["fact"]).first()[:] == (3, 2, 1.5)
    assert {r.date_key: r.daily_revenue for r in marts.daily_revenue(gold["fact"]).collect()} == {20240201: 630.0, 20230201: 0.0}
    value = {r[0]: r[1] for r in marts.customer_lifetime_value(silver["orders"]).collect()}
    assert value == {"C1": 100.69, "C2": 1200.0, "CX": 5.0}


def test_category_performance(gold, spark):
    dates = dimensions.dim_date(dimensions.calendar(spark, 2023, 2024))
    rows = marts.category_performance(gold["fact"], gold["products"], dates).collect()
    assert {(r.category, r.year_month): r.revenue for r in rows} == {
        ("books", "2024-02"): 620.0, ("toys", "2024-02"): 10.0, ("books", "2023-02"): 0.0
    }


def test_order_totals(spark, by_key):
    items = spark.createDataFrame([("A", 150.0), ("A", 60.0), ("B", 40.0), ("C", 50.0)], "order_id string, line_total double")
    orders = spark.createDataFrame([("A", "NL1", 5.0), ("B", "DE1", 3.99), ("C", "DE1", 7.0), ("D", "DE1", 1.0)],
                                   "order_id string, customer_id string, shipping_quote double")
    customers = spark.createDataFrame([("NL1", "NL"), ("DE1", "DE")], "customer_id string, country string")
    got = by_key(facts.order_totals(items, orders, customers), "order_id")
    a, b, c = got["A"], got["B"], got["C"]
    assert (a["subtotal"], a["tax_amount"], a["shipping_amount"], a["discount_amount"], a["total_amount"]) == (210, 44.1, 0, 10.5, 243.6)
    assert (b["tax_amount"], b["shipping_amount"], b["discount_amount"], b["total_amount"]) == (7.6, 3.99, 0.0, 51.59)
    assert c["shipping_amount"] == 7.0 and "D" not in got


def test_country_names(spark):
    df = spark.createDataFrame([("DE",), ("XX",), (None,)], "country string")
    assert sorted(map(str, (r.country_name for r in dimensions.with_country_name(df).collect()))) == ["Germany", "None", "None"]
