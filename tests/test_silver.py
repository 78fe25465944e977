"""Silver builders on rows with the usual faults."""

from __future__ import annotations

import datetime as dt

import pytest

from stockpond.plans.silver import build_silver, merge_silver
from tests.conftest import AS_OF


def customers(bronze, *rows):
    return build_silver("customers", bronze("customers", *rows), AS_OF)


def test_customer_cleaning(bronze, by_key):
    got = by_key(customers(
        bronze,
        {"customer_id": "C1", "email": "  JOHN.DOE@EXAMPLE.COM ", "first_name": " john", "last_name": "DOE ",
         "country": " de", "city": " Berlin ", "created_at": "2023-01-15T10:30:00", "updated_at": "2023-06-01"},
        {"customer_id": "C2", "email": None, "last_name": "Smith", "created_at": "bad"},
    ), "customer_id")
    first, second = got["C1"], got["C2"]
    assert first["email"] == "john.doe@example.com" and first["email_domain"] == "example.com"
    assert first["is_valid_email"] is True and first["full_name"] == "John Doe"
    assert (first["country"], first["city"], first["first_name"]) == ("DE", "Berlin", "john")
    assert first["created_at"] == dt.datetime(2023, 1, 15, 10, 30)
    assert second["email"] is None and second["is_valid_email"] is None and second["full_name"] == "Smith"
    assert second["created_at"] is None and second["account_age_days"] is None and second["segment"] == "established"


def test_customer_columns(bronze):
    assert customers(bronze, {"customer_id": "C1"}).columns == [
        "customer_id", "email", "email_domain", "is_valid_email", "first_name", "last_name", "full_name", "phone",
        "country", "city", "address", "created_at", "updated_at", "account_age_days", "segment", "_source_file",
        "_ingested_at", "_processed_at",
    ]


@pytest.mark.parametrize("days, segment", [(29, "new"), (30, "regular"), (364, "regular"), (365, "established")])
def test_segment_edges(bronze, days, segment):
    created = dt.date.fromisoformat(AS_OF) - dt.timedelta(days=days)
    row = customers(bronze, {"customer_id": "C1", "created_at": created.isoformat()}).first()
    assert (row.account_age_days, row.segment) == (days, segment)


def test_latest_delivery_wins_and_ties_are_decided_by_the_business_timestamp(bronze, by_key):
    got = by_key(customers(
        bronze,
        {"customer_id": "C1", "city": "old", "updated_at": "2024-01-01", "_ingested_at": "2024-02-01 00:00:00"},
        {"customer_id": "C1", "city": "new", "updated_at": "2023-01-01", "_ingested_at": "2024-02-02 00:00:00"},
        {"customer_id": "C2", "city": "a", "updated_at": "2024-01-02"},
        {"customer_id": "C2", "city": "z", "updated_at": "2024-01-01"},
        {"customer_id": "C2", "city": "zz", "updated_at": None},
        {"customer_id": "C3", "city": "a", "updated_at": None},
        {"customer_id": "C3", "city": "b", "updated_at": None},
    ), "customer_id")
    assert {key: row["city"] for key, row in got.items()} == {"C1": "new", "C2": "a", "C3": "b"}


def test_products(bronze, by_key):
    got = by_key(build_silver("products", bronze(
        "products",
        {"product_id": "P1", "sku": " ab-1 ", "name": " Phone ", "category": " Electronics", "price": "599.99",
         "cost": "350.00", "stock_quantity": "10", "is_active": "true", "description": "nice"},
        {"product_id": "P2", "price": "0", "cost": "1", "is_active": "YES"},
        {"product_id": "P3", "price": "abc", "cost": "1", "is_active": "0", "stock_quantity": "1.5x"},
        {"product_id": "P4", "price": "10", "cost": None, "is_active": None},
        {"product_id": "P5", "price": "10", "cost": "25", "is_active": "1"},
    )), "product_id")
    assert got["P1"]["margin_percent"] == pytest.approx(41.67) and got["P1"]["price"] == 599.99
    assert (got["P1"]["sku"], got["P1"]["name"], got["P1"]["category"]) == ("AB-1", "Phone", "electronics")
    assert [got[f"P{i}"]["margin_percent"] for i in range(2, 6)] == [0.0, 0.0, None, -150.0]
    assert [got[f"P{i}"]["is_active"] for i in range(1, 6)] == [True, True, False, False, True]
    assert got["P2"]["description"] == "No description available" and got["P1"]["description"] == "nice"
    assert got["P3"]["price"] is None and got["P3"]["stock_quantity"] is None and got["P1"]["stock_quantity"] == 10


def order(key, **values):
    parts = {"subtotal": "100", "tax_amount": "19", "shipping_amount": "5", "discount_amount": "4"}
    return {"order_id": key, "total_amount": "120", **parts, **values}


def test_orders(bronze, by_key):
    got = by_key(build_silver("orders", bronze(
        "orders",
        order("O1", order_date="2023-12-01T14:00:00", status=" DELIVERED", payment_method="PayPal ",
              shipping_country=" nl"),
        order("O2", total_amount="120.005"), order("O3", total_amount="120.01"), order("O4", total_amount="120.02"),
        order("O5", tax_amount=None), order("O6", total_amount="x"), order("O7", order_date="soon"),
    )), "order_id")
    first = got["O1"]
    assert (first["order_year"], first["order_month"], first["order_day"]) == (2023, 12, 1)
    assert (first["order_day_of_week"], first["order_week"]) == (6, 48)
    assert (first["status"], first["payment_method"], first["shipping_country"]) == ("delivered", "paypal", "NL")
    assert first["calculated_total"] == 120.0
    assert [got[f"O{i}"]["is_total_valid"] for i in range(1, 7)] == [True, True, False, False, None, None]
    assert got["O7"]["order_date"] is None and got["O7"]["order_week"] is None


def test_order_items(bronze, by_key):
    got = by_key(build_silver("order_items", bronze(
        "order_items",
        {"order_item_id": "I1", "quantity": "1", "unit_price": "599.99", "discount_percent": "0", "line_total": "599.99"},
        {"order_item_id": "I2", "quantity": "3", "unit_price": "0.335", "discount_percent": "12.5", "line_total": "0.88"},
        {"order_item_id": "I3", "quantity": "x", "unit_price": "1", "discount_percent": "0", "line_total": "1"},
        {"order_item_id": "I4", "quantity": "2", "unit_price": "10", "discount_percent": "10", "line_total": "18.01"},
    )), "order_item_id")
    assert got["I1"]["gross_amount"] == 599.99 and got["I1"]["is_line_total_valid"] is True
    assert (got["I2"]["gross_amount"], got["I2"]["discount_amount"], got["I2"]["calculated_line_total"]) == (1.01, 0.13, 0.88)
    assert got["I3"]["quantity"] is None and got["I3"]["gross_amount"] is None
    assert got["I3"]["is_line_total_valid"] is None and got["I4"]["is_line_total_valid"] is False


def test_merge_equals_rebuild(bronze):
    day1 = [order("O1", status="pending", _ingested_at="2024-01-01 00:00:00"),
            order("O2", status="shipped", _ingested_at="2024-01-01 00:00:00")]
    day2 = [order("O1", status="delivered", _ingested_at="2024-01-02 00:00:00"),
            order("O3", status="pending", _ingested_at="2024-01-02 00:00:00")]
    columns = ["order_id", "status", "calculated_total"]
    merged = merge_silver("orders", build_silver("orders", bronze("orders", *day1)),
                          build_silver("orders", bronze("orders", *day2))).select(columns)
    rebuilt = build_silver("orders", bronze("orders", *day1, *day2)).select(columns)
    assert sorted(merged.collect()) == sorted(rebuilt.collect())


def test_merge_moves_customer_ages_on(bronze):
    row = {"customer_id": "C1", "created_at": "2024-02-25", "_ingested_at": "2024-02-26 00:00:00"}
    early = build_silver("customers", bronze("customers", row), "2024-02-26")
    other = build_silver("customers", bronze("customers", {"customer_id": "C2"}), "2024-12-01")
    assert early.first().segment == "new"
    merged = merge_silver("customers", early, other, "2024-12-01").where("customer_id = 'C1'").first()
    assert merged.segment == "regular" and merged.account_age_days == 280


def test_unknown_table(bronze):
    with pytest.raises(ValueError, match="unknown table"):
        build_silver("returns", bronze("orders", {"order_id": "O1"}))
