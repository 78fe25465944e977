"""Checks, suites, gates and record contracts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stockpond.contracts import QualityLimits
from stockpond.plans.silver import build_silver
from stockpond.quality import (
    DataQualityError,
    Fresh,
    InRange,
    InSet,
    References,
    RowCount,
    Severity,
    Unique,
    check_customers,
    check_keys,
    check_order_items,
    check_orders,
    check_products,
    count_violations,
    enforce,
    evaluate,
    gate,
    key_counters,
    not_null,
    report,
    summarize,
    with_violations,
)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0, "x"), (2, "b", -1.0, None), (2, "b", 101.0, "q"), (None, None, None, "x"), (None, None, 7.0, "x")],
        "id int, code string, amount double, kind string",
    )


def run(df, *checks, **options):
    return {r.check_name: r for r in evaluate(df, "t", checks, **options).collect()}


def test_not_null_and_missing_column(rows):
    got = run(rows, *not_null("id", "nope", severity=Severity.WARNING))
    assert got["not_null_id"][:7] == ("t", "not_null_id", "warning", False, 2, 5, 40.0)
    assert got["not_null_nope"][:7] == ("t", "not_null_nope", "error", False, 0, 0, 0.0)


def test_unique_treats_null_as_a_value(rows):
    got = run(rows, Unique(["id"]), Unique(["id", "code"], Severity.INFO), Unique(["id", "code", "amount"]))
    assert (got["unique_id"].failed_count, got["unique_id+code"].failed_count) == (2, 2)
    assert got["unique_id+code+amount"].passed and got["unique_id"].failed_percentage == 40.0


def test_sets_and_ranges_let_null_pass(rows):
    got = run(rows, InSet("kind", ["x", "y"]), InRange("amount", low=0, high=100), InRange("amount", low=0),
              InRange("id"))
    assert got["valid_values_kind"].failed_count == 1 and got["range_id"].passed
    assert run(rows, InRange("amount", low=0, high=100))["range_amount"].failed_count == 2
    assert run(rows, InRange("amount", high=101))["range_amount"].passed


def test_references_count_distinct_orphans(rows, spark):
    known = spark.createDataFrame([("a",)], "code string")
    got = run(rows, References("code", known, "code"), *not_null("id"), RowCount())
    assert got["ref_integrity_code"][3:7] == (False, 2, 5, 40.0) and got["not_null_id"].failed_count == 2


@pytest.mark.parametrize("low, high, passed", [(1, None, True), (5, 5, True), (6, None, False), (1, 4, False)])
def test_row_count(rows, low, high, passed):
    got = run(rows, RowCount(low, high))["row_count"]
    assert (got.passed, got.failed_count, got.total_count, got.failed_percentage) == (passed, int(not passed), 5, 0.0)


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), (None,)], "ts string").selectExpr("cast(ts as timestamp) ts")
    assert run(df, Fresh("ts", 24), as_of="2024-01-02 00:00:00")["freshness_ts"].passed
    stale = run(df, Fresh("ts", 24), as_of="2024-01-02 00:00:01")["freshness_ts"]
    assert (stale.passed, stale.severity, stale.failed_count) == (False, "warning", 0)
    assert not run(df.where("ts is null"), Fresh("ts"))["freshness_ts"].passed


def test_limits(rows):
    assert run(rows, *not_null("id", limit=40.0))["not_null_id"].passed
    assert not run(rows, *not_null("id", limit=39.9))["not_null_id"].passed


def test_empty_table(rows):
    got = run(rows.limit(0), *not_null("id"), Unique(["id"]), RowCount(), InRange("amount", low=0))
    assert [got[n].passed for n in ("not_null_id", "unique_id", "row_count", "range_amount")] == [True, True, False, True]
    assert all(r.failed_percentage == 0.0 for r in got.values())


def test_gate_levels(rows):
    warned = evaluate(rows, "t", [*not_null("id", severity=Severity.WARNING), *not_null("code", severity=Severity.INFO)])
    assert gate(warned).first()[:] == ("t", True, 0)
    assert gate(warned, include_warnings=True).first()[:] == ("t", False, 1)
    enforce(warned)
    with pytest.raises(DataQualityError, match="t.not_null_id"):
        enforce(warned, include_warnings=True)
    missing = evaluate(rows, "t", not_null("nope", severity=Severity.INFO))
    with pytest.raises(DataQualityError):
        enforce(missing)


def test_summary_and_report(rows):
    results = evaluate(rows, "t", [*not_null("id"), RowCount()])
    assert summarize(results).first()[:] == ("t", 5, 2, 1, 1, "failed")
    lines = {r.check_name: r.line for r in report(results).collect()}
    assert lines["not_null_id"] == "FAILED [ERROR] not_null_id: id must not be null (2/5 = 40.00%)"


def test_suites(bronze):
    customers = build_silver("customers", bronze(
        "customers", {"customer_id": "C1", "email": "a@b.com", "country": "de"},
        {"customer_id": "C2", "email": "a@b.com", "country": "de"},
    ), "2024-01-01")
    products = build_silver("products", bronze(
        "products", {"product_id": "P1", "name": "n", "category": "books", "price": "-1", "cost": "1", "sku": "s"}))
    orders = build_silver("orders", bronze(
        "orders", {"order_id": "O1", "customer_id": "C1", "order_date": "2024-01-01", "subtotal": "1",
                   "total_amount": "1", "status": "Lost"},
        {"order_id": "O2", "customer_id": "CX", "order_date": "2024-01-01", "subtotal": "1", "total_amount": "1"}))
    items = build_silver("order_items", bronze(
        "order_items", {"order_item_id": "I1", "order_id": "O1", "product_id": "P1", "quantity": "0",
                        "unit_price": "1", "discount_percent": "101"},
        {"order_item_id": "I2", "order_id": "OX", "quantity": "1"}))

    def failed(results):
        return {r.check_name: (r.severity, r.failed_count) for r in results.collect() if not r.passed}

    assert failed(check_customers(customers)) == {"unique_email": ("warning", 1)}
    assert failed(check_products(products)) == {"range_price": ("error", 1)}
    assert failed(check_orders(orders, customers)) == {
        "valid_values_status": ("error", 1), "ref_integrity_customer_id": ("error", 1)}
    assert failed(check_order_items(items, orders, products)) == {
        "not_null_product_id": ("error", 1), "range_quantity": ("error", 1), "range_discount_percent": ("error", 1),
        "ref_integrity_order_id": ("error", 1), "ref_integrity_product_id": ("error", 1)}
    lenient = failed(check_order_items(items, orders, products, QualityLimits(max_null_percentage=50)))
    assert "not_null_product_id" not in lenient
    counts = {name: len(frame.collect()) for name, frame in {
        "customers": check_customers(customers), "products": check_products(products),
        "orders": check_orders(orders, customers), "items": check_order_items(items, orders, products)}.items()}
    assert counts == {"customers": 6, "products": 9, "orders": 9, "items": 10}


def test_record_contracts(bronze):
    products = build_silver("products", bronze(
        "products",
        {"product_id": "P1", "sku": "s", "name": "n", "category": "books", "price": "1", "cost": "3",
         "stock_quantity": "-1", "created_at": "2024-01-01"},
        {"product_id": "P2", "category": "cars", "price": "1", "cost": "2"},
    ))
    broken = {r.product_id: r.violations for r in with_violations(products, "products").collect()}
    assert broken["P1"] == ["stock_quantity_not_negative", "price_at_least_half_cost"]
    assert broken["P2"] == ["sku_present", "name_present", "stock_quantity_present", "created_at_present", "category_known"]
    counted = {r.rule: r.violations for r in count_violations(products, "products").collect()}
    assert counted["category_known"] == 1 and counted["price_present"] == 0 and len(counted) == 13
    orders = build_silver("orders", bronze("orders", *[
        {"order_id": f"O{i}", "subtotal": "10", "tax_amount": "0", "shipping_amount": "0", "discount_amount": "0",
         "total_amount": total} for i, total in enumerate(["10", "10.01", "10.02"])]))
    counted = {r.rule: r.violations for r in count_violations(orders, "orders").collect()}
    assert counted["total_matches_parts"] == 1 and counted["status_present"] == 3 and counted["status_known"] == 0


def test_key_counters_per_day(spark):
    rows = [("2024-01-01", "A"), ("2024-01-01", " A "), ("2024-01-01", "B"), ("2024-01-01", None), ("2024-01-01", " "),
            ("2024-01-02", "A"), ("2024-01-02", "A"), ("2024-01-02", "A")]
    bronze = spark.createDataFrame(rows, "d string, id string").select(F.col("d").cast("date").alias("_ingestion_date"), "id")
    counters = key_counters(bronze, "things", "id")
    found = {str(r["_ingestion_date"]): (r["rows"], r["null_keys"], r["repeated"]) for r in counters.collect()}
    assert found == {"2024-01-01": (5, 2, 1), "2024-01-02": (3, 0, 2)}
    every = {r["check_name"]: r for r in check_keys(counters, QualityLimits(25.0, 37.0)).collect()}
    assert every["bronze_not_null_id"]["passed"] and not every["bronze_unique_id"]["passed"]
    assert every["bronze_unique_id"]["failed_count"] == 3 and every["bronze_unique_id"]["total_count"] == 8
    day = {r["check_name"]: r["failed_count"] for r in check_keys(counters, QualityLimits(), ["2024-01-02"]).collect()}
    assert day == {"bronze_not_null_id": 0, "bronze_unique_id": 2}
    assert check_keys(key_counters(bronze.limit(0), "things", "id"), QualityLimits()).count() == 0
    # the columns are those of every other check
    assert check_keys(counters, QualityLimits()).columns == evaluate(bronze, "things", not_null("id")).columns
