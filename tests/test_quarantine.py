"""Malformed records: kept apart with text and place, counted against a budget, added once."""

from __future__ import annotations

import pytest

from stockpond.contracts import LakeConfig, source_table
from stockpond.plans import lake as runs
from stockpond.sources import (
    BadRecordsError,
    FailureBudget,
    QuarantineReport,
    ingest_with_quarantine,
    read_layer,
)
from stockpond.sources import quarantine as module

HEAD = ",".join(source_table("order_items").columns) + "\n"
GOOD = "I{0},O1,P1,1,2.00,0,2.00\n"


@pytest.fixture
def places(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    return raw, str(tmp_path / "bronze"), str(tmp_path / "quarantine")


def items(spark, bronze) -> list[str]:
    return sorted(r["order_item_id"] for r in read_layer(spark, bronze).collect())


def test_bad_records_keep_text_and_place(spark, places):
    raw, bronze, apart = places
    (raw / "a.csv").write_text(HEAD + GOOD.format(1) + "I2,O1\n" + GOOD.format(3))
    (raw / "b.csv").write_text(HEAD + "I4,O1,P1,1,2.00,0,2.00,more,still more\n\n" + HEAD + GOOD.format(5))
    (raw / "empty.csv").write_text("")
    (raw / "title_only.csv").write_text(HEAD)
    report = ingest_with_quarantine(spark, "order_items", str(raw), bronze, apart, "r1", FailureBudget(0.5))
    assert report == QuarantineReport(3, 2)
    assert items(spark, bronze) == ["I1", "I3", "I5"]
    assert read_layer(spark, bronze).columns == [
        *source_table("order_items").columns, "_ingested_at", "_source_file", "_ingestion_date"]
    bad = {r["_corrupt_record"]: r for r in read_layer(spark, apart).collect()}
    assert set(bad) == {"I2,O1", "I4,O1,P1,1,2.00,0,2.00,more,still more"}
    assert bad["I2,O1"]["_source_file"].endswith("a.csv") and bad["I2,O1"]["_block_start"] == 0


def test_a_refused_delivery_changes_nothing_and_passes_with_a_larger_budget(spark, places):
    raw, bronze, apart = places
    (raw / "a.csv").write_text(HEAD + GOOD.format(1) + "I2\n")
    for budget in (FailureBudget(0.1), FailureBudget(1.0, max_records=0)):
        with pytest.raises(BadRecordsError, match="1 of 2"):
            ingest_with_quarantine(spark, "order_items", str(raw), bronze, apart, "r1", budget)
        assert not module.path_exists(spark, bronze)
    for _ in range(2):  # the second call finds the run finished
        report = ingest_with_quarantine(spark, "order_items", str(raw), bronze, apart, "r1", FailureBudget(0.5))
        assert report == QuarantineReport(1, 1) and items(spark, bronze) == ["I1"]
        assert read_layer(spark, apart).count() == 1
    # another run adds its rows to both
    ingest_with_quarantine(spark, "order_items", str(raw), bronze, apart, "r2", FailureBudget(0.5))
    assert items(spark, bronze) == ["I1", "I1"] and read_layer(spark, apart).count() == 2


def test_a_run_cut_short_is_taken_up(spark, places, monkeypatch):
    raw, bronze, apart = places
    (raw / "a.csv").write_text(HEAD + GOOD.format(1) + "I2\n" + GOOD.format(3))
    moves = []

    def once(*given):
        if moves:
            raise OSError("lost")
        moves.append(given)
        real(*given)

    real = module.move_days
    monkeypatch.setattr(module, "move_days", once)
    with pytest.raises(OSError, match="lost"):
        ingest_with_quarantine(spark, "order_items", str(raw), bronze, apart, "r1", FailureBudget(0.5))
    monkeypatch.setattr(module, "move_days", real)
    report = ingest_with_quarantine(spark, "order_items", str(raw), bronze, apart, "r1", FailureBudget(0.5))
    assert report == QuarantineReport(2, 1) and items(spark, bronze) == ["I1", "I3"]
    assert read_layer(spark, apart).count() == 1


def test_a_file_with_other_columns_is_refused(spark, places):
    raw, bronze, apart = places
    swapped = HEAD.replace("order_id,product_id", "product_id,order_id")
    assert swapped != HEAD
    (raw / "a.csv").write_text(swapped + GOOD.format(1))
    with pytest.raises(BadRecordsError, match="a.csv has no header"):
        ingest_with_quarantine(spark, "order_items", str(raw), bronze, apart, "r1", FailureBudget(1.0))


def test_line_breaks_and_json(spark, places, tmp_path):
    raw, bronze, apart = places
    (raw / "a.csv").write_text(HEAD + 'I1,O1,"P\n1",1,2.00,0,2.00\nI2\n')
    report = ingest_with_quarantine(spark, "order_items", str(raw), bronze, apart, "r1", FailureBudget(0.5), multi_line=True)
    assert report == QuarantineReport(1, 1) and read_layer(spark, bronze).first()["product_id"] == "P\n1"
    lines = tmp_path / "json"
    lines.mkdir()
    (lines / "a.json").write_text('{"order_item_id": "I7"}\n{"order_item_id": \n')
    report = ingest_with_quarantine(spark, "order_items", str(lines), bronze, apart, "r2", FailureBudget(0.5), "json")
    assert report == QuarantineReport(1, 1) and items(spark, bronze) == ["I1", "I7"]


def test_a_lake_run_with_a_budget(spark, tmp_path):
    lake = LakeConfig(str(tmp_path))
    folder = tmp_path / "raw" / "order_items"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text(HEAD + GOOD.format(1) + "I2\n")
    found = runs.run_bronze(spark, lake, ["order_items", "orders"], budget=FailureBudget(0.5), run_id="day-1")
    assert found["order_items"].rows == 1 and found["order_items"].metrics == {"quarantined": 1} and found["orders"] is None
    assert items(spark, lake.path("bronze", "order_items")) == ["I1"]
    with pytest.raises(ValueError, match="run_id"):
        runs.run_bronze(spark, lake, budget=FailureBudget())
