"""Incremental ingestion: files once, replayed and broken batches, mixing with plain runs."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockpond.contracts import LakeConfig, source_table
from stockpond.plans import lake as runs
from stockpond.sources import read_layer
from stockpond.streaming import incremental
from stockpond.streaming.incremental import publish_epoch

HEAD = ",".join(source_table("order_items").columns) + "\n"


def put(folder: Path, name: str, text: str) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def stamped(spark, *ids: int):
    return spark.createDataFrame([(i,) for i in ids], "id int").withColumn(
        "_ingestion_date", F.date_add(F.lit("2024-01-01"), F.col("id") % 2))


def ids(spark, path) -> list[int]:
    return sorted(r.id for r in spark.read.parquet(str(path)).collect())


def test_a_replayed_epoch_adds_nothing(spark, tmp_path):
    bronze, ledger = str(tmp_path / "bronze"), str(tmp_path / "ledger")
    assert publish_epoch(stamped(spark, 1, 2, 3), 0, bronze, ledger) == 3
    assert publish_epoch(stamped(spark, 1, 2, 3), 0, bronze, ledger) == 0
    assert publish_epoch(stamped(spark, 4), 1, bronze, ledger) == 1
    assert ids(spark, bronze) == [1, 2, 3, 4]


def test_an_epoch_cut_short_is_taken_up(spark, tmp_path):
    bronze, ledger = tmp_path / "bronze", tmp_path / "ledger"
    # everything is written beside the ledger, one of two days has moved, the ledger has no note yet
    work = ledger / "_work-0"
    stamped(spark, 1, 2, 3).coalesce(1).write.partitionBy("_ingestion_date").parquet(str(work))
    day = sorted(p for p in work.iterdir() if p.is_dir())[0]
    (bronze / day.name).mkdir(parents=True)
    for part in day.glob("part-*"):
        part.rename(bronze / day.name / part.name)
    publish_epoch(stamped(spark, 1, 2, 3), 0, str(bronze), str(ledger))
    assert ids(spark, bronze) == [1, 2, 3]
    # a batch that broke while it was written is written anew
    (ledger / "_work-1" / "_ingestion_date=2024-01-01").mkdir(parents=True)
    (ledger / "_work-1" / "_ingestion_date=2024-01-01" / "part-0.parquet").write_text("half")
    publish_epoch(stamped(spark, 7), 1, str(bronze), str(ledger))
    assert ids(spark, bronze) == [1, 2, 3, 7] and not list(ledger.glob("_work-*"))


def test_a_failing_batch_is_repeated_by_the_next_call(spark, tmp_path, monkeypatch):
    raw, bronze, state = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "state")
    put(raw, "a.csv", HEAD + "I1,O1,P1,1,1,0,1\n")
    real = publish_epoch

    def broken(batch, epoch, path, ledger):
        real(batch, epoch, path, ledger)
        raise RuntimeError("lost after the rows were published")

    monkeypatch.setattr(incremental, "publish_epoch", broken)
    with pytest.raises(Exception, match="lost after"):
        incremental.ingest_new_files(spark, "order_items", str(raw), bronze, state, timeout_seconds=120)
    monkeypatch.undo()
    put(raw, "b.csv", HEAD + "I2,O1,P1,1,1,0,1\n")
    assert incremental.ingest_new_files(spark, "order_items", str(raw), bronze, state, timeout_seconds=120) == 1
    assert sorted(r.order_item_id for r in read_layer(spark, bronze).collect()) == ["I1", "I2"]


def test_plain_and_incremental_runs_mix(spark, tmp_path):
    lake = LakeConfig(str(tmp_path))
    raw = Path(lake.path("raw", "order_items"))
    put(raw, "order_items_1.csv", HEAD + "I1,O1,P1,1,1,0,1\nI2,O1,P1,1,1,0,1\n")
    assert runs.run_bronze(spark, lake, ["order_items"], incremental=True)["order_items"].rows == 2
    assert runs.run_bronze(spark, lake, ["order_items"], incremental=True)["order_items"].rows == 0
    put(raw, "order_items_2.csv", HEAD + "I3,O1,P1,1,1,0,1\n")
    put(raw, "notes.csv", "something else\n1\n")
    assert runs.run_bronze(spark, lake, ["order_items"], match_pattern=True)["order_items"].rows == 3
    taken = runs.run_bronze(spark, lake, ["order_items"], incremental=True, match_pattern=True)
    assert taken["order_items"].rows == 1
    bronze = read_layer(spark, lake.path("bronze", "order_items"))
    assert sorted(r.order_item_id for r in bronze.collect()) == ["I1", "I1", "I2", "I2", "I3", "I3"]
    runs.run_silver(spark, lake, ["order_items"])
    assert read_layer(spark, lake.path("silver", "order_items")).count() == 3
    assert runs.run_bronze(spark, lake, ["orders"], incremental=True) == {"orders": None}
    with pytest.raises(ValueError, match="cannot replace"):
        runs.run_bronze(spark, lake, ["orders"], incremental=True, replace_day=True)


def test_the_log_of_a_stream_sink_is_refused(spark, tmp_path):
    (tmp_path / "bronze" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(RuntimeError, match="hides rows"):
        incremental.ingest_new_files(spark, "orders", str(tmp_path), str(tmp_path / "bronze"), str(tmp_path / "s"))
