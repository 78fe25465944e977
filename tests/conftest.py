"""Shared session and fixture rows in bronze shape."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from stockpond.contracts import source_table  # noqa: E402
from stockpond.session import build_session  # noqa: E402

AS_OF = "2024-03-01"
INGESTED = "2024-02-29 10:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="4g", spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bronze(spark):
    """``bronze("orders", {...}, {...})``: rows of a raw table; missing columns are null."""

    def make(table: str, *rows: dict):
        columns = source_table(table).columns
        names = [*columns, "_ingested_at"]
        data = [tuple(row.get(c, INGESTED if c == "_ingested_at" else None) for c in names) for row in rows]
        df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in names))
        return df.withColumns({
            "_ingested_at": F.col("_ingested_at").cast("timestamp"),
            "_source_file": F.lit(f"{table}.csv"),
        })

    return make


@pytest.fixture
def by_key():
    """Rows of a DataFrame as dicts, by the value of a column."""

    def collect(df, key: str) -> dict:
        rows = [row.asDict() for row in df.collect()]
        found = {row[key]: row for row in rows}
        assert len(found) == len(rows), f"{key} is not unique"
        return found

    return collect


@pytest.fixture
def plan_of():
    """Text of the physical plan."""

    def text(df) -> str:
        return df._jdf.queryExecution().explainString(
            df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )

    return text
