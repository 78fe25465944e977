"""Documents for small tests of the operators."""

from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """``documents((1, "text"), ...)`` with the columns of the table; a third value is the language."""

    def make(*rows: tuple):
        data = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    return make
