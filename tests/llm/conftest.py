from __future__ import annotations

import pytest

from rollcall.llm.common import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) or (id, text, source) rows, dealt over three partitions."""

    def make(rows, repartition=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(repartition)

    return make
