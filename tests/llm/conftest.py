from __future__ import annotations

import pytest

from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, count int"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{brute.FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {x["doc_id"]: x["text"] for x in documents.collect()}


@pytest.fixture(scope="session")
def make_documents(spark):
    """Documents of (doc_id, text) or (doc_id, text, source), with columns of clashing names."""

    def make(*rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", None if r[1] is None else len(r[1]), "x", 7) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make
