"""The queries against their SQL, and the pipeline against plain versions of its stages."""

from __future__ import annotations

import os

import duckdb
import pytest

import corpus_pipeline
from cartlens.llm.queries import QUERIES, vocabulary
from cartlens.llm.sql import ORACLE
from tests.llm import brute
from tests.llm.test_packing import check
from tests.llm.test_quality import expected_verdicts


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in sorted(os.listdir(brute.FOLDER)):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{brute.FOLDER}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, database, name):
    df = QUERIES[name](spark, brute.FOLDER)
    cursor = database.execute(ORACLE[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == sorted(df.columns)
    ours = sorted(str(tuple(r[x] for x in names)) for r in df.collect())
    assert ours == sorted(str(r) for r in cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op11_html_extraction", "op12_spelling_variants"}))
def test_whole_tables(spark, name, texts):
    rows = QUERIES[name](spark, brute.FOLDER).collect()
    assert {r["doc_id"] for r in rows} == set(texts)


def test_pipeline(spark, documents):
    from tokenizers import Tokenizer

    rows = [(r["doc_id"], r["text"], r["source"]) for r in documents.collect()]
    verdicts = expected_verdicts(rows, 500, 0.3)
    kept = {k: x[2] for k, x in verdicts.items() if x[1]}
    last = {text: doc for doc, text in sorted(kept.items())}
    marks = {doc: brute.fingerprint(text) for text, doc in last.items()}
    stay = {top: kept[top] for top in brute.components(marks, 2).values()}

    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, brute.FOLDER)
        assert docs.columns == columns
        docs.cache()
    mixed = {}
    for r in docs.collect():
        assert stay[r["doc_id"]] == r["text"] and r["n_chars"] == len(r["text"])
        mixed[r["doc_id"]] = mixed.get(r["doc_id"], 0) + 1
    assert set(mixed) == set(stay)
    pieces = corpus_pipeline.run(spark, brute.FOLDER).collect()
    whole = {}
    for r in pieces:
        whole.setdefault(r["doc_id"], []).append(r["length"])
    tokenizer = Tokenizer.from_file(vocabulary())
    for doc, lengths in whole.items():
        tokens = len(tokenizer.encode(stay[doc], add_special_tokens=False).ids) + 1
        assert sum(lengths) == tokens * mixed[doc]
    once = {doc for doc, times in mixed.items() if times == 1}
    assert once and set(whole) == set(stay) and check.__doc__


def test_stages_take_odd_tables(spark, make_documents):
    odd = make_documents((None, None), (1, ""), (1, ""), (2, "word " * 40), (3, " ".join(map(str, range(50)))), (3, None))
    for table in (odd, odd.limit(0)):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, brute.FOLDER)
        docs.collect()
