from __future__ import annotations

from pyspark.sql import functions as F

from cartlens.llm import exact
from tests.llm import brute


def expected(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    return {d: (max(g), len(g), d == max(g), brute.sha(t)) for t, g in groups.items() for d in g}


def found(df, **options):
    names = ["keep_id", "group_size", "kept", "digest"]
    return {r["doc_id"]: tuple(r[x] for x in names) for r in exact.group_copies(df, **options).collect()}


ROWS = [(i, f"text {i % 5}") for i in range(50)] + [(60, None), (61, ""), (62, " "), (63, "Text 1"), (64, "x" * 200_000)]


def test_given_documents(documents, texts):
    assert found(documents) == expected(texts.items())


def test_copies_over_partitions(make_documents):
    assert found(make_documents(*ROWS, partitions=7), salts=3) == expected(ROWS)


def test_digests_that_collide(make_documents):
    got = found(make_documents(*ROWS), digest=lambda text: F.length(text).cast("string"))
    assert {k: x[:3] for k, x in got.items()} == {k: x[:3] for k, x in expected(ROWS).items()}


def test_one_of_each_stays_with_its_columns(make_documents):
    rows = [*ROWS, ROWS[49], (None, "text 0"), (None, "alone")]
    kept = exact.drop_copies(make_documents(*rows)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted({x[0] for x in expected(ROWS).values()})
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["alone"]
    assert all(r["n_chars"] == len(r["text"]) and r["count"] == 7 for r in kept)


def test_missing_ids(make_documents):
    got = exact.group_copies(make_documents((None, "a"), (None, "a"), (1, "a"), (None, "b"))).collect()
    assert sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in got) == [
        (0, 0, 1, True),
        (0, 1, 3, False),
        (0, 1, 3, False),
        (1, 1, 3, True),
    ]


def test_empty_table(make_documents):
    empty = make_documents((1, "a")).limit(0)
    assert exact.group_copies(empty).collect() == []
    assert exact.drop_copies(empty).columns == empty.columns
