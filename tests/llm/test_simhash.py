from __future__ import annotations

import random

from cartlens.llm import simhash
from tests.llm import brute


def found(df):
    return {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.components(df).collect()}


def expected(rows):
    marks = {k: brute.fingerprint(v or "") for k, v in rows}
    tops = brute.components(marks, simhash.RADIUS)
    return {k: (f"{marks[k]:016x}", tops[k]) for k in marks}


def test_given_documents(documents, texts):
    assert found(documents) == expected(texts.items())


def near_copies():
    chance = random.Random(6)
    rows = []
    for group in range(6):
        words = [f"w{chance.randrange(10_000)}" for _ in range(800)]
        for i in range(12):
            changed = list(words)
            if i:
                changed[chance.randrange(800)] = "other"
            rows.append((group * 100 + i, " ".join(changed)))
    return rows


def test_near_copies_and_odd_texts(make_documents):
    rows = [*near_copies(), (900, None), (901, ""), (902, "one"), (903, "ONE"), (904, "two words"), (905, "x " * 30_000)]
    assert found(make_documents(*rows)) == expected(rows)


def test_chains_of_fingerprints(spark):
    """Every second bit flips, so that a component is a long chain."""
    chance = random.Random(7)
    marks, value = {}, 0
    for i in chance.sample(range(200), 200):
        value ^= 1 << (i % 64) | 1 << (i * 7 + 1) % 64
        marks[i] = value
    signed = [(x - 2**64 if x >> 63 else x,) for x in set(marks.values())]
    edges = simhash.links(spark.createDataFrame(signed, "fingerprint long"))
    tops = {r["u"] % 2**64: r["v"] % 2**64 for r in simhash.roots(edges).collect()}
    ours, theirs = {}, {}
    for i, top in brute.components(marks, 2).items():
        theirs.setdefault(top, set()).add(i)
        ours.setdefault(tops.get(marks[i], marks[i]), set()).add(i)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_one_of_each_component_stays(make_documents):
    rows = near_copies()
    kept = simhash.drop_near_copies(make_documents(*rows, rows[0], (None, rows[1][1]), (None, "alone")))
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted({x[1] for x in expected(rows).values()})
    assert ids.count(None) == 1
    assert kept.columns == make_documents(rows[0]).columns


def test_empty_table(make_documents):
    empty = make_documents((1, "a")).limit(0)
    assert simhash.components(empty).collect() == []
    assert simhash.drop_near_copies(empty).collect() == []
