from __future__ import annotations

import math
import random

import pytest

from cartlens.llm import mixing
from tests.llm import brute


def plain_weights(tokens, least_entropy, most_repeats):
    """By bisection in plain Python: exponent, weights and repeats."""
    used = {k: v for k, v in tokens.items() if v}
    total = sum(used.values())

    def at(a):
        power = {k: (v / total) ** a for k, v in used.items()}
        z = sum(power.values())
        return {k: x / z for k, x in power.items()}

    def entropy(a):
        return -sum(x * math.log(x) for x in at(a).values())

    low, high = 0.0, 1.0
    if entropy(1.0) >= least_entropy * math.log(len(used)):
        low = 1.0
    for _ in range(60 if low < 1 else 0):
        middle = (low + high) / 2
        low, high = (middle, high) if entropy(middle) >= least_entropy * math.log(len(used)) else (low, middle)
    spread = max(used.values()) / min(used.values())
    floor = 1 - math.log(most_repeats) / math.log(spread) if spread > 1 else 0.0
    chosen = max(low, floor, 0.0)
    shares = at(chosen)
    budget = max(used[k] / shares[k] for k in used)
    return chosen, shares, {k: shares[k] * budget / used[k] for k in used}


def sample(n=400):
    chance = random.Random(11)
    rows = []
    for i in range(n):
        source = chance.choices(["a", "b", "c", None], [60, 25, 10, 5])[0]
        rows.append((i, " ".join("w" for _ in range(chance.randrange(1, 60))), source))
    return rows


@pytest.mark.parametrize("least_entropy,most_repeats", [(0.9, 100.0), (1.0, 3.0), (0.1, 2.0)])
def test_weights_against_plain_bisection(make_documents, least_entropy, most_repeats):
    rows = sample()
    tokens = {}
    for _, text, source in rows:
        tokens[source] = tokens.get(source, 0) + len(text.split())
    chosen, shares, repeats = plain_weights(tokens, least_entropy, most_repeats)
    got = {r["source"]: r for r in mixing.weights(make_documents(*rows), least_entropy, most_repeats).collect()}
    for source, share in shares.items():
        assert got[source]["weight"] == pytest.approx(share, rel=1e-6)
        assert got[source]["repeats"] == pytest.approx(repeats[source], rel=1e-6)
    assert max(repeats.values()) <= max(most_repeats, 1) + 1e-6 or chosen > 0


def test_mix_meets_the_weights(make_documents):
    rows = sample(3000)
    readings = mixing.mix(make_documents(*rows), 1.0, 3.0, block_tokens=2000).collect()
    read, repeats = {}, {}
    for r in readings:
        read[r["source"]] = read.get(r["source"], 0) + r["tokens"]
        repeats[r["source"]] = (r["weight"], r["repeats"])
    total = sum(read.values())
    for source, (weight, _) in repeats.items():
        assert read[source] / total == pytest.approx(weight, abs=0.01)
    # every document is read, at most once more than its source's whole repeats
    times = {}
    for r in readings:
        times.setdefault(r["doc_id"], []).append(r["reading"])
    assert set(times) == {x[0] for x in rows}
    for doc, _, source in rows:
        whole = math.floor(repeats[source][1])
        assert sorted(times[doc]) in ([*range(whole)], [*range(whole + 1)])
    # any long stretch of the mix is near the weights
    ordered = sorted(readings, key=lambda r: r["mix_key"])
    assert all(0 <= r["mix_key"] < 1 for r in ordered)
    half = ordered[: len(ordered) // 2]
    first = sum(r["tokens"] for r in half if r["source"] == "b") / sum(r["tokens"] for r in half)
    assert first == pytest.approx(repeats["b"][0], abs=0.06)


def test_documents_are_repeated_whole(make_documents):
    rows = sample(300)
    df = make_documents(*rows)
    counts = {}
    for r in mixing.mix(df, 1.0, 2.5).collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    got = {}
    for r in mixing.mixed_documents(df, 1.0, 2.5).collect():
        assert r["text"] == rows[r["doc_id"]][1] and r["kept"] == "x"
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == counts and max(got.values()) > 1


def test_odd_rows(make_documents):
    df = make_documents((1, None, "a"), (2, "", "b"), (3, "x y", None), (3, "x y", None), (None, "z", "a"))
    assert sorted(str(r["doc_id"]) for r in mixing.mix(df).collect() if not r["reading"]) == ["1", "2", "3", "3", "None"]
    assert sorted({str(r["doc_id"]) for r in mixing.mixed_documents(df).collect()}) == ["1", "2", "3", "None"]
    assert mixing.mix(df.limit(0)).collect() == []
    assert mixing.mix(make_documents((1, "", "a"))).collect()[0]["weight"] == 0.0
    assert brute.FOLDER


def test_a_source_of_empty_texts_is_many_blocks(make_documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCUMENTS", 50)
    df = make_documents(*((i, "" if i % 100 else "some words") for i in range(1000)))
    found = mixing.mix(df).groupBy("block").count().collect()
    assert len(found) == 20
    assert sum(r["count"] for r in found) == 1000


def test_columns_of_any_name(spark):
    rows = [(i, f"text {i} of some words", f"s{i % 2}", "mine", "mine", "mine") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _reading string, tag string, row string")
    found = mixing.mixed_documents(df)
    assert found.columns == df.columns
    mixed = found.collect()
    assert {r["doc_id"] for r in mixed} == set(range(20))
    assert all(r["_reading"] == r["tag"] == r["row"] == "mine" for r in mixed)
