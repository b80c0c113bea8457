"""The prefix trie against all prefixes of all conversations."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from cartlens.llm import prefixes

SCHEMA = "conv_id long, turn int, role string, text string, parent string, depth int, n_convs string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows: list[tuple]) -> dict[int, list[tuple]]:
    convs: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            order = (turn is not None, turn or 0, role or "", text or "")
            convs.setdefault(conv, []).append((order, (role or "", text or "")))
    return {c: [x for _, x in sorted(turns)] for c, turns in convs.items()}


def mended(convs: dict[int, list[tuple]]) -> dict[int, list[tuple]]:
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + turns[h:]
    return out


def expected(convs: dict[int, list[tuple]]) -> set[tuple]:
    members: dict[tuple, list[int]] = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for node, held in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[: len(x)] == x and len(y) == len(x) + 1 for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(str(c) for c in sorted(held) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.add(
            (min(held), len(node), parent, len(held), len(children), len(leaves), saved,
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)


def found(df) -> list[tuple]:
    return [tuple(r[n] for n in NAMES) for r in df.collect()]


def random_rows(seed: int, convs: int, texts: int, longest: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 400), convs):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), "t" * rng.randint(0, texts)))
    return rows


@pytest.mark.parametrize("seed,texts,longest", [(1, 1, 11), (2, 0, 6), (3, 3, 9), (4, 1, 21)])
def test_tries(spark, seed, texts, longest):
    rows = random_rows(seed, 60, texts, longest)
    if seed == 2:  # one role and one text: chains that end at all depths
        rows = [(c, turn, "user", text) for c, turn, _, text in rows]
    convs = plain(rows)
    for df, wanted in (
        (prefixes.shared_prefixes(table(spark, rows)), expected(convs)),
        (prefixes.shared_prefixes_rebuilt(table(spark, rows)), expected(mended(convs))),
    ):
        rows_found = found(df)
        assert len(rows_found) == len(set(rows_found)) and set(rows_found) == wanted


def test_a_hot_first_turn_and_equal_conversations(spark):
    rows = [(c, turn, "user", text) for c in range(300) for turn, text in enumerate(["hello", "a", "b", "c", "d", "e"])]
    rows += [(c, turn, "user", text) for c in range(300, 340) for turn, text in enumerate(["hello", str(c), "x"])]
    assert set(found(prefixes.shared_prefixes(table(spark, rows)))) == expected(plain(rows))


def test_missing_repeated_and_long(spark):
    rows = [
        (None, 0, "user", "nobody"),
        (1, None, None, None),
        (1, 0, "user", "a" * 100_000),
        (1, 0, "user", "a" * 100_000),
        (2, None, "", ""),
        (2, 0, "user", "a" * 100_000),
        (-5, 1, "user", "1:"),
        (-6, 1, "user:", "1"),
        (7, 0, "user", "é😀"),
        *[(8, turn, "user", "same") for turn in range(500)],
        *[(9, turn, "user", "same") for turn in range(498)],
    ]
    assert set(found(prefixes.shared_prefixes(table(spark, rows)))) == expected(plain(rows))


def test_no_rows(spark):
    for build in (prefixes.shared_prefixes, prefixes.shared_prefixes_rebuilt):
        assert found(build(table(spark, []))) == []


def test_conversations_that_lose_all_turns(spark):
    # h of 11 is over its number of turns, and there is no conversation 0 to borrow from
    short = [c for c in range(1, 50) if zlib.crc32(str(c).encode()) % 6 > 1]
    rows = [(c, 0, "user", f"own {c}") for c in short]
    wanted = expected(mended(plain(rows)))
    assert len(wanted) == 1
    assert set(found(prefixes.shared_prefixes_rebuilt(table(spark, rows)))) == wanted


def test_long_lists_of_ends(spark, monkeypatch):
    rows = [(c, 0, "user", "one") for c in range(1000, 10_500)]
    assert set(found(prefixes.shared_prefixes(table(spark, rows)))) == expected(plain(rows))
