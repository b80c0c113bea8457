from __future__ import annotations

import random

from cartlens.llm import quality
from tests.llm import brute

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def counts(df, **options):
    return {r["doc_id"]: tuple(r[x] for x in COUNTS) for r in quality.judge(df, **options).collect()}


def test_given_documents(documents, texts):
    assert counts(documents) == {k: brute.quality(v) for k, v in texts.items()}


def test_odd_texts(make_documents):
    chance = random.Random(4)
    rows = [
        (i, " ".join(chance.choice(["a", "b", "c\n", "\t", "é#", "\x0b"]) for _ in range(chance.randrange(80))))
        for i in range(40)
    ]
    rows += [(100, None), (101, ""), (102, " \n\n "), (103, "x " * 3000), (104, "\x1f a\xa0b a")]
    expected = {k: brute.quality(v or "") for k, v in rows}
    assert counts(make_documents(*rows)) == expected


def expected_verdicts(rows, most, share):
    lines = brute.boilerplate(rows, most)
    out = {}
    for doc, text, source in rows:
        text = text or ""
        n_words, *_, failed = brute.quality(text)
        gone = [x for x in text.split("\n") if (source, brute.normal_line(x)) in lines]
        removed = sum(len(brute.WORD.findall(x)) for x in gone)
        rest = "\n".join(x for x in text.split("\n") if (source, brute.normal_line(x)) not in lines)
        out[doc] = (removed, not failed and n_words - removed >= share * n_words, rest)
    return out


def sample():
    chance = random.Random(5)
    rows = []
    for i in range(60):
        own = " ".join(f"w{chance.randrange(500)}" for _ in range(chance.choice([4, 30])))
        menu = "Home | About  us" if i % 2 else " home |  about US"
        rows.append((i, f"{menu}\n{own}\n{menu}", f"s{i % 2 if i < 50 else None}"))
    rows += [(90, rows[0][1], "s0"), (91, rows[0][1], "s0"), (92, None, None), (93, "menu", None)]
    return rows


def test_lines_of_many_documents(make_documents):
    rows = sample()
    expected = expected_verdicts(rows, 20, 0.6)
    df = make_documents(*rows)
    found = {r["doc_id"]: (r["n_removed_words"], r["kept"]) for r in quality.judge(df, 0.0, 20, 0.6).collect()}
    assert found == {k: x[:2] for k, x in expected.items()}
    assert {x[1] for x in expected.values()} == {True, False}
    cleaned = {r["doc_id"]: r for r in quality.clean(df, 0.0, 20, 0.6).collect()}
    assert {k: r["text"] for k, r in cleaned.items()} == {k: x[2] for k, x in expected.items() if x[1]}
    assert all(r["n_chars"] == len(r["text"]) and r["kept"] == "x" and r["count"] == 7 for r in cleaned.values())


def test_repeated_rows_and_missing_ids(make_documents):
    rows = sample()
    df = make_documents(*rows, *rows[:4], (None, "a b " * 20, "s0"), (0, "other words " * 2, "s0"))
    found = quality.judge(df, 0.0, 20, 0.6).collect()
    assert len(found) == len(rows) + 6
    expected = expected_verdicts(rows, 20, 0.6)
    assert all(
        {(r["n_removed_words"], r["kept"]) for r in found if r["doc_id"] == k} == {expected[k][:2]} for k in (1, 2, 3)
    )


def test_copies_are_no_boilerplate(make_documents):
    text = "one line of a text that many share as a whole and nobody else"
    df = make_documents(*((i, text) for i in range(30)))
    assert all(r["kept"] for r in quality.judge(df, 0.0, 5).collect())


def test_empty_table(make_documents):
    empty = make_documents((1, "a")).limit(0)
    assert quality.judge(empty).collect() == []
    assert quality.clean(empty).columns == empty.columns


def test_small_hosts_with_the_given_limits(make_documents):
    """A line of all texts of a host goes, however few; one that a smaller share holds stays."""
    chance = random.Random(8)
    rows = []
    for host, size, menus in [("small", 12, 12), ("tenth", 200, 20), ("few", 200, 14), ("tiny", 9, 9), (None, 30, 30)]:
        for i in range(size):
            own = " ".join(f"w{chance.randrange(10**6)}" for _ in range(30))
            rows.append((len(rows), f"{'Home | about us' if i < menus else own[:9]}\n{own}", host))
    found = {r["doc_id"]: r["n_removed_words"] for r in quality.judge(make_documents(*rows)).collect()}
    expected = {k: 4 * (x.startswith("Home") and host in ("small", "tenth", None)) for k, x, host in rows}
    assert found == expected and set(expected.values()) == {0, 4}
    cleaned = {r["doc_id"]: r["text"] for r in quality.clean(make_documents(*rows)).collect()}
    assert cleaned == {k: x.split("\n")[1] if expected[k] else x for k, x, _ in rows}
