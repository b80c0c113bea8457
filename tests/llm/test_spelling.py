"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from cartlens.llm import spelling
from tests.llm import brute

NAMES = ["word", "form", "root", "n", "n_near", "form_n"]


def plain_words(rows) -> dict[str, int]:
    count: Counter[str] = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda x: x.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def is_near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(words: dict[str, int]) -> set[tuple]:
    by_length: dict[int, list[str]] = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    form, near = {}, {}
    for w, n in words.items():
        close = [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, []) if is_near(w, x)]
        near[w] = len(close)
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], near[w], words[form[w]] if form[w] else None))
    return out


def found(df) -> list[tuple]:
    return [tuple(r[n] for n in NAMES) for r in df.collect()]


@pytest.mark.parametrize("ranges", [50_000, 7])
def test_random_words(spark, make_documents, monkeypatch, ranges):
    monkeypatch.setattr(spelling, "RANGE", ranges)
    rng = random.Random(ranges)
    words = ["".join(rng.choices("aabé", k=rng.randint(6, 10))) for _ in range(250)]
    weights = [rng.choice([1, 1, 3, 40, 400]) for _ in words]
    rows = [(d, " ".join(rng.choices(words, weights, k=300))) for d in range(60)]
    result = found(spelling.variants(make_documents(*rows)))
    wanted = expected(plain_words(rows))
    assert len(result) == len(wanted) and set(result) == wanted
    assert any(r[1] for r in wanted)


def test_chains_of_forms(spark, make_documents):
    # each ten times as frequent as the one before, one letter apart
    chain = ["zabcdefg", "zabcdefgh", "zabcdefghi", "zabcdefghij"]
    texts = [(d, " ".join(w for k, w in enumerate(chain) for _ in range(2 * 12**k)) + " ") for d in range(3)]
    result = set(found(spelling.variants(make_documents(*texts))))
    wanted = expected(plain_words(texts))
    assert result == wanted
    assert {r[2] for r in wanted if r[0] in chain} == {chain[-1]}


def test_missing_long_and_repeated(spark, make_documents):
    long = "Ab" * 40_000
    rows = [
        (None, "missing words missing words"),
        (None, "missinx words"),
        (1, None),
        (1, ""),
        (2, f"{long} {long} {long}x {long}x"),
        (3, "ÉCOLIERS écoliers Écoliers cafés×teria cafés×teria"),
        (3, "ÉCOLIERS écoliers Écoliers cafés×teria cafés×teria"),
        (4, "under_score123word underscores\U0001f600underscores Āunderscores"),
    ]
    assert set(found(spelling.variants(make_documents(*rows)))) == expected(plain_words(rows))


def test_no_words(spark, make_documents):
    df = make_documents((1, "short words"), (2, "alone standing"))
    assert found(spelling.variants(df)) == [] == found(spelling.variants(df.limit(0)))


def test_one_word_of_a_third_of_all(spark, make_documents):
    rows = [(d, "frequent " * 500 + f"frequen{chr(97 + d % 26)} other{d % 7}words") for d in range(80)]
    assert set(found(spelling.variants(make_documents(*rows)))) == expected(plain_words(rows))


def test_given_documents(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert brute.FOLDER.endswith("sf0.001")
    assert set(found(spelling.variants(documents))) == expected(plain_words(rows))
