from __future__ import annotations

import random
import time

import pytest

from cartlens.llm import licenses
from tests.llm import brute


def base(df):
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
    return {r["doc_id"]: tuple(r[x] for x in names) for r in licenses.scan(df).collect()}


def expected_base(text):
    words, places, found = brute.phrases(text or "")
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(found))


def expected_templates(text, templates, least):
    out = []
    for number, line in enumerate((text or "").split("\n")):
        held = set(brute.phrases(line)[0])
        for label, template in templates:
            wanted = set(brute.phrases(template)[0])
            if len(wanted & held) >= least * len(wanted) - 1e-9:
                out.append((number, label, len(wanted & held) / len(wanted)))
    return sorted(out)


def expected_windows(text, templates, least):
    """Runs of a template's length that contain it; those that overlap are one."""
    words = brute.phrases(text or "")[0]
    out = []
    for label, template in templates:
        tokens = brute.phrases(template)[0]
        wanted, length = set(tokens), len(tokens)
        runs = []
        for i in range(max(1, len(words) - length + 1)):
            places = [j for j in range(i, min(i + length, len(words))) if words[j] in wanted]
            share = len({words[j] for j in places}) / len(wanted)
            if share >= least - 1e-9:
                runs.append((places[0], places[-1] + 1, share))
        merged = []
        for a, b, share in sorted(runs):
            if merged and a < merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]), max(share, merged[-1][2]))
            else:
                merged.append((a, b, share))
        out += [(a, b, label, share) for a, b, share in merged]
    return sorted(out)


def windows_of(row):
    return sorted((x["first"], x["end"], x["label"], x["share"]) for x in row["windows"])


@pytest.mark.parametrize("least", [0.5, 0.8, 1.0])
def test_windows_against_all_runs(make_documents, least):
    chance = random.Random(10)
    pool = [f"t{i}" for i in range(12)]
    templates = [(f"l{i}", " ".join(chance.choices(pool, k=chance.randrange(1, 9)))) for i in range(10)]
    rows = [(i, " ".join(chance.choice([*pool, "x", "y", "z"]) for _ in range(chance.randrange(60)))) for i in range(60)]
    for r in licenses.scan(make_documents(*rows), templates=templates, least=least).collect():
        got, wanted = windows_of(r), expected_windows(dict(rows)[r["doc_id"]], templates, least)
        # the best share of overlapping runs, and the same labels and places
        assert got == wanted


def wrapped(text, width):
    lines, line = [], ""
    for word in text.split():
        if len(line) + len(word) >= width:
            lines.append(line)
            line = ""
        line += word + " "
    return "\n * ".join([*lines, line])


def test_wrapped_notices_and_long_lines(make_documents):
    texts = {label: text for label, text in licenses.TEMPLATES}
    prose = " ".join(f"w{i}" for i in range(300))
    rows = [
        (1, f"{prose}\n{wrapped(texts['mit-text'], 76)}\n{prose}"),
        (2, wrapped(texts["bsd-text"], 60)),
        (3, wrapped(texts["gpl-text"], 20)),
        (4, f"{prose} {texts['isc-text']} {prose}"),
        (5, prose),
    ]
    found = {r["doc_id"]: set(r["labels"].split(",")) for r in licenses.scan(make_documents(*rows)).collect()}
    assert "mit-text" in found[1] and "bsd-text" in found[2] and {"gpl-text", "gpl"} <= found[3]
    assert "isc-text" in found[4] and found[5] == {""}


def test_given_documents(documents, texts):
    assert base(documents) == {k: expected_base(v) for k, v in texts.items()}


ROWS = [
    (1, None),
    (2, ""),
    (3, "MIT License mit license MIT-LICENSE cc by cc by"),
    (4, "the apache license\nApache\tLicense, gnu general public license"),
    (5, "élicense mit_license ÀMIT license x\x00apache\x7flicense"),
    (6, "word " * 50_000 + "cc by"),
    (6, "CC BY"),
    (None, "cc-by"),
]


def test_odd_texts(make_documents):
    found = licenses.scan(make_documents(*ROWS)).collect()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
    got = sorted((str(r["doc_id"]), *(str(r[x]) for x in names)) for r in found)
    assert got == sorted((str(k), *map(str, expected_base(v))) for k, v in ROWS)


@pytest.mark.parametrize("least", [0.5, 0.8, 1.0])
def test_templates_against_all_pairs(make_documents, least):
    chance = random.Random(9)
    pool = [f"t{i}" for i in range(12)]
    templates = [(f"l{i}", " ".join(chance.sample(pool, chance.randrange(1, 8)))) for i in range(10)]
    rows = []
    for i in range(80):
        lines = [" ".join(chance.choice([*pool, "x", "y"]) for _ in range(chance.randrange(12))) for _ in range(4)]
        rows.append((i, "\n".join(lines)))
    found = licenses.scan(make_documents(*rows), templates=templates, least=least).collect()
    for r in found:
        got = sorted((b["line"], b["label"], b["share"]) for b in r["blocks"])
        expected = expected_templates(dict(rows)[r["doc_id"]], templates, least)
        assert got == expected
        windows = expected_windows(dict(rows)[r["doc_id"]], templates, least)
        assert r["score"] == max([x[2] for x in expected] + [x[3] for x in windows], default=0.0)


def test_templates_of_given_documents(documents, texts):
    for r in licenses.scan(documents).collect():
        got = sorted((b["line"], b["label"], b["share"]) for b in r["blocks"])
        assert got == expected_templates(texts[r["doc_id"]], licenses.TEMPLATES, licenses.LEAST)
        runs = windows_of(r)
        assert runs == expected_windows(texts[r["doc_id"]], licenses.TEMPLATES, licenses.LEAST)
        labels = {x[1] for x in got} | {x[2] for x in runs} | brute.phrases(texts[r["doc_id"]])[2]
        assert r["labels"] == ",".join(sorted(labels))


def test_empty_table_and_no_templates(make_documents):
    df = make_documents((1, "mit license"))
    assert licenses.scan(df.limit(0)).collect() == []
    assert licenses.scan(df, templates=[]).first()["labels"] == "mit"
    with pytest.raises(ValueError):
        licenses.scan(df, templates=[("a", "...")])


def test_many_places_take_linear_time(make_documents):
    began = time.monotonic()
    row = licenses.scan(make_documents((1, "the mit license " * 100_000))).first()
    assert time.monotonic() - began < 30
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (300_000, 100_000, 1, 299_998)
