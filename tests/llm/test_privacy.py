from __future__ import annotations

import math
import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from cartlens.llm import privacy
from cartlens.llm.queries import QUERIES
from tests.llm import brute


@settings(max_examples=400, deadline=None)
@given(st.text("aZ1@.-+ ()%é\n0459", max_size=60))
def test_values_against_patterns(text):
    assert privacy.base_spans(text) == brute.personal(text)


def test_given_documents(spark, texts):
    kinds = ["email", "ip", "card", "phone"]
    for r in QUERIES["op4_pii"](spark, brute.FOLDER).collect():
        spans = brute.personal(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in kinds] == [sum(x[0] == k for x in spans) for k in kinds]
        shown = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert r["base_sha256"] == brute.sha(",".join(shown))
        given_spans = r["spans"].split(",") if r["spans"] else []
        assert [x for x in given_spans if not x.startswith("term:")] == shown
        starts = [int(x.split(":")[1]) for x in given_spans]
        assert starts == sorted(starts)
        assert shown or not given_spans  # clean documents are left alone


ROWS = [
    *((i, f"please write to agent seven {'ann@mail.com' if i < 3 else 'nobody'} or call", "s") for i in range(12)),
    (20, "codename falcon ann@mail.com is here"),
    (21, "codename falcon ANN@mail.com is here"),
    (22, "all the falcon and the please"),
    (23, None),
    (24, ""),
    (25, "x" * 70_000 + " 10.0.0.1 " + "y" * 70_000),
    (None, "bob@b.org"),
]


def expected_disclosures(rows, near, support):
    total = len(rows)
    of_term, of_entity, both = {}, {}, {}
    for _, text, *_ in rows:
        text = text or ""
        for t in {x.lower() for x in privacy._TERM.findall(text)}:
            of_term[t] = of_term.get(t, 0) + 1
        entities, pairs = set(), set()
        for kind, a, b in brute.personal(text):
            entity = f"{kind}:{text[a:b].lower()}"
            entities.add(entity)
            line = text[: text.find("\n", b)] if "\n" in text[b:] else text
            begin = text.rfind("\n", 0, a) + 1
            words = [x.span() for x in privacy._TERM.finditer(line, begin)]
            left = [x for x in words if x[1] <= a][-near:]
            right = [x for x in words if x[0] >= b][:near]
            pairs |= {(entity, text[x:y].lower()) for x, y in left + right}
        for x in entities:
            of_entity[x] = of_entity.get(x, 0) + 1
        for x in pairs:
            both[x] = both.get(x, 0) + 1
    out = {}
    for (e, t), n in both.items():
        if n >= support:
            information = math.log(total / of_entity[e])
            out[e, t] = math.log(n * total / of_entity[e] / of_term[t]) / information if information > 0 else 0.0
    return out


def test_disclosure_from_the_corpus(make_documents):
    df = make_documents(*ROWS)
    texts = df.selectExpr("doc_id", "coalesce(text, '') text")
    scanned = texts.mapInArrow(privacy._scanned(3), privacy.FOUND)
    found = {(r["entity"], r["term"]): r["disclosed"] for r in privacy.disclosures(scanned, 2).collect()}
    expected = expected_disclosures(ROWS, 3, 2)
    assert set(found) == set(expected) and ("email:ann@mail.com", "falcon") in found
    assert all(math.isclose(found[x], expected[x], abs_tol=1e-9) for x in found)


def test_redaction(make_documents):
    df = make_documents(*ROWS)
    options = {"near": 3, "generalise": 0.4, "remove": 0.8}
    by_id = {r["doc_id"]: r["text"] for r in privacy.sanitise(df, **options).collect()}
    assert by_id[20] == " [TERM] [EMAIL]  " and by_id[22] == ROWS[14][1]
    assert by_id[None] == "[EMAIL]" and by_id[24] == "" and by_id[23] == ""
    assert "[IP]" in by_id[25] and len(by_id[25]) == 140_006
    assert privacy.sanitise(df).columns == df.columns


def test_near_terms_of_long_lines():
    chance = random.Random(10)
    for _ in range(50):
        words = ["w" * chance.choice([1, 3, 90, 200]) for _ in range(30)]
        at = chance.randrange(30)
        text = " ".join([*words[:at], "a@b.cd", *words[at:]])
        found = sorted({x[2:] for x in privacy.near_terms(text, privacy.base_spans(text), 8)})
        spans = [x.span() for x in privacy._TERM.finditer(text)]
        mail = text.index("a@b.cd")
        expected = [x for x in spans if x[1] <= mail][-8:] + [x for x in spans if x[0] >= mail + 6][:8]
        assert found == sorted(expected)


def test_empty_table(make_documents):
    assert privacy.find(make_documents((1, "a")).limit(0)).collect() == []


def test_long_runs_of_digits_take_linear_time():
    text = "1" * 300_000 + " " + "0" * 6_000 + "1.2.3.4 " + "1." * 50_000
    began = time.monotonic()
    spans = privacy.base_spans(text)
    assert time.monotonic() - began < 5
    assert [x for x in spans if x[0] == "ip"][0] == ("ip", 300_001, 306_008)


def expected_places(rows, support, generalise, remove):
    """Places of telling terms, with every entity and term of a document counted as a pair."""
    texts = [x[1] or "" for x in rows]
    terms = [{x.lower() for x in privacy._TERM.findall(t)} for t in texts]
    values = [brute.personal(t) for t in texts]
    entities = [{f"{k}:{t[a:b].lower()}" for k, a, b in v} for t, v in zip(texts, values, strict=True)]
    out = []
    for text, spans, own in zip(texts, values, entities, strict=True):
        places = []
        for x in privacy._TERM.finditer(text):
            most = -math.inf
            for e in own:
                of_entity, of_term = sum(e in y for y in entities), sum(x.group().lower() in y for y in terms)
                both = sum(e in y and x.group().lower() in z for y, z in zip(entities, terms, strict=True))
                information = math.log(len(rows) / of_entity)
                share = math.log(both * len(rows) / of_entity / of_term) / information if information > 0 else 0.0
                most = max(most, share if both >= support else -math.inf)
            if most >= generalise and not any(x.start() < b and a < x.end() for _, a, b in spans):
                places.append((x.start(), x.end(), most >= remove))
        out.append(places)
    return out


def test_terms_anywhere_in_the_document(make_documents):
    chance = random.Random(11)
    far = "filler " * 30
    rows = [
        (1, f"codename falcon\n{far}\nwrite to ann@mail.com {far} FALCON"),
        (2, f"ann@mail.com\n{far}\nof the falcon and 10.0.0.1"),
        (3, f"10.0.0.1 {far}\nANN@mail.com falcons nest ΟΣ'Ο"),
        (4, f"{far}10.0.0.1 alone"),
        (5, None),
        *((i, " ".join(f"w{chance.choice('abcdefghij')}x" for _ in range(12)) + " 10.0.0.1" * (i % 5 == 0)) for i in range(6, 40)),
        (50, "bob@b.org"),
    ]
    for generalise, remove in [(0.8, 0.95), (0.3, 0.6), (-1.0, 0.5)]:
        found = privacy.find(make_documents(*rows), generalise=generalise, remove=remove).collect()
        got = {r["doc_id"]: [(x["start"], x["end"], x["remove"]) for x in r["terms"]] for r in found}
        expected = expected_places(rows, 2, generalise, remove)
        assert got == {k: x for (k, _), x in zip(rows, expected, strict=True)}
    falcon = {r["doc_id"]: r["text"] for r in privacy.sanitise(make_documents(*rows)).collect()}
    assert "falcon" not in falcon[1].lower() and "falcon" not in falcon[2] and "falcons" in falcon[3]


def test_rows_that_share_ids_or_have_none(spark):
    rows = [(None, "a@b.cc quagga"), (None, "a@b.cc ordinary words here"), (1, "a@b.cc x"), (1, "a@b.cc"), (1, "a@b.cc"), (2, None)]
    schema = "doc_id long, text string, _text string, _doc string, _digest string, row string, found int, base int"
    df = spark.createDataFrame([(*r, "mine", "mine", "mine", "mine", 3, 4) for r in rows], schema)
    found = privacy.sanitise(df).collect()
    assert sorted(r["text"] for r in found) == sorted(
        ["[EMAIL] quagga", "[EMAIL] ordinary words here", "[EMAIL] x", "[EMAIL]", "[EMAIL]", ""]
    )
    assert all(r["_text"] == r["_doc"] == r["_digest"] == r["row"] == "mine" and (r["found"], r["base"]) == (3, 4) for r in found)


def test_digests_of_sanitised_texts(make_documents):
    rows = [(1, "call a@b.cc now"), (2, "nothing here"), (3, None), (4, "")]
    df = make_documents(*rows)
    texts = {r["doc_id"]: r["text"] for r in privacy.sanitise(df).collect()}
    found = {r["doc_id"]: r["sanitised_sha256"] for r in privacy.find(df).collect()}
    assert found == {k: brute.sha(v) for k, v in texts.items()} and texts[1] == "call [EMAIL] now"
