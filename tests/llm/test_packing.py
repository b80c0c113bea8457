from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartlens.llm import packing
from cartlens.llm.queries import vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def check(rows, docs, tokenizer, capacity):
    """Every id in one piece, sequences without gaps; returns the share of padding."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(docs)
    for doc, parts in pieces.items():
        ids = [*tokenizer.encode(docs[doc] or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids)
    used = padded = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        used += at
        padded += packing.padded_length(at, capacity)
    return 1 - used / padded


def test_given_documents(documents, texts, tokenizer):
    rows = packing.pack(documents, vocabulary()).collect()
    assert check(rows, texts, tokenizer, 2048) < 0.02


ODD = {
    1: None, 2: "", 3: " \n", 4: "It's <|endoftext|> a\u0301 e\u0301\u3000x \u0301y \u00a0z<|startoftext|>", 5: "ñ" * 5000,
    6: "ΑΣ ΟΔΟΣ İ ﬁ 1234 ½", 7: "a\x00b \x1f\x85 \u200b'S 'LL", 8: "word " * 9000, 9: "a\rb\x0bc\x0cd\te",
}


def test_odd_texts(make_documents, tokenizer):
    check(packing.pack(make_documents(*ODD.items()), vocabulary()).collect(), ODD, tokenizer, 2048)


def test_many_small_blocks(make_documents, tokenizer):
    chance = random.Random(15)
    docs = {i: "the cat " * chance.randrange(60) for i in range(300)}
    rows = packing.pack(make_documents(*docs.items()), vocabulary(), capacity=64, block=40).collect()
    check(rows, docs, tokenizer, 64)


def test_rows_that_repeat(make_documents):
    df = make_documents((1, "a b c"), (1, "a b c"), (None, "d"), (None, None))
    rows = packing.pack(df, vocabulary()).collect()
    assert sorted((str(r["doc_id"]), r["doc_tokens"]) for r in rows) == [("1", 4), ("1", 4), ("None", 1), ("None", 2)]
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 4
    assert packing.pack(df.limit(0), vocabulary()).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 3), min_size=1, max_size=5), st.integers(0, 40))
def test_fill_against_all_choices(counts, capacity):
    lengths = sorted(counts, reverse=True)
    best = 0
    for taken in itertools.product(*(range(counts[x] + 1) for x in lengths)):
        total = sum(x * n for x, n in zip(lengths, taken, strict=True))
        best = max(best, total if total <= capacity else 0)
    chosen = packing.best_fill(lengths, [counts[x] for x in lengths], capacity)
    assert all(0 < n <= counts[x] for x, n in chosen.items())
    assert sum(x * n for x, n in chosen.items()) == best


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(max_codepoint=0x250, exclude_categories=["Cs"]) | st.sampled_from("aé.,;' \u0301\u0130"), max_size=40))
def test_words_against_the_whole_text(text):
    tokens = packing.tokens_of(vocabulary())
    ids = tokens.tokenizer.encode(text, add_special_tokens=False).ids
    assert tokens.of(text.encode()) == np.array(ids, "<u4").tobytes()
