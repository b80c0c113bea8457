"""License scans: phrases, and an exact set-similarity join of text blocks with templates.

Blocks are the lines of a text, and all runs of as many words as a template has, across lines, so
that a notice is found however it is wrapped. Tokens are ordered by their frequency in the corpus,
rare ones first. A block contains a template if it holds at least ``least`` of the template's
distinct tokens. It can only do so if it holds one of the template's rarest tokens (prefix
filter), if it has enough tokens (length filter), and if from its first shared token on enough
tokens are left on both sides (position filter). Blocks that pass are verified by counting: lines on
their own, runs by sliding over the places of the template's tokens near those of its prefix. The
prefixes are looked up in every text, so no block is missed.

The templates are a parameter of at most ``MOST_TEMPLATES``; each task holds them.

Cases: a null text is empty; an empty list of templates adds no labels; a template without
tokens is refused; ties in frequency are ordered by the token; repeated rows get equal
results. Only doc_id and text are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import text_of

# Phrases with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Label, template: sentences by which works state their license.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache-text", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
]
#: Share of a template's tokens that a line must hold.
LEAST = 0.8
MOST_TEMPLATES = 10_000

#: Everything but digits, letters and bytes beyond ASCII separates words.
_WORDS = bytes(x if x >= 0x80 or chr(x).isalnum() else 0x20 for x in range(256))


def words_of(text: bytes) -> bytes:
    """The words, lower-cased, each followed by a single space."""
    return b" ".join([*text.lower().translate(_WORDS).split(), b""])


def token_frequency(documents: DataFrame, tokens: set[str]) -> dict[str, int]:
    """The number of documents that hold each of ``tokens``, counted over all documents."""
    wanted = {x.encode() for x in tokens}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = dict.fromkeys(wanted, 0)
        for batch in batches:
            for text in batch.column(0):
                for token in wanted.intersection(words_of(text.as_py()).split()):
                    counts[token] += 1
        columns = [pa.array([x.decode() for x in counts]), pa.array(counts.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["token", "n"])

    if not wanted:
        return {}
    texts = documents.select(text_of(documents).cast("binary").alias("text"))
    counted = texts.mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return dict.fromkeys(tokens, 0) | {x["token"]: x["n"] for x in counted.collect()}  # as many as tokens


class Templates:
    """Templates as ranks of their tokens, with an index of their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[str, int], least: float):
        rarest_first = sorted(frequency, key=lambda x: (frequency[x], x))
        self.rank = {x.encode(): i for i, x in enumerate(rarest_first)}
        self.labels = [label for label, _ in templates]
        self.sets = [sorted({self.rank[x] for x in words_of(text.encode()).split()}) for _, text in templates]
        self.needs = [max(1, math.ceil(least * len(x) - 1e-9)) for x in self.sets]
        #: rank of a token -> (template, place in it) where the token is in the template's prefix
        self.index: dict[int, list[tuple[int, int]]] = {}
        for t, (ranks, need) in enumerate(zip(self.sets, self.needs, strict=True)):
            for place, rank in enumerate(ranks[: len(ranks) - need + 1]):
                self.index.setdefault(rank, []).append((t, place))
        self.rare = {x for x, rank in self.rank.items() if rank in self.index}
        self.lengths = [len(words_of(text.encode()).split()) for _, text in templates]
        self.members = [set(x) for x in self.sets]

    def contained(self, line: set[bytes]) -> dict[int, float]:
        """Templates contained in a line of distinct words, with the share of their tokens."""
        ranks = sorted(self.rank[x] for x in line if x in self.rank)
        found: dict[int, float] = {}
        seen = set()
        for place, rank in enumerate(ranks):
            for t, at in self.index.get(rank, ()):
                if t in seen:
                    continue
                seen.add(t)
                need, tokens = self.needs[t], self.sets[t]
                if len(line) < need or min(len(ranks) - place, len(tokens) - at) < need:
                    continue
                shared = len(set(ranks).intersection(tokens))
                if shared >= need:
                    found[t] = shared / len(tokens)
        return found


    def windows(self, words: list[bytes]) -> list[tuple[int, int, int, float]]:
        """(template, first word, end, share) where runs of a template's length contain it.

        Runs that overlap are one block, with the largest share of any of them.
        """
        ranked = [(i, self.rank[x]) for i, x in enumerate(words) if x in self.rank]
        found = []
        for t in sorted({t for _, rank in ranked for t, _ in self.index.get(rank, ())}):
            places = [(i, rank) for i, rank in ranked if rank in self.members[t]]
            found += self._runs(t, places)
        return found

    def _runs(self, t: int, places: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, float]]:
        length, need = self.lengths[t], self.needs[t]
        if len(places) < need:
            return
        held: dict[int, int] = {}
        low, block = 0, None
        for place, rank in places:
            held[rank] = held.get(rank, 0) + 1
            while places[low][0] <= place - length:
                own = places[low][1]
                held[own] -= 1
                if not held[own]:
                    del held[own]
                low += 1
            if len(held) < need:
                continue
            share = len(held) / len(self.sets[t])
            if block and places[low][0] < block[2]:
                block = (t, block[1], place + 1, max(block[3], share))
                continue
            if block:
                yield block
            block = (t, places[low][0], place + 1, share)
        if block:
            yield block


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long,"
    " base_labels string, labels string, score double,"
    " blocks array<struct<line: int, label: string, share: double>>,"
    " windows array<struct<first: long, end: long, label: string, share: double>>"
)


def scan(
    documents: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    least: float = LEAST,
) -> DataFrame:
    """Phrases and templates per document.

    Columns: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the
    largest share of a template), blocks (line number from 0, label, share), windows (first word from 0,
    end, label, share).
    """
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"at most {MOST_TEMPLATES} templates")
    tokens = [{x.decode() for x in words_of(text.encode()).split()} for _, text in templates]
    if not all(tokens):
        raise ValueError("a template has no tokens")
    index = Templates(templates, token_frequency(documents, set().union(*tokens)), least)
    # a look-ahead, as places may share the space between them
    marks = [
        (b" " + x.encode() + b" ", re.compile(b"(?= " + re.escape(x.encode()) + b" )"), label)
        for x, label in phrases.items()
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = raw.as_py()
                words = b" " + words_of(text)
                split = words.split()
                places, labels = [], set()
                for mark, pattern, label in marks:
                    if mark in words:
                        at = before = 0
                        for x in pattern.finditer(words):
                            before += words.count(b" ", at, x.start())
                            at = x.start()
                            places.append(before)
                        labels.add(label)
                blocks, windows = [], []
                if not index.rare.isdisjoint(split):
                    for number, line in enumerate(text.split(b"\n")):
                        held = index.contained(set(words_of(line).split()))
                        blocks += [(number, index.labels[t], share) for t, share in sorted(held.items())]
                    windows = [(a, b, index.labels[t], share) for t, a, b, share in index.windows(split)]
                every = labels.union((x[1] for x in blocks), (x[2] for x in windows))
                rows.append(
                    (
                        doc,
                        len(split),
                        len(places),
                        min(places, default=None),
                        max(places, default=None),
                        ",".join(sorted(labels)),
                        ",".join(sorted(every)),
                        max([x[2] for x in blocks] + [x[3] for x in windows], default=0.0),
                        [{"line": a, "label": b, "share": c} for a, b, c in blocks],
                        [{"first": a, "end": b, "label": c, "share": d} for a, b, c, d in windows],
                    )
                )
            if rows:
                block = pa.struct([("line", pa.int32()), ("label", pa.string()), ("share", pa.float64())])
                window = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("share", pa.float64())])
                kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(block), pa.list_(window)]
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks", "windows"]
                yield pa.RecordBatch.from_arrays(columns, names)

    texts = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"), text_of(documents).cast("binary").alias("text")
    )
    return texts.mapInArrow(run, SCHEMA)
