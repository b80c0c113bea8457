"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import xxhash

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(docs: dict[int, bytes], length: int) -> dict[int, tuple]:
    """Removed bytes by marking every string that was seen before."""
    seen, out = set(), {}
    for doc in sorted(docs):
        text = docs[doc]
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            string = text[i : i + length]
            if string in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(string)
        spans = [x.span() for x in re.finditer(b"\x01+", gone)]
        kept = bytes(x for x, removed in zip(text, gone, strict=True) if not removed)
        out[doc] = (len(text), len(text) - len(kept), spans, kept)
    return out


def quality(text: str) -> tuple:
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count: dict[tuple, int] = {}
    for x in windows:
        count[x] = count.get(x, 0) + 1
    covered = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(x in "#*$%&|<>" for x in text),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def normal_line(line: str) -> str:
    return " ".join(WORD.findall(line.lower()))


def boilerplate(rows: list[tuple], most: int) -> dict[tuple, int]:
    """(source, line) -> distinct texts, of (doc_id, text, source) rows, where more than most."""
    held: dict[tuple, set] = {}
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if normal_line(line):
                held.setdefault((source, normal_line(line)), set()).add(text)
    return {x: len(texts) for x, texts in held.items() if len(texts) > most}


def fingerprint(text: str) -> int:
    words = [x.encode() for x in WORD.findall(re.sub("[A-Z]", lambda x: x.group().lower(), text))]
    parts = [words[i : i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(x), 42) for x in parts]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def components(marks: dict[int, int], radius: int) -> dict[int, int]:
    """Smallest id reachable over pairs of marks at most radius bits apart."""
    top = {x: x for x in marks}

    def root(x: int) -> int:
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(marks)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (marks[a] ^ marks[b]).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {x: root(x) for x in ids}


def phrases(text: str) -> tuple:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda x: x.group().lower(), text))
    labels = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    places, found = [], set()
    for phrase, label in labels.items():
        own = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(own)] == own:
                places.append(i)
                found.add(label)
    return words, places, found


def personal(text: str) -> list[tuple[str, int, int]]:
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for order, (kind, pattern) in enumerate(kinds.items()):
        for x in re.finditer(pattern, text):
            digits = [int(c) for c in x.group() if c.isdigit()]
            doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in x.group().split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((x.start(), order, x.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
