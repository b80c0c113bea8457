"""Personal data, and terms that give it away.

Patterns find the values themselves: mail and IP addresses, card and phone numbers. Terms of the
same document can reveal a value too. How strongly is estimated from the whole corpus: with p the
share of documents, a term t discloses an entity e (a kind and its value) by their pointwise
mutual information, log(p(e, t) / (p(e) p(t))), of the information log(1 / p(e)) that the entity
holds. In documents with the entity, a term that discloses at least ``remove`` of it is removed, one
that discloses at least ``generalise`` of it is replaced by a word for any term, wherever it stands
outside of values. Estimates need ``support`` documents with both, so a single meeting reveals
nothing.

One scan counts the documents of every term and entity and stores those with values. Entities of
``support`` documents meet the distinct terms of their documents; terms that stand in too few
documents for the support, or in so many that they cannot disclose ``generalise`` of the entity
even if every document with it holds them, are left out before, which changes no result. The rest
are groupings that combine before the shuffle and joins on hashed keys.

With ``near``, only terms within that many words of a value on its line are counted and marked.

Cases: a null text is empty; a null doc_id is passed through; repeated rows count as documents
and get equal results; texts without values get no spans. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import stored, text_of

# Kinds in their order, with their patterns.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
KINDS = [*PATTERNS, "term"]
SUPPORT = 2
REMOVE, GENERALISE = 0.95, 0.8
REPLACED = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
ANY_TERM = "[TERM]"

#: Bytes that belong to terms: letters, and everything beyond ASCII.
_LETTERS = bytes(x if x >= 0x80 or chr(x).isalpha() else 0x20 for x in range(256))
_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: The ip pattern from the start of a run of digits only: a match inside one would reach its start.
_IP = re.compile(r"(?<![0-9])" + PATTERNS["ip"].pattern)
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, x in enumerate(reversed(digits)):
        value = int(x) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _valid(kind: str, value: str) -> bool:
    if kind == "ip":
        parts = [x.lstrip("0") for x in value.split(".")]
        return all(len(x) <= 3 and int(x or "0") <= 255 for x in parts)
    digits = _NOT_DIGITS.sub("", value)
    if kind == "card":
        return 14 <= len(digits) <= 19 and passes_luhn(digits)
    return kind != "phone" or 10 <= len(digits) <= 15


def _mails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of the mail pattern, tried only around each ``@``."""
    pattern = PATTERNS["email"]
    name = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in name:
            start -= 1
        found = pattern.match(text, start) if start < at else None
        if found:
            yield found.span()
            end = found.end()
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind."""
    spans = [("email", *x) for x in _mails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind in ("ip", "card", "phone"):
            if kind == "phone" and "+" not in text:
                continue
            pattern = _IP if kind == "ip" else PATTERNS[kind]
            spans += [(kind, *x.span()) for x in pattern.finditer(text) if _valid(kind, x.group())]
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def near_terms(text: str, spans: list[tuple[str, int, int]], near: int) -> Iterator[tuple[str, str, int, int]]:
    """(entity, term, start, end) for the terms near each value on its line."""
    for kind, start, end in spans:
        entity = f"{kind}:{text[start:end].lower()}"
        left = text.rfind("\n", 0, start) + 1
        right = text.find("\n", end)
        right = len(text) if right < 0 else right
        # terms are looked for word by word, so a line of any length costs no more than they do
        before = list(_backwards(text, left, start, near))
        after = []
        for found in _TERM.finditer(text, end, right):
            after.append(found.span())
            if len(after) == near:
                break
        for a, b in [*before, *after]:
            if not any(a < y and x < b for _, x, y in spans):
                yield entity, text[a:b].lower(), a, b


def _backwards(text: str, left: int, end: int, count: int) -> Iterator[tuple[int, int]]:
    """The last ``count`` terms of ``text[left:end]``."""
    reach = 64
    while True:
        begin = max(left, end - reach)
        found = [x.span() for x in _TERM.finditer(text, begin, end)]
        if begin > left and found and found[0][0] == begin:
            found = found[1:]  # may have begun earlier
        if begin == left or len(found) >= count:
            return iter(found[-count:])
        reach *= 2


def terms_of(text: str) -> set[bytes]:
    """The distinct terms of a text, lower-cased one by one."""
    if "\u03a3" in text:  # the only letter whose lower case depends on what is around the term
        return {x.lower().encode() for x in _TERM.findall(text)}
    return set(text.lower().encode().translate(_LETTERS).split())


FOUND = (
    "kind string, entity string, term string, n long, doc_id long,"
    " base array<struct<kind: string, start: long, end: long>>, base_sha256 string,"
    " near array<struct<entity: string, term: string, start: long, end: long>>,"
    " entities array<string>, text string, text_sha256 string"
)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _scanned(near: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row per document with its values, and rows with the counts of each batch.

    Without ``near`` no pairs are counted; documents with values keep their text instead.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    term = pa.struct(
        [("entity", pa.string()), ("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
    )
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(span), pa.string(), pa.list_(term)]
    types += [pa.list_(pa.string()), pa.string(), pa.string()]
    names = ["kind", "entity", "term", "n", "doc_id", "base", "base_sha256", "near", "entities", "text", "text_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms: Counter[bytes] = Counter()
            entities: Counter[str] = Counter()
            pairs: Counter[tuple[str, str]] = Counter()
            docs, bases, digests, nears = batch.column(0).to_pylist(), [], [], []
            values, kept, whole = [], [], []
            for text in batch.column(1):
                text = text.as_py()
                spans = base_spans(text)
                found = set(near_terms(text, spans, near)) if spans and near is not None else ()
                found = sorted(found, key=lambda x: x[2:])
                terms.update(terms_of(text))
                values.append(sorted({f"{kind}:{text[a:b].lower()}" for kind, a, b in spans}))
                entities.update(values[-1])
                pairs.update({x[:2] for x in found})
                bases.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                digests.append(hashlib.sha256(joined(spans).encode()).hexdigest())
                nears.append([{"entity": e, "term": t, "start": a, "end": b} for e, t, a, b in found])
                kept.append(text if spans else None)
                whole.append(hashlib.sha256(text.encode()).hexdigest())
            counts = [
                ("term", [None] * len(terms), [x.decode() for x in terms], list(terms.values())),
                ("entity", list(entities), [None] * len(entities), list(entities.values())),
                ("pair", [x[0] for x in pairs], [x[1] for x in pairs], list(pairs.values())),
            ]
            none = [None] * batch.num_rows
            blocks = [(["document"] * batch.num_rows, none, none, [1] * batch.num_rows, docs, bases, digests, nears, values, kept, whole)]
            for kind, entity, word, n in counts:
                none = [None] * len(n)
                blocks.append(([kind] * len(n), entity, word, n, *[none] * 7))
            for block in blocks:
                if block[0]:
                    columns = [pa.array(x, t) for x, t in zip(block, types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _counted(scanned: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents of each entity (of_entity), of each term (of_term) and of all (total)."""
    counts = scanned.where("kind <> 'document'").select("kind", "entity", "term", "n")
    entities = counts.where("kind = 'entity'").groupBy("entity").agg(F.sum("n").alias("of_entity"))
    terms = counts.where("kind = 'term'").groupBy("term").agg(F.sum("n").alias("of_term"))
    return entities, terms, counts


def _share(total: int) -> Column:
    """The disclosed share from the columns both, of_entity and of_term."""
    information = F.log(F.lit(total) / F.col("of_entity"))
    mutual = F.log(F.col("both") * F.lit(total) / (F.col("of_entity") * F.col("of_term")))
    return F.when(information > 0, mutual / information).otherwise(0.0)


def disclosures(scanned: DataFrame, support: int = SUPPORT) -> DataFrame:
    """How much of an entity each term near it discloses: entity, term, disclosed (at most 1)."""
    entities, terms, counts = _counted(scanned)
    total = scanned.where("kind = 'document'").count()
    pairs = counts.where("kind = 'pair'").groupBy("entity", "term").agg(F.sum("n").alias("both"))
    pairs = pairs.where(F.col("both") >= support)
    known = pairs.join(entities, "entity").join(terms, "term")
    return known.select("entity", "term", _share(total).alias("disclosed"))


def telling_terms(scanned: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE) -> DataFrame:
    """The terms that disclose an entity of their document: row, term, disclosed (the most of any).

    ``scanned`` holds texts (no ``near``) and a column row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                terms = [x.decode() for x in terms_of(text.as_py())]
                columns = [pa.array([row] * len(terms), pa.int64()), pa.array(terms, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "term"])

    entities, terms, _ = _counted(scanned)
    total = scanned.where("kind = 'document'").count()
    found = scanned.where("kind = 'document' and text is not null")
    values = found.select("row", F.explode("entities").alias("entity"))
    held = stored(values.join(entities.where(F.col("of_entity") >= support), "entity"))

    def most(of_entity: Column) -> Column:
        """Documents of a term beyond which it cannot disclose enough; a little more for rounding."""
        return F.lit(total * (1 + 1e-9)) * F.pow(of_entity / F.lit(total), F.lit(generalise))

    ends = held.agg(F.max(most(F.col("of_entity")))).first()[0]
    terms = terms.where((F.col("of_term") >= support) & (F.col("of_term") <= F.lit(ends or 0.0)))
    texts = found.select("row", "text").join(held.select("row").distinct(), "row", "left_semi")
    words = stored(texts.mapInArrow(run, "row long, term string").join(terms, "term"))
    pairs = held.join(words, "row").where(F.col("of_term") <= most(F.col("of_entity")))
    pairs = pairs.groupBy("entity", "term", "of_entity", "of_term").agg(F.count("*").alias("both"))
    telling = pairs.where(F.col("both") >= support).select("entity", "term", _share(total).alias("disclosed"))
    telling = stored(telling.where(F.col("disclosed") >= generalise))
    places = held.select("row", "entity").join(telling, "entity").join(words.select("row", "term"), ["row", "term"])
    return places.groupBy("row", "term").agg(F.max("disclosed").alias("disclosed"))


def _places(scanned: DataFrame, telling: DataFrame, remove: float) -> DataFrame:
    """All places of each document's telling terms outside of its values: row, terms."""
    span = "start: long, end: long, remove: boolean"

    @F.udf(f"array<struct<{span}>>", useArrow=True)
    def marked(text: str, base: list, removed: list, replaced: list) -> list:
        removed, replaced = set(removed), set(replaced)
        values = iter([(x["start"], x["end"]) for x in base])
        value, out = next(values, None), []
        for found in _TERM.finditer(text):
            a, b = found.span()
            term = found.group().lower()
            while value and value[1] <= a:
                value = next(values, None)
            inside = value is not None and value[0] < b
            if (term in removed or term in replaced) and not inside:
                out.append({"start": a, "end": b, "remove": term in removed})
        return out

    strong = F.col("disclosed") >= remove
    terms = telling.groupBy("row").agg(
        F.collect_list(F.when(strong, F.col("term"))).alias("removed"),
        F.collect_list(F.when(~strong, F.col("term"))).alias("replaced"),
    )
    texts = scanned.where("kind = 'document' and text is not null").select("row", "base", "text")
    return texts.join(terms, "row").select("row", marked("text", "base", "removed", "replaced").alias("terms"))


def _near_places(scanned: DataFrame, support: int, generalise: float, remove: float) -> DataFrame:
    """The places near a value of terms that disclose it: row, terms."""
    telling = disclosures(scanned, support).where(F.col("disclosed") >= generalise)
    return (
        scanned.where("kind = 'document'")
        .select("row", F.explode("near").alias("x"))
        .select("row", "x.*")
        .join(telling, ["entity", "term"])
        .groupBy("row", "start", "end")
        .agg((F.max("disclosed") >= remove).alias("remove"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "remove"))).alias("terms"))
    )


def find(
    documents: DataFrame,
    near: int | None = None,
    support: int = SUPPORT,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """Spans per document.

    Columns: doc_id, base (array of kind, start, end) and its digest, terms (array of start, end and
    whether the term is removed or only generalised), and digests of the text as given and as sanitised.
    """
    texts = documents.select(documents["doc_id"].cast("long").alias("doc_id"), text_of(documents).alias("text"))
    scanned = stored(texts.mapInArrow(_scanned(near), FOUND).withColumn("row", F.monotonically_increasing_id()))
    names = ["doc_id", "base", "base_sha256", "text_sha256"]
    found = scanned.where("kind = 'document'").select("row", *names, "text")
    if near is None:
        terms = _places(scanned, telling_terms(scanned, support, generalise), remove)
    else:
        terms = _near_places(scanned, support, generalise, remove)
    empty = F.expr("cast(array() as array<struct<start: long, end: long, remove: boolean>>)")

    @F.udf("string", useArrow=True)
    def digest(text: str, base: list, terms: list) -> str:
        return hashlib.sha256(redacted(text, base, terms).encode()).hexdigest()

    whole = found.join(terms, "row", "left").withColumn("terms", F.coalesce("terms", empty))
    # only documents with values carry their text and change
    changed = whole.where("text is not null").withColumn("sanitised_sha256", digest("text", "base", "terms"))
    same = whole.where("text is null").withColumn("sanitised_sha256", F.col("text_sha256"))
    return changed.unionByName(same).select(*names, "terms", "sanitised_sha256")


def redacted(text: str, base: list[dict], terms: list[dict]) -> str:
    """The text without its values and telling terms; overlapping values share one mark."""
    spans = [(x["start"], x["end"], REPLACED[x["kind"]]) for x in base]
    spans += [(x["start"], x["end"], "" if x["remove"] else ANY_TERM) for x in terms]
    out, at = [], 0
    for start, end, mark in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise(documents: DataFrame, **options) -> DataFrame:
    """The documents with all their columns and redacted texts, a missing text as empty.

    Documents meet their spans by doc_id and a digest of the whole text, so rows that share only the
    doc_id, or none, are told apart, and equal ones have equal spans. Rows travel as records, so
    that their columns may have any name.
    """
    text = text_of(documents)
    digest = F.sha2(text, 256)
    keyed = documents.select(
        documents["doc_id"].cast("long").alias("doc"),
        digest.alias("digest"),
        text.alias("text"),
        F.struct(*(documents[name] for name in documents.columns)).alias("row"),
    )
    found = find(documents, **options).select(F.col("doc_id").alias("found"), "text_sha256", "base", "terms")
    found = found.groupBy("found", "text_sha256").agg(F.first("base").alias("base"), F.max("terms").alias("terms"))

    @F.udf("string", useArrow=True)
    def marked(text: str, base: list, terms: list) -> str:
        return redacted(text, base, terms)

    same = keyed["doc"].eqNullSafe(found["found"]) & (keyed["digest"] == found["text_sha256"])
    both = keyed.join(found, same).withColumn("redacted", marked("text", "base", "terms"))
    return both.select(
        *(
            (F.col("redacted") if name == "text" else F.col("row").getField(name)).alias(name)
            for name in documents.columns
        )
    )
