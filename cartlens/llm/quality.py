"""Quality rules: word and repetition counts, and lines that too many documents of a host share.

Lines are trimmed, lower-cased, their white space reduced to single spaces, and hashed with
their host (the source). A line is boilerplate if more than ``SHARE_OF_HOST`` of the host's
distinct texts hold it, and more than ``FEW_DOCUMENTS``; more than ``most_documents`` are enough
in a host of any size (copies of a text count once, so a group of copies is no boilerplate).
Boilerplate lines are removed; a document is rejected if less than ``least_share`` of its
words remain, or by the base rules.

Everything is DataFrame expressions: repeated 5-word windows are found by sorting their hashes
inside the row, the line counts by two groupings that combine before the shuffle, and the few
boilerplate lines are stored before documents' lines are looked up among them.

Cases: a null text is empty (no words, rejected); a null source is a host of its own; a null
doc_id is an id of its own; rows equal in doc_id and text get equal results, and rows that
share only the doc_id are judged apart. Only doc_id, text and source are read by ``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import SPACE, id_of, let, shown_id, stored, text_of

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
SYMBOLS = "#*$%&|<>"
#: A line is boilerplate if more than this share of a host's distinct texts hold it, and more than a few.
#: In the given tables one line of a host is held by 11 to 22 % of its texts, the next by under 5 %.
SHARE_OF_HOST = 0.08
FEW_DOCUMENTS = 10
#: Share of words that must remain.
LEAST_SHARE = 0.3


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda x: x != "")


def repeated_words(words: Column) -> Column:
    """Words covered by windows of ``WINDOW`` words that the list holds twice or more."""
    positions = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(positions, lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW)))

    def covered(hashes: Column) -> Column:
        sorted_pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(pairs: Column) -> Column:
            def same(i: Column, other: Column) -> Column:
                return F.coalesce(F.get(pairs, other)["h"] == F.get(pairs, i)["h"], F.lit(False))

            again = F.filter(pairs, lambda _, i: same(i, i + 1) | ((i > 0) & same(i, F.greatest(i - 1, F.lit(0)))))
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        def total(at: Column) -> Column:
            gaps = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
            return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

        return let(let(sorted_pairs, places), total)

    def any_twice(hashes: Column) -> Column:
        return F.size(F.array_distinct(hashes)) < F.size(hashes)

    counted = let(hashes, lambda h: F.when(any_twice(h), covered(h)).otherwise(0))
    return F.when(F.size(words) < WINDOW, 0).otherwise(counted)


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))


def _line(host: Column, line: Column) -> Column:
    """A line's hash, together with its host."""
    return F.xxhash64(host, line)


def _host(documents: DataFrame) -> Column:
    return F.coalesce(documents["source"].cast("string"), F.lit("\x00"))


def _lines(documents: DataFrame) -> DataFrame:
    """A row per line with a word: place in the text, hash with its host, words in it."""
    text = text_of(documents)
    lines = F.filter(F.transform(F.split(text, "\n"), normal_line), lambda x: x != "")
    hashed = F.transform(
        lines,
        lambda x, i: F.struct(
            i.alias("place"),
            _line(_host(documents), x).alias("line"),
            (F.length(x) - F.length(F.translate(x, " ", "")) + 1).alias("words"),
        ),
    )
    rows = documents.select(
        id_of(documents).alias("doc"),
        F.xxhash64(text).alias("tag"),
        F.xxhash64(_host(documents)).alias("host"),
        F.explode(hashed).alias("x"),
    )
    return rows.select("doc", "tag", "host", "x.place", "x.line", "x.words")


def boilerplate(
    documents: DataFrame, share_of_host: float = SHARE_OF_HOST, few_documents: int = FEW_DOCUMENTS
) -> DataFrame:
    """Hashes of the lines that too many distinct texts of a host hold; one rule for hosts of any size."""
    held = (
        _lines(documents)
        .select("host", "line", "tag")
        .distinct()
        .groupBy("host", "line")
        .count()
        .where(F.col("count") > few_documents)
    )
    texts = documents.select(
        F.xxhash64(_host(documents)).alias("host"), F.xxhash64(text_of(documents)).alias("tag")
    )
    hosts = texts.distinct().groupBy("host").agg(F.count("*").alias("texts"))
    limited = held.join(hosts, "host").where(F.col("count") > F.lit(share_of_host) * F.col("texts"))
    return limited.select("line")


def _removed(documents: DataFrame, share_of_host: float, few_documents: int) -> DataFrame:
    """The documents with boilerplate: its lines (distinct hashes) and the words in them."""
    found = _lines(documents).join(stored(boilerplate(documents, share_of_host, few_documents)), "line")
    # a set, so that repeated rows count once
    places = F.collect_set(F.struct("place", "line", "words")).alias("places")
    return (
        found.groupBy("doc", "tag")
        .agg(places)
        .select(
            "doc",
            "tag",
            F.aggregate("places", F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("removed"),
            F.array_distinct(F.transform("places", lambda x: x["line"])).alias("lines"),
        )
    )


def _counts(documents: DataFrame) -> dict[str, Column]:
    """Expressions over a column ``words`` and the text."""
    text = text_of(documents)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": let(F.col("words"), repeated_words),
    }
    return {name: value.cast("long") for name, value in counts.items()}


def _failed() -> Column:
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < LEAST_WORDS) | repeated


def judge(
    documents: DataFrame,
    share_of_host: float = SHARE_OF_HOST,
    few_documents: int = FEW_DOCUMENTS,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """Counts and verdict per document.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_removed_words, kept.
    """
    text = text_of(documents)
    rows = documents.select(id_of(documents).alias("doc"), text.alias("text"), words_of(text).alias("words"))
    counts = _counts(rows)
    rows = rows.select("doc", F.xxhash64("text").alias("tag"), *(x.alias(n) for n, x in counts.items()))
    removed = _removed(documents, share_of_host, few_documents).select("doc", "tag", "removed")
    gone = F.coalesce("removed", F.lit(0).cast("long"))
    return rows.join(removed, ["doc", "tag"], "left").select(
        shown_id("doc").alias("doc_id"),
        *counts,
        _failed().alias("base_failed"),
        gone.alias("n_removed_words"),
        (~_failed() & (F.col("n_words") - gone >= least_share * F.col("n_words"))).alias("kept"),
    )


def clean(
    documents: DataFrame,
    share_of_host: float = SHARE_OF_HOST,
    few_documents: int = FEW_DOCUMENTS,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """The documents that are kept, without their boilerplate lines; all columns.

    A column n_chars, if there is one, follows the changed texts.
    """
    text = text_of(documents)
    rows = documents.select(
        id_of(documents).alias("doc"),
        F.xxhash64(text).alias("tag"),
        text.alias("text"),
        _host(documents).alias("host"),
        F.struct(*(documents[name] for name in documents.columns)).alias("row"),
        words_of(text).alias("words"),
    )
    rows = rows.select("*", *(x.alias(n) for n, x in _counts(rows).items())).where(~_failed()).drop("words")
    removed = _removed(documents, share_of_host, few_documents)
    kept = rows.join(removed, ["doc", "tag"], "left").where(
        F.col("removed").isNull() | (F.col("n_words") - F.col("removed") >= least_share * F.col("n_words"))
    )
    rest = F.filter(
        F.split("text", "\n"), lambda x: ~F.array_contains("lines", _line(F.col("host"), normal_line(x)))
    )
    changed = {"text": F.array_join(rest, "\n")}
    if "n_chars" in documents.columns:
        changed["n_chars"] = F.length(changed["text"]).cast(documents.schema["n_chars"].dataType)
    return kept.select(
        *(
            F.when(F.col("removed").isNull(), F.col("row")[name]).otherwise(changed[name]).alias(name)
            if name in changed
            else F.col("row")[name].alias(name)
            for name in documents.columns
        )
    )
