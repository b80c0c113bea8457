"""Spelling variants by pairs of trie nodes.

Words are sorted, and the nodes of their trie are numbered by one scan of the order: a prefix is
named by the first word that has it and its length. The same scan over the reversed words numbers
the suffixes. A word of n letters then is n + 1 pairs of integers (prefix node, suffix node), one
for each place it can be cut. Skipping the letter at a place gives the pair before and after it.
Two words with the same skipped pair differ in that letter; a word whose skipped pair is
another's cut pair has one letter more. Nodes stand for strings one to one, so pairs that meet are
neighbours and no comparison follows. Of a run of equal letters only the last is skipped against
cut pairs, so each two neighbours meet once.

Scans run over ranges of the order at the same time. A range knows only its own words; prefixes
that reach over its start are put right from the ends of the ranges before it, which is a path of
nodes per range. Words that meet in a pair differ in one letter of the alphabet, so at most some
ninety of them and one shorter word meet, however frequent a word is: a word is one row whatever
its count, and counts are added up in each task before they are shuffled.

Cases: null texts have no words, a null doc_id is written as nothing; a word may have any length
(its rows grow in proportion); equal counts go to the word first in code-point order; repeated rows
count again; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import let, stored

#: Letters of a word, as UTF-8.
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form is at least so many times as frequent as its variant.
TIMES = 10
#: One in so many occurrences loses a letter.
DELETED = 31
#: Bytes of distinct words that a task counts before it hands them on.
BYTES_HELD = 2**25
#: Ranges of the sorted words for every so many of them.
RANGE = 50_000


def damaged(doc: str, run: bytes) -> str:
    """The run, without one letter if the checksum of document and run is a multiple."""
    word = run.decode()
    h = zlib.crc32(run, zlib.crc32(doc.encode() + b":"))
    if h % DELETED:
        return word
    return word[: (place := h % len(word))] + word[place + 1 :]


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of documents (doc, text as UTF-8 bytes) and their counts, a word perhaps several times."""
    words: Counter[str] = Counter()
    held = 0

    def emptied() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pydict(
            {"word": pa.array(words.keys(), pa.string()), "n": pa.array(words.values(), pa.int64())}
        )
        words.clear()
        return batch

    for batch in batches:
        for doc, text in zip(batch["doc"].to_pylist(), batch["text"], strict=True):
            # only A to Z are lower-cased in bytes
            runs = Counter(RUN.findall(text.as_py().lower()))
            for run, n in runs.items():
                # shorter runs have fewer letters
                if len(run) >= LEAST_LENGTH and len(word := damaged(doc, run)) >= LEAST_LENGTH:
                    if word not in words:
                        held += len(run) + 100
                    words[word] += n
            if held >= BYTES_HELD:
                yield emptied()
                held = 0
    yield emptied()


def words_of(documents: DataFrame) -> DataFrame:
    """word, n: the words that count."""
    rows = documents.where("text is not null").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.col("text").cast("binary").alias("text")
    )
    found = rows.mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def common_prefix(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def scanned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted distinct words: the place in the range, and for every prefix the place of the first word with it."""
    part = TaskContext.get().partitionId()
    before, firsts, place = "", [], 0
    for frame in frames:
        out = []
        for word in frame["word"]:
            shared = common_prefix(before, word)
            firsts = [*firsts[: shared + 1], *[place] * (len(word) - shared)] if place else [0] * (len(word) + 1)
            out.append((part, place, firsts))
            before, place = word, place + 1
        columns = pd.DataFrame(out, columns=["part", "place", "firsts"])
        yield pd.concat([columns, frame.reset_index(drop=True)], axis=1)


def numbered(words: DataFrame, ranges: int) -> DataFrame:
    """Adds rank (in code-point order of word, which is unique) and nodes, the number of each prefix.

    A node's number is the rank of its first word, times the longest length, plus its depth. The
    driver sees the first and the last word of each range.
    """
    schema = "part int, place long, firsts array<long>, " + words._jdf.schema().toDDL()
    ordered = words.repartitionByRange(ranges, "word").sortWithinPartitions("word")
    scans = stored(ordered.mapInPandas(scanned, schema))
    ends = (
        scans.groupBy("part")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min_by("word", "place").alias("first"),
            F.max_by(F.struct("word", "firsts"), "place").alias("last"),
        )
        .orderBy("part")
        .collect()
    )
    before, path, start, offsets, reaching = "", [], 0, {}, {}
    for end in ends:
        shared = common_prefix(before, end["first"]) if path else -1
        inherited = path[: shared + 1]
        offsets[end["part"]], reaching[end["part"]] = start, inherited
        path = [
            inherited[depth] if place == 0 and depth < len(inherited) else start + place
            for depth, place in enumerate(end["last"]["firsts"])
        ]
        before, start = end["last"]["word"], start + end["n"]
    if not ends:
        offsets, reaching = {0: 0}, {0: []}
    spark = words.sparkSession
    known = spark.createDataFrame(
        [(part, offsets[part], reaching[part]) for part in offsets],
        "part int, start long, inherited array<long>",
    )
    width = scans.agg(F.max(F.size("firsts"))).scalar()
    node = F.transform(
        "firsts",
        lambda first, depth: F.when((first == 0) & (depth < F.size("inherited")), F.get("inherited", depth)).otherwise(
            F.col("start") + first
        )
        * F.col("width")
        + depth,
    )
    return (
        scans.join(F.broadcast(known), "part")
        .withColumn("width", width)
        .select(*words.columns, (F.col("start") + F.col("place")).alias("rank"), node.alias("nodes"))
    )


def near_words(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words with their rank, and a row per word that has neighbours: rank, n_near, best.

    ``words`` has word and n. ``best`` is the neighbour of largest n, then of smallest rank.
    """
    ranges = max(1, words.count() // RANGE)
    prefixes = stored(numbered(words, ranges))
    backwards = words.select(F.reverse("word").alias("word"), F.col("word").alias("written"))
    suffixes = numbered(backwards, ranges).select(F.col("written").alias("word"), F.reverse("nodes").alias("after"))
    both = prefixes.join(suffixes, "word")

    # nodes[i] is the prefix of i letters, after[i] the suffix from letter i on
    def pair(prefix, suffix, skips, ends_run):
        return F.struct(
            F.get("nodes", prefix).alias("prefix"),
            F.get("after", suffix).alias("suffix"),
            F.lit(skips).alias("skips"),
            ends_run.alias("ends_run"),
        )

    def pairs(letters):
        def skip(letter, i):
            return pair(i, i + 1, True, ~letter.eqNullSafe(F.get(letters, i + 1)))

        cuts = F.transform("nodes", lambda _, i: pair(i, i, False, F.lit(True)))
        return F.concat(cuts, F.transform(letters, skip))

    rows = both.select("n", "rank", F.inline(let(F.split("word", ""), pairs)))
    # the words of a pair: one that is cut there, others by a letter of the alphabet
    met = (
        rows.groupBy("prefix", "suffix")
        .agg(F.sort_array(F.collect_list(F.struct("n", (-F.col("rank")).alias("later"), "skips", "ends_run")), False).alias("words"))
        .where(F.size("words") > 1)
    )

    def neighbours(word):
        def near(other):
            replaced = word["skips"] & other["skips"] & (word["later"] != other["later"])
            longer = word["skips"] & word["ends_run"] & ~other["skips"]
            shorter = ~word["skips"] & other["skips"] & other["ends_run"]
            return replaced | longer | shorter

        return F.filter("words", near)

    def summed(word):
        found = neighbours(word)
        return F.struct(
            (-word["later"]).alias("rank"),
            F.size(found).alias("near"),
            F.struct(F.get(found, F.lit(0))["n"].alias("n"), F.get(found, F.lit(0))["later"].alias("later")).alias("best"),
        )

    found = (
        met.select(F.inline(F.transform("words", summed)))
        .where("near > 0")
        .groupBy("rank")
        .agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
    )
    return prefixes.select("word", "n", "rank"), found


def rooted(links: DataFrame) -> DataFrame:
    """rank, root of rows (rank, form) that lead to ever more frequent words: each round doubles the reach."""
    open_ = stored(links.withColumnRenamed("form", "root"))
    rounds = [open_]
    while True:
        upper = open_.select(F.col("rank").alias("root"), F.col("root").alias("above"))
        longer = stored(open_.join(upper, "root").select("rank", F.col("above").alias("root")))
        if longer.isEmpty():
            break
        merged = open_.join(longer.withColumnRenamed("root", "above"), "rank", "left")
        open_ = stored(merged.select("rank", F.coalesce("above", "root").alias("root")))
        rounds.append(open_)
    return rounds[-1]


def variants(documents: DataFrame) -> DataFrame:
    """A row per word: word, form, root, n, n_near, form_n."""
    words = stored(words_of(documents))
    ranked, found = near_words(words)
    ranked = stored(ranked)
    near = stored(
        ranked.join(found, "rank", "left").select(
            "rank",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("best.n") >= TIMES * F.col("n"), -F.col("best.later")).alias("form_rank"),
            F.when(F.col("best.n") >= TIMES * F.col("n"), F.col("best.n")).alias("form_n"),
        )
    )
    links = near.where("form_rank is not null").select("rank", F.col("form_rank").alias("form"))
    forms = ranked.select(F.col("rank").alias("form_rank"), F.col("word").alias("form"))
    roots = rooted(links).join(ranked.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root")
    linked = near.where("form_rank is not null").join(forms, "form_rank").join(roots.drop("root"), "rank")
    names = ["word", "form", "root", "n", "n_near", "form_n"]
    alone = near.where("form_rank is null").withColumns({"form": F.lit(None).cast("string"), "root": F.col("word")})
    return alone.select(*names).unionByName(linked.withColumnRenamed("root_word", "root").select(*names))
