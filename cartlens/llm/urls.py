"""URL filters: prefix rules, and exact membership in a list by cascades of Bloom filters.

The list has hosts and addresses (host and path). The hosts and addresses of the corpus are the
whole universe of keys. Level 1 encodes the listed ones; the others that pass it by chance are
encoded in level 2; the listed ones that pass level 2 are encoded in level 3, and so on until nobody
passes by chance. A key of the universe is listed exactly if the number of levels it passes in a
row is odd, so pages are judged without a join.

A level is built by a grouping of bit positions into words. Keys are dealt to shards by hash; there
are as many as keep the cascade of one below ``most_bytes`` bytes. A single shard is sent to the
tasks. Of several, each task reads the words of its shards and then the rows of these shards, which
one shuffle brings together, salted, so that a host with many pages is read by many tasks. At
every size the cascade decides.

Cases: a null url, or one without ``://``, has an empty host and path and is allowed unless
the empty host is listed; repeated rows get equal results; null and duplicate listed keys
count once, keys outside the corpus are left out. Only page_id and url are read, and doc_id and
toxic of labels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import stored

#: (verdict, host, path): fits the host and its subdomains where the path starts alike.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Words in host labels that put a host on the query's list.
LISTED_WORDS = ["adult", "bets", "casino", "pills", "spam"]
#: The number of the document that a page shows, in its path.
NUMBERED = "^/[a-z][a-z]/([0-9]+)"
MOST_BYTES = 4 << 20
#: Bits per key after the first level: about one key in seven passes by chance.
LATER_BITS = 4
MOST_LEVELS = 64
#: Sorts the rows of a shard behind its words.
AFTER_WORDS = 1 << 20


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(_after(url), "?", 1)).otherwise("")
    rest = F.substring_index(F.substring_index(rest, "#", 1), "/", 1)
    return F.coalesce(_lower(rest), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(_after(url), "?", 1)).otherwise("")
    rest = F.substring_index(rest, "#", 1)
    slash = F.instr(rest, "/")
    return F.coalesce(F.when(slash > 0, F.substring(rest, slash, F.length(rest))).otherwise(""), F.lit(""))


def _after(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda x: (len(x[1]) + len(x[2]), x)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


class Level(NamedTuple):
    """A Bloom filter of ``bits`` bits in each shard."""

    number: int
    bits: int
    probes: int

    def places(self, key: Column) -> list[Column]:
        """A hash function of its own per level and probe: these two come before the key."""
        return [
            F.pmod(F.xxhash64(F.lit(self.number), F.lit(probe), key), F.lit(self.bits))
            for probe in range(self.probes)
        ]


class Cascade(NamedTuple):
    """Levels, and a stored table (shard, level, word, bits) with 64 bits a row."""

    levels: list[Level]
    shards: int
    words: DataFrame
    most_bytes: int

    @property
    def n_bytes(self) -> int:
        return sum(x.bits for x in self.levels) * self.shards // 8


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(shards)).cast("int")


def _words(keys: DataFrame, level: Level, shards: int) -> DataFrame:
    """The words of a level, with a bit per key and probe."""
    places = F.explode(F.array(*level.places(F.col("key"))))
    rows = keys.select(_shard(F.col("key"), shards).alias("shard"), places.alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(64)).cast("int"))
    return (
        rows.groupBy("shard", F.floor(F.col("place") / 64).alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .select("shard", F.lit(level.number).alias("level"), "word", "bits")
    )


class _Shard:
    """The bits of one shard in a task."""

    def __init__(self, levels: list[Level]):
        self.probes = [x.probes for x in levels]
        self.at = {x.number: i for i, x in enumerate(levels)}
        self.dense = [np.zeros(x.bits // 64, np.int64) for x in levels]

    def clear(self) -> None:
        for dense in self.dense:
            dense[:] = 0

    def fill(self, level: np.ndarray, word: np.ndarray, bits: np.ndarray) -> None:
        for number, i in self.at.items():
            own = level == number
            self.dense[i][word[own]] = bits[own]

    def passed(self, places: pa.Array) -> np.ndarray:
        """The number of levels passed in a row, for a list of places per key."""
        flat = places.flatten().to_numpy().reshape(len(places), sum(self.probes))
        alive, passed, column = np.ones(len(flat), bool), np.zeros(len(flat), np.int32), 0
        for dense, probes in zip(self.dense, self.probes, strict=True):
            for place in flat.T[column : column + probes]:
                alive &= (dense.view(np.uint64)[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
            column += probes
            passed += alive
        return passed


def levels_passed(rows: DataFrame, key: str, cascade: Cascade) -> DataFrame:
    """Adds ``passed``: the number of levels that the column ``key`` passes in a row."""
    places = F.array(*(x for level in cascade.levels for x in level.places(F.col(key))))
    given = F.struct(*rows.columns).alias("row")
    shape = f"row {rows.select(given).schema[0].dataType.simpleString()}, passed int"
    if cascade.shards == 1 and cascade.n_bytes <= cascade.most_bytes:
        found = _with_one_shard(rows.select(given, places.alias("places")), shape, cascade)
    else:
        found = _with_many_shards(rows.select(given, _shard(F.col(key), cascade.shards).alias("shard"), places.alias("places")), shape, cascade)
    return found.select("row.*", "passed")


def _with_one_shard(rows: DataFrame, shape: str, cascade: Cascade) -> DataFrame:
    bits = _Shard(cascade.levels)
    words = cascade.words.toArrow()  # at most most_bytes / 8 rows
    bits.fill(*(words.column(x).to_numpy() for x in ("level", "word", "bits")))
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = pa.array(shared.value.passed(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), passed], ["row", "passed"])

    return rows.mapInArrow(run, shape)


def _with_many_shards(rows: DataFrame, shape: str, cascade: Cascade) -> DataFrame:
    """Words and rows of a shard meet in each of its salts, words first."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(8, tasks // cascade.shards)
    levels = cascade.levels
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    words = cascade.words.select("shard", every_salt, "level", "word", "bits")
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    keyed = rows.withColumns({"salt": salt, "level": F.lit(AFTER_WORDS)})
    both = words.unionByName(keyed, allowMissingColumns=True).select(
        "shard", "salt", "level", "word", "bits", "row", "places"
    )
    met = both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "level")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, here = _Shard(levels), None
        for batch in batches:
            if not batch.num_rows:
                continue
            shard, salt, level = (batch.column(i).to_numpy() for i in range(3))
            is_row = level == AFTER_WORDS
            slot = shard.astype(np.int64) * salts + salt
            ends = np.flatnonzero((np.diff(slot) != 0) | (np.diff(is_row.astype(np.int8)) != 0)) + 1
            for start, end in zip([0, *ends], [*ends, batch.num_rows], strict=True):
                if slot[start] != here:
                    bits.clear()
                    here = slot[start]
                part = batch.slice(start, end - start)
                if is_row[start]:
                    passed = pa.array(bits.passed(part.column(6)))
                    yield pa.RecordBatch.from_arrays([part.column(5), passed], ["row", "passed"])
                else:
                    bits.fill(*(part.column(i).to_numpy() for i in (2, 3, 4)))

    return met.mapInArrow(run, shape)


def build_cascade(universe: DataFrame, most_bytes: int = MOST_BYTES) -> Cascade | None:
    """The cascade of a stored table (key, listed) of distinct keys; None if none is listed."""
    sides = {True: universe.where("listed").select("key"), False: universe.where("not listed").select("key")}
    sizes = {True: 0, False: 0} | {x["listed"]: x["count"] for x in universe.groupBy("listed").count().collect()}
    if not sizes[True]:
        return None
    # as many false positives in the first level as there are listed keys, over the root of two
    chance = min(0.5, sizes[True] / (math.sqrt(2) * max(1, sizes[False])))
    first_bits = max(LATER_BITS, math.ceil(-math.log2(chance) / math.log(2)))
    expected = sizes[True] * (first_bits + 1.25 * LATER_BITS) / 8
    shards = math.ceil(expected / most_bytes)
    levels: list[Level] = []
    words: list[DataFrame] = []
    for number in range(MOST_LEVELS):
        own = number % 2 == 0
        if not sizes[own]:
            return Cascade(levels, shards, reduce(DataFrame.unionByName, words), most_bytes)
        per_key = LATER_BITS if number else first_bits
        level = Level(number, -(-sizes[own] * per_key // (64 * shards)) * 64, max(1, round(per_key * math.log(2))))
        levels.append(level)
        words.append(stored(_words(sides[own], level, shards)))
        one = Cascade([level], shards, words[-1], most_bytes)
        sides[not own] = stored(levels_passed(sides[not own], "key", one).where("passed = 1").select("key"))
        sizes[not own] = sides[not own].count()
    raise RuntimeError(f"keys pass by chance after {MOST_LEVELS} levels")


def address(host: Column, path: Column) -> Column:
    """Host and path; what has no slash is a host."""
    return F.concat(host, path)


def spam_hosts(pages: DataFrame, words: list[str] = LISTED_WORDS) -> DataFrame:
    """The hosts of pages with one of ``words`` as a part of a label: column key."""
    hosts = pages.select(host_of(pages["url"]).alias("key")).distinct()
    return hosts.where(F.col("key").rlike(r"(^|[.-])(" + "|".join(words) + r")([.-]|$)"))


def toxic_addresses(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The addresses of pages that show a document labelled toxic: column key.

    Their paths begin with a language and the document's number.
    """
    parts = pages.select(host_of(pages["url"]).alias("host"), path_of(pages["url"]).alias("path"))
    shown = F.regexp_extract("path", NUMBERED, 1).try_cast("long")
    toxic = labels.where("toxic = 1").select(labels["doc_id"].cast("long").alias("doc_id")).distinct()
    found = parts.distinct().withColumn("doc_id", shown).join(toxic, "doc_id")
    return found.select(address(F.col("host"), F.col("path")).alias("key"))


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """Columns page_id, host, path, rule, verdict, listed.

    ``listed`` has a column key with hosts, and addresses, to block where no rule fits.
    """
    rows = pages.select(
        "page_id", host_of(pages["url"]).alias("host"), path_of(pages["url"]).alias("path")
    ).withColumn("address", address(F.col("host"), F.col("path")))
    blocked = listed.select("key").where("key is not null").distinct().withColumn("listed", F.lit(True))
    keys = rows.select(F.explode(F.array("host", "address")).alias("key")).distinct()
    universe = stored(keys.join(blocked, "key", "left").select("key", F.coalesce("listed", F.lit(False)).alias("listed")))
    cascade = build_cascade(universe, most_bytes)
    if cascade is None:
        found = rows.withColumn("listed", F.lit(False))
    else:
        found = levels_passed(rows, "host", cascade).withColumnRenamed("passed", "host_passed")
        found = levels_passed(found, "address", cascade)
        found = found.withColumn("listed", (F.col("host_passed") % 2 == 1) | (F.col("passed") % 2 == 1))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return found.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "listed"
    )
