"""Mixing sources to target weights by temperature.

A source with the token share p gets a weight in proportion to p ** exponent. The exponent is
bisected between 0 (all sources alike) and 1 (as they are): the smallest entropy that reaches
``least_entropy`` of the possible one is aimed at, but never so flat that a source would be
read more than ``most_repeats`` times as often as the least repeated one. The budget is the
one at which the least repeated source is read exactly once, so every document stays; a
source with the weight w and the tokens t is read ``w * budget / t`` times.

The sum over sources runs in Spark for several exponents at a time; the driver sees one row
of sums per round however many sources there are.

Weights are realised in blocks: the documents of a source fall by a hash into blocks of about
``BLOCK_TOKENS`` tokens (and at most ``BLOCK_DOCUMENTS`` documents), are permuted inside their block by another hash, and each block gives
its documents once per whole repetition, and of the fractional rest as many, from the front of
the permutation, as its budget of tokens admits. A block's documents get a place between 0 and
1 in the mix, so ordering by it interleaves the sources at their weights. No window holds more
than a block, so a source with a third of all rows is many blocks.

Cases: a null source is a source of its own; a null text has no tokens; documents without
tokens are read once; rows equal in doc_id and text are documents of their own. Ties in the
hash are ordered by doc_id and text; an empty table gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartlens.llm.common import SPACE, stored, text_of

LEAST_ENTROPY = 0.97
MOST_REPEATS = 2.0
BLOCK_TOKENS = 200_000
#: Documents of a block on average at most, for sources of very short or empty texts.
BLOCK_DOCUMENTS = 20_000
#: Exponents tried at a time, and rounds of it: the interval shrinks to 16 ** -8.
TRIED = 15
ROUNDS = 8


def _tokens(text: Column) -> Column:
    """White-space words."""
    return F.size(F.filter(F.split(text, SPACE), lambda x: x != "")).cast("long")


def source_tokens(documents: DataFrame) -> DataFrame:
    """Tokens and documents per source."""
    rows = documents.select(documents["source"].alias("source"), _tokens(text_of(documents)).alias("tokens"))
    return rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"))


def exponent(
    sources: DataFrame, least_entropy: float = LEAST_ENTROPY, most_repeats: float = MOST_REPEATS
) -> tuple[float, float]:
    """The exponent and the budget in tokens for a table of sources with their tokens."""
    used = sources.where("tokens > 0")
    total, count, least, most = used.agg(
        F.sum("tokens"), F.count("*"), F.min("tokens"), F.max("tokens")
    ).first()
    if not count:
        return 1.0, 0.0
    share = used.select(F.log(F.col("tokens") / total).alias("log_p"))

    def sums(exponents: list[float]) -> list[tuple[float, float, float]]:
        """Per exponent: entropy of the weights, and the sum of the powers."""
        power = [F.exp(F.col("log_p") * a) for a in exponents]
        row = share.agg(*(x for p in power for x in (F.sum(p), F.sum(p * F.col("log_p"))))).first()
        out = []
        for i, a in enumerate(exponents):
            z, weighted = row[2 * i], row[2 * i + 1]
            out.append((a, math.log(z) - a * weighted / z, z))
        return out

    def fits(entropy: float) -> bool:
        return entropy >= least_entropy * math.log(count)

    # repeats of a source relative to the least repeated one: (most / tokens) ** (1 - a)
    spread = math.log(most / least)
    floor = 0.0 if spread == 0 else max(0.0, 1 - math.log(max(most_repeats, 1.0)) / spread)
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / (TRIED + 1)
        tried = sums([low + step * (i + 1) for i in range(TRIED)] + [high])
        low = max((a for a, entropy, _ in tried if fits(entropy)), default=low)
        high = min((a for a, entropy, _ in tried if not fits(entropy)), default=low)
        if low >= high:
            break
    chosen = max(low, floor)
    z = sums([chosen])[0][2]
    # the largest source is the least repeated: budget * weight = its tokens
    budget = most * z / math.exp(math.log(most / total) * chosen)
    return chosen, budget


def weights(
    documents: DataFrame, least_entropy: float = LEAST_ENTROPY, most_repeats: float = MOST_REPEATS
) -> DataFrame:
    """Columns source, tokens, documents, weight, repeats (how often the source is read)."""
    sources = stored(source_tokens(documents))
    chosen, budget = exponent(sources, least_entropy, most_repeats)
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    used = sources.where("tokens > 0")
    norm = used.agg(F.sum(F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(chosen)))).first()[0] or 1.0
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(chosen)) / norm)
    repeats = F.when(F.col("tokens") > 0, F.greatest(F.lit(1.0), F.round(weight * budget / F.col("tokens"), 9)))
    return stored(
        sources.select(
            "source",
            "tokens",
            "documents",
            F.coalesce(weight, F.lit(0.0)).alias("weight"),
            F.coalesce(repeats, F.lit(1.0)).alias("repeats"),
        )
    )


def _copies(
    documents: DataFrame, least_entropy: float, most_repeats: float, block_tokens: int
) -> DataFrame:
    """A row per document: its key, copies, tokens and place in the mix."""
    text = text_of(documents)
    rows = documents.select(
        documents["doc_id"].alias("doc_id"),
        F.xxhash64(text).alias("tag"),
        documents["source"].alias("source"),
        _tokens(text).alias("tokens"),
    )
    shares = weights(documents, least_entropy, most_repeats).withColumnRenamed("tokens", "source_tokens")
    parts = F.ceil(F.col("source_tokens") / block_tokens), F.ceil(F.col("documents") / BLOCK_DOCUMENTS)
    blocks = F.greatest(F.lit(1), *parts).cast("long")
    shares = shares.select("source", "weight", "repeats", blocks.alias("blocks"))
    shares = shares.withColumnRenamed("source", "_source")
    rows = rows.join(shares, rows["source"].eqNullSafe(shares["_source"])).drop("_source")
    rows = rows.withColumns(
        {
            "block": F.pmod(F.xxhash64(F.lit("block"), "doc_id", "tag"), F.col("blocks")),
            "turn": F.xxhash64(F.lit("turn"), "doc_id", "tag"),
        }
    )
    block = Window.partitionBy("source", "block")
    order = block.orderBy("turn", "doc_id", "tag").rowsBetween(Window.unboundedPreceding, 0)
    after = F.sum("tokens").over(order)
    size = F.sum("tokens").over(block)
    rest = F.col("repeats") - F.floor("repeats")
    middle = after - F.col("tokens") / 2
    inside = F.coalesce(F.try_divide(middle, size), F.lit(0.0))
    # a document is read once more if its middle lies inside the block's rest of the budget
    once_more = (F.col("tokens") > 0) & (middle < rest * size)
    return rows.select(
        "doc_id",
        "tag",
        "source",
        "tokens",
        "weight",
        "repeats",
        "block",
        (F.floor("repeats") + F.when(once_more, 1).otherwise(0)).cast("int").alias("copies"),
        ((F.col("block") + inside) / F.col("blocks")).alias("place"),
        # in the last, partial reading the front of each block spreads over all of it
        F.when(once_more, (F.col("block") * rest + inside) / F.col("blocks")).alias("last_place"),
    )


def mix(
    documents: DataFrame,
    least_entropy: float = LEAST_ENTROPY,
    most_repeats: float = MOST_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """A row per reading of a document.

    Columns: doc_id, source, tokens, weight, repeats, block, reading (from 0), mix_key (orders
    the readings; the sources follow each other at their weights).
    """
    rows = _copies(documents, least_entropy, most_repeats, block_tokens)
    readings = rows.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("reading"))
    partial = F.col("reading") > F.floor("repeats")
    place = F.when(partial, F.col("last_place")).otherwise(F.col("place"))
    return readings.select(
        "doc_id",
        "source",
        "tokens",
        "weight",
        "repeats",
        "block",
        (F.col("reading") - 1).alias("reading"),
        ((F.col("reading") - 1 + place) / F.col("repeats")).alias("mix_key"),
    )


def mixed_documents(
    documents: DataFrame,
    least_entropy: float = LEAST_ENTROPY,
    most_repeats: float = MOST_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The documents with all their columns, each as often as the mix reads it."""
    copies = _copies(documents, least_entropy, most_repeats, block_tokens)
    # rows equal in doc_id and text share one entry: each is read as often as the entry says
    copies = copies.groupBy("doc_id", "tag").agg(F.max("copies").alias("copies"))
    # rows travel as records, so that their columns may have any name
    rows = documents.select(
        documents["doc_id"].alias("doc_id"),
        F.xxhash64(text_of(documents)).alias("tag"),
        F.struct(*(documents[name] for name in documents.columns)).alias("row"),
    )
    same = rows["doc_id"].eqNullSafe(copies["doc_id"]) & (rows["tag"] == copies["tag"])
    read = rows.join(copies, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return read.select(*(F.col("row").getField(name).alias(name) for name in documents.columns))
