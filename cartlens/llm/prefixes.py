"""The prefix trie of conversations, grouped by blocks of turns.

A turn is a digest of its role and text, and a prefix of d turns is the digest chained over
them. Each conversation is cut into blocks of a fixed number of turns. Conversations are first
grouped by the digests at the ends of their blocks, so a block that many share is one class
with a count. Where a block's start is followed by a single class, siblings do not part inside
it: all its turns have the members of the class. Only classes whose start has several are opened
turn by turn and grouped again by the prefixes inside. So refinement sees classes, not
conversations, and a prefix shared by a third of all rows is counted before it is shuffled.

Sums over subtrees need no walk down the levels. The smallest member of a node owns it; what a
conversation owns is the end of its path. Inside the own part a running sum from the end gives
each node's share; all nodes above get the whole sum, added up by block class first.

Digests are the first 16 bytes of SHA-256 over length-prefixed parts and stand for the turns.

Cases: null roles and texts are empty; turns follow by turn (null first), then role and text, so
repeated rows are turns of their own; rows without conv_id belong to no conversation and are left
out; an empty table gives no rows, not even the root. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartlens.llm.common import stored

#: Turns of a block.
BLOCK = 4
#: The prefix of no turns.
ROOT = b"\0" * 16
#: Ids written into one piece of an end list.
PIECE = 4096
BLOCKS = (
    "conv_id long, first_depth long, start binary, prefixes array<binary>, chars array<long>, "
    "end binary, last boolean"
)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), turn digest, chars: the turns in their order, without texts."""
    role, text = (F.coalesce(F.col(x), F.lit("")) for x in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("place"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"),
        F.length("text").cast("long").alias("chars"),
    )


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations that begin like another one.

    The first h turns of conversation c - c % every, then the own turns after the first h, where h is
    the checksum of the id modulo ``most``. Adds part: 0 for borrowed turns, 1 for own ones.
    """
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("place") < most))
    heads = heads.withColumnRenamed("conv_id", "source")
    own = turns.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    convs = own.where("place = 1").select("conv_id", "h", (F.col("conv_id") - F.col("conv_id") % every).alias("source"))
    borrowed = convs.where("h > 0").join(heads, "source").where("place <= h")
    names = ["conv_id", "place", "digest", "chars"]
    return borrowed.select(*names, F.lit(0).alias("part")).unionByName(
        own.where("place > h").select(*names, F.lit(1).alias("part"))
    )


def chained(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted turns of whole conversations to a row per block; a conversation may span frames."""
    names = ["conv_id", "first_depth", "start", "prefixes", "chars", "end", "last"]
    current, depth, above, prefixes, chars = None, 0, ROOT, [], []

    def block(last: bool) -> tuple:
        end = prefixes[-1] if prefixes else above
        return (current, depth - len(prefixes) + 1, above, prefixes, chars, end, last)

    for frame in rows:
        out = []
        for conv, digest, length in zip(frame["conv_id"], frame["digest"], frame["chars"], strict=True):
            if conv != current:
                if current is not None:
                    out.append(block(True))
                current, depth, above, prefixes, chars = conv, 0, ROOT, [], []
            if pd.isna(length):  # marks a conversation, no turn
                continue
            if len(prefixes) == BLOCK:
                out.append(block(False))
                above, prefixes, chars = prefixes[-1], [], []
            before = prefixes[-1] if prefixes else above
            prefixes.append(hashlib.sha256(before + bytes(digest)).digest()[:16])
            chars.append(int(length))
            depth += 1
        yield pd.DataFrame(out, columns=names)
    if current is not None:
        yield pd.DataFrame([block(True)], columns=names)


def blocks_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The blocks of all ``convs`` (conv_id, each once); one without turns has one empty block."""
    marks = convs.select(
        "conv_id",
        F.lit(0).cast("long").alias("place"),
        F.lit(b"").alias("digest"),
        F.lit(None).cast("long").alias("chars"),
        F.lit(-1).alias("part"),
    )
    if "part" not in turns.columns:
        turns = turns.withColumn("part", F.lit(1))
    ordered = turns.unionByName(marks).repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return ordered.mapInPandas(chained, BLOCKS)


def _grouped(blocks: DataFrame) -> DataFrame:
    """Classes of equal blocks: members, smallest member, and the turns they agree on."""
    return (
        blocks.where(F.size("prefixes") > 0)
        .groupBy("start", "end")
        .agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv_id").alias("owner"),
            F.min(F.struct("first_depth", "prefixes", "chars")).alias("turns"),
        )
        .select("start", "end", "n_convs", "owner", "turns.*")
    )


def _opened(classes: DataFrame, *more: str) -> DataFrame:
    """A row per turn of each class: digest, parent, depth, chars and the columns named."""
    index = F.posexplode("prefixes").alias("i", "digest")
    parent = F.when(F.col("i") == 0, F.col("start")).otherwise(F.get("prefixes", F.col("i") - 1))
    return classes.select("start", "prefixes", "first_depth", F.col("chars").alias("lengths"), *more, index).select(
        "digest",
        parent.alias("parent"),
        (F.col("first_depth") + F.col("i")).alias("depth"),
        F.get("lengths", "i").alias("chars"),
        *more,
    )


def _nodes(classes: DataFrame) -> DataFrame:
    """digest, parent, depth, chars, n_convs, owner: every node but the root, once."""
    crowds = classes.groupBy("start").agg((F.count(F.lit(1)) > 1).alias("diverges"))
    marked = classes.join(crowds, "start")
    straight = _opened(marked.where(~F.col("diverges")), "n_convs", "owner")
    refined = (
        _opened(marked.where("diverges"), "n_convs", "owner")
        .groupBy("digest")
        .agg(
            # equal digests have equal parents, depths and lengths
            F.min(F.struct("parent", "depth", "chars")).alias("place"),
            F.sum("n_convs").alias("n_convs"),
            F.min("owner").alias("owner"),
        )
        .select("digest", "place.*", "n_convs", "owner")
    )
    return straight.unionByName(refined)


def _hashed_lists(ends: DataFrame) -> DataFrame:
    """digest, ends_sha256 of the ids of (digest, conv_id), ascending and comma-joined.

    Ids are sorted over all tasks and written as text there; a node's hash then streams over
    a few thousand ids at a time, without holding them.
    """

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            rows = zip(frame["digest"].map(bytes), frame["conv_id"], strict=True)
            for digest, group in itertools.groupby(rows, key=lambda row: row[0]):
                ids = [int(conv) for _, conv in group]
                for i in range(0, len(ids), PIECE):
                    out.append((digest, ids[i], ",".join(map(str, ids[i : i + PIECE]))))
            yield pd.DataFrame(out, columns=["digest", "first", "ids"])

    def hashes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for frame in frames:
            out = []
            for digest, ids in zip(frame["digest"].map(bytes), frame["ids"], strict=True):
                if digest != current:
                    if current is not None:
                        out.append((current, state.hexdigest()))
                    current, state = digest, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["digest", "ends_sha256"])
        if current is not None:
            yield pd.DataFrame([(current, state.hexdigest())], columns=["digest", "ends_sha256"])

    spread = ends.repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    texts = spread.mapInPandas(pieces, "digest binary, first long, ids string")
    whole = texts.repartition("digest").sortWithinPartitions("digest", "first")
    return whole.mapInPandas(hashes, "digest binary, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per node of the prefix trie of ``turns`` (see ``turn_rows``) of ``convs``.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (characters that sharing prefixes saves below), ends_sha256.
    """
    blocks = stored(blocks_of(turns, convs))
    classes = stored(_grouped(blocks))
    children = F.count(F.lit(1)).alias("n_children")
    nodes = _nodes(classes)
    counted = nodes.groupBy(F.col("parent").alias("digest")).agg(children)
    nodes = stored(nodes.join(counted, "digest", "left").fillna(0, ["n_children"]))

    # the own part of each owner's path, from its end
    upward = Window.partitionBy("owner").orderBy(F.desc("depth"))
    running = upward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = (F.col("n_convs") - 1) * F.col("chars")
    is_leaf = F.first(F.col("n_children") == 0).over(running).cast("long")
    own = nodes.select("*", F.sum(value).over(running).alias("own_saved"), is_leaf.alias("own_leaves"))
    owners = nodes.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("depth").alias("own_from"),
        F.sum(value).alias("saved"),
        (F.max_by("n_children", "depth") == 0).cast("long").alias("leaves"),
    )
    # what owners give to the nodes above their part: by block class, then by turn
    passing = blocks.where(F.size("prefixes") > 0).select("conv_id", "start", "end", "first_depth")
    given = (
        passing.join(owners.where("own_from > 1"), "conv_id")
        .where("first_depth < own_from")
        # in the block where the own part begins, only the turns before it
        .withColumn("until", F.least("own_from", F.col("first_depth") + BLOCK))
        .groupBy("start", "end", "until")
        .agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    )
    turns_of = classes.select("start", "end", "first_depth", "prefixes", "chars")
    above = (
        _opened(turns_of.join(given, ["start", "end"]), "until", "saved", "leaves")
        .where("depth < until")
        .groupBy("digest")
        .agg(F.sum("saved").alias("given_saved"), F.sum("leaves").alias("given_leaves"))
    )
    ends = blocks.where("last").select(F.col("end").alias("digest"), "conv_id")
    totals = owners.agg(F.sum("saved").alias("own_saved"), F.sum("leaves").alias("own_leaves"))
    sums = totals.select(F.struct("*")).scalar()
    firsts = nodes.agg(F.count_if(F.col("depth") == 1)).scalar()
    top = (
        convs.agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"))
        .where("n_convs > 0")
        .select(
            F.lit(ROOT).alias("digest"),
            F.lit(None).cast("binary").alias("parent"),
            F.lit(0).cast("long").alias("depth"),
            "n_convs",
            "owner",
            firsts.alias("n_children"),
            F.coalesce(sums["own_saved"], F.lit(0)).alias("own_saved"),
            # without any turn the root is the only leaf
            F.coalesce(sums["own_leaves"], F.lit(1)).alias("own_leaves"),
        )
    )
    every = own.drop("chars").unionByName(top)
    parents = every.where("n_children > 0").select(
        F.col("digest").alias("parent"), F.col("owner").alias("parent_conv_id")
    )
    return (
        every.join(above, "digest", "left")
        .join(_hashed_lists(ends), "digest", "left")
        .join(parents, "parent", "left")
        .select(
            F.col("owner").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            (F.col("own_leaves") + F.coalesce("given_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("own_saved") + F.coalesce("given_saved", F.lit(0))).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def shared_prefixes(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    turns = stored(turn_rows(conversations))
    return trie(turns, turns.where("place = 1").select("conv_id"))


def shared_prefixes_rebuilt(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations after ``rebuilt``."""
    turns = stored(turn_rows(conversations))
    return trie(rebuilt(turns), turns.where("place = 1").select("conv_id"))
