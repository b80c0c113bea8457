"""Exact deduplication that no group of copies can hold up.

Copies are combined three times, each time comparing digest and full text: inside each task
before the shuffle, then by (digest, salt) where the salt follows the task that read a row, so
that a group of copies is spread over as many tasks as there are salts, and last the winners
of the salts by digest. Documents then look their group up by digest; should two texts share a
digest, they look it up by the text itself.

Cases: a null text is empty and equal to an empty one; a null doc_id loses to any other and is
kept only in a group without one; rows equal in doc_id and text get equal results, and
``drop_copies`` keeps one of them. Only doc_id and text are read by ``group_copies``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import id_of, shown_id, stored, text_of

#: Tasks over which one group of copies is spread before its last combination.
SALTS = 32


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _combined(rows: DataFrame, salts: int) -> DataFrame:
    """One row per text: the largest id and the number of rows."""
    salted = rows.withColumn("salt", F.spark_partition_id() % salts)
    winners = salted.groupBy("digest", "salt", "body").agg(
        F.max("doc").alias("keep"), F.count("*").alias("copies")
    )
    return winners.groupBy("digest", "body").agg(
        F.max("keep").alias("keep"), F.sum("copies").alias("group_size")
    )


def group_copies(
    documents: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """Each document's group of equal texts.

    Columns: doc_id, keep_id (largest doc_id of the group), group_size, kept, digest.
    """
    text = text_of(documents)
    rows = documents.select(
        id_of(documents).alias("doc"), digest(text).alias("digest"), text.alias("body")
    )
    groups = stored(_combined(rows, salts).drop("body"))
    shared = groups.groupBy("digest").count().where("count > 1").select("digest")
    if shared.isEmpty():
        found = rows.drop("body").join(groups, "digest")
    else:
        alone = groups.join(shared, "digest", "left_anti")
        doubtful = rows.join(shared, "digest", "left_semi")
        found = rows.drop("body").join(alone, "digest")
        found = found.unionByName(
            doubtful.join(_combined(doubtful, salts), ["digest", "body"]).drop("body")
        )
    return found.select(
        shown_id("doc").alias("doc_id"),
        shown_id("keep").alias("keep_id"),
        "group_size",
        (F.col("doc") == F.col("keep")).alias("kept"),
        "digest",
    )


def drop_copies(documents: DataFrame, salts: int = SALTS) -> DataFrame:
    """One document of each group of equal texts, with all its columns: the largest doc_id.

    The other columns of the winner travel with its group, so that the texts need not be
    joined again. Of rows equal in doc_id and text one is kept, whatever else they hold.
    """
    text = text_of(documents)
    others = [documents[name] for name in documents.columns if name != "text"]
    salted = documents.select(
        sha256(text).alias("digest"),
        (F.spark_partition_id() % salts).alias("salt"),
        text.alias("body"),
        id_of(documents).alias("doc"),
        F.struct(documents["text"].isNull().alias("missing"), F.struct(*others).alias("rest")).alias("row"),
    )
    winners = salted.groupBy("digest", "salt", "body").agg(
        F.max_by("row", "doc").alias("row"), F.max("doc").alias("doc")
    )
    winners = winners.groupBy("digest", "body").agg(F.max_by("row", "doc").alias("row"))
    return winners.select(
        *(
            F.when(~F.col("row.missing"), F.col("body")).alias(name)
            if name == "text"
            else F.col("row.rest").getField(name).alias(name)
            for name in documents.columns
        )
    )
