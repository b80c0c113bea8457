"""Near-duplicates by fingerprints, found with meet-in-the-middle balls.

Two fingerprints at most ``RADIUS`` bits apart meet in a variant at most half as many bits
from either. So every distinct fingerprint emits itself and its 64 neighbours, and rows are
grouped by variant: a group is the set of bits by which its members differ from the variant,
one long and a flag, which combine before the shuffle and hold at most 65 members. The
members of a group are at most ``RADIUS`` bits apart, so linking all to the smallest, after
verifying the pair, connects them without listing all pairs. Components come from rounds of
large-star and small-star steps, each written to the shared folder.

Cases: a null text is empty and has fingerprint zero, linked like any other; a null doc_id
belongs to its component but never names it unless no member has an id; repeated rows get
equal results. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import id_of, shown_id, stored, text_of

SHINGLE = 3
SEED = 42
RADIUS = 2
CHUNK = 4096


def shingles(text: bytes, size: int = SHINGLE) -> list[bytes]:
    """Space-joined runs of ``size`` words with A-Z lower-cased, repeats included."""
    words = text.lower().split()
    if not words:
        return []
    if len(words) <= size:
        return [b" ".join(words)]
    return [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Bits set in over half of the shingles' hashes."""
    hashed = xxhash.xxh64_intdigest
    values = np.array([hashed(x, SEED) for x in shingles(text, size)], np.uint64)
    if not len(values):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(values), CHUNK):
        chunk = values[i : i + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(chunk, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(values)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Columns doc (doc_id or ``NO_ID``), tag (hash of the text), fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(x.as_py(), size) for x in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(marks.view(np.int64))],
                ["doc", "tag", "fingerprint"],
            )

    text = text_of(documents)
    rows = documents.select(
        id_of(documents).alias("doc"), F.xxhash64(text).alias("tag"), text.cast("binary").alias("text")
    )
    return rows.mapInArrow(run, "doc long, tag long, fingerprint long")


def _bit(j: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), j)


def links(marks: DataFrame) -> DataFrame:
    """Edges (u, v) that connect all fingerprints at most ``RADIUS`` bits apart.

    ``marks`` holds distinct fingerprints.
    """
    variants = marks.select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("j")).select(
        F.when(F.col("j") == 64, F.col("fingerprint"))
        .otherwise(F.col("fingerprint").bitwiseXOR(_bit(F.col("j"))))
        .alias("variant"),
        F.when(F.col("j") < 64, _bit(F.col("j"))).otherwise(F.lit(0).cast("long")).alias("bit"),
        (F.col("j") == 64).alias("centre"),
    )
    balls = (
        variants.groupBy("variant")
        .agg(F.bit_or("bit").alias("bits"), F.max("centre").alias("centre"))
        .where(F.bit_count("bits") + F.col("centre").cast("int") > 1)
    )
    members = F.expr(
        "transform(filter(sequence(0, 64), j -> if(j = 64, centre, getbit(bits, j % 64) = 1)),"
        " j -> if(j = 64, variant, variant ^ shiftleft(1L, j)))"
    )
    stars = balls.select(members.alias("members"))
    pairs = stars.select(F.array_min("members").alias("u"), F.explode("members").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS
    return pairs.where((F.col("u") != F.col("v")) & near).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u != v").union(least.select("u", "m")).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """Each node of the edges with the smallest node of its component: (u, v)."""
    seen = None
    while True:
        edges = stored(_small_star(_large_star(edges)))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges
        seen = state


def keeper() -> Column:
    """Orders a component's rows (doc, tag); the smallest stays."""
    return F.struct(shown_id("doc").isNull().alias("nameless"), "doc", "tag")


def _classes(marked: DataFrame) -> DataFrame:
    """Each distinct fingerprint with its component: component_id and the document to keep."""
    shown = shown_id("doc")
    classes = stored(
        marked.groupBy("fingerprint").agg(F.min(shown).alias("component_id"), F.min(keeper()).alias("keeper"))
    )
    edges = stored(links(classes.select("fingerprint")))
    if edges.isEmpty():
        return classes
    tops = roots(edges).select(F.col("u").alias("fingerprint"), F.col("v").alias("top"))
    classes = classes.join(tops, "fingerprint", "left").withColumn("top", F.coalesce("top", "fingerprint"))
    named = classes.groupBy("top").agg(
        F.min("component_id").alias("component_id"), F.min("keeper").alias("keeper")
    )
    return classes.select("fingerprint", "top").join(named, "top").drop("top")


def components(documents: DataFrame) -> DataFrame:
    """Columns doc_id, fingerprint (16 hex digits), component_id."""
    marked = stored(fingerprints(documents))
    return marked.join(_classes(marked).drop("keeper"), "fingerprint").select(
        shown_id("doc").alias("doc_id"),
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(documents: DataFrame) -> DataFrame:
    """One document of each component with all its columns: the one whose id names it.

    Of a component without any id, the document with the smallest hash of its text stays; of
    rows equal in doc_id and text one stays, whatever else they hold.
    """
    marked = stored(fingerprints(documents))
    return chosen(documents, marked, _classes(marked))


def chosen(documents: DataFrame, marked: DataFrame, keepers: DataFrame) -> DataFrame:
    """The documents that a column ``keeper`` names; ``marked`` has the doc and tag of all."""
    kept = keepers.select("keeper.doc", "keeper.tag").distinct()
    kept = kept.select(F.col("doc").alias("_kept_doc"), F.col("tag").alias("_kept_tag"))
    doc, tag = id_of(documents), F.xxhash64(text_of(documents))
    rows = documents.join(kept, (doc == kept["_kept_doc"]) & (tag == kept["_kept_tag"]), "left_semi")
    if marked.groupBy("doc", "tag").count().where("count > 1").isEmpty():
        return rows
    return rows.dropDuplicates(["doc_id", "text"])
