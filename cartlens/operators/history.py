"""Dimensions with history: versions of a record and the times they were valid."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions.dates import moment_of

FROM, TO, VERSION = "valid_from", "valid_to", "version"


def first_version(snapshot: DataFrame, key: str, at: dt.datetime) -> DataFrame:
    """A dimension with history of one snapshot: every record is valid from then on.

    ``key`` must be unique in a snapshot and not null.
    """
    return snapshot.select(
        "*",
        F.lit(1).alias(VERSION),
        moment_of(at).alias(FROM),
        F.lit(None).cast("timestamp_ntz").alias(TO),
    )


def _same(columns: list[str], left: str, right: str) -> Column:
    """All columns equal; nulls equal each other."""
    same = F.lit(True)
    for column in columns:
        same = same & F.col(f"{left}.{column}").eqNullSafe(F.col(f"{right}.{column}"))
    return same


def with_snapshot(history: DataFrame, snapshot: DataFrame, key: str, at: dt.datetime) -> DataFrame:
    """The history after a later snapshot.

    A record that differs from its current version ends there and gets a new one, a record that is
    absent ends, a new one begins, and one that comes back begins again with the next version
    number. Ended versions are not touched: only current ones meet the snapshot, by one join on the
    key. ``at`` must lie after everything in the history.
    """
    now = moment_of(at)
    attributes = [column for column in snapshot.columns if column != key]
    names = [key, *attributes]
    latest = history.groupBy(F.col(key).alias("_key")).agg(F.max(VERSION).alias("_last"))
    current = history.filter(F.col(TO).isNull())
    old = current.select(F.col(key).alias("_key"), F.struct(*names, VERSION, FROM).alias("old"))
    new = snapshot.select(F.col(key).alias("_key"), F.struct(*names).alias("new"))
    met = old.join(new, "_key", "full").join(latest, "_key", "left")
    kept = F.col("old").isNotNull() & F.col("new").isNotNull() & _same(attributes, "old", "new")

    def version(source: str, number: Column, since: Column, until: Column) -> Column:
        values = [F.col(f"{source}.{column}").alias(column) for column in names]
        return F.struct(*values, number.cast("int").alias(VERSION), since.alias(FROM), until.alias(TO))

    open_ = F.lit(None).cast("timestamp_ntz")
    before = version("old", F.col("old.version"), F.col("old.valid_from"), F.when(kept, open_).otherwise(now))
    after = version("new", F.coalesce("_last", F.lit(0)) + 1, now, open_)
    versions = F.filter(
        F.array(
            F.when(F.col("old").isNotNull(), before),
            F.when(F.col("new").isNotNull() & ~F.coalesce(kept, F.lit(False)), after),
        ),
        lambda one: one.isNotNull(),
    )
    ended = history.filter(F.col(TO).isNotNull())
    return ended.select(*names, VERSION, FROM, TO).unionByName(met.select(F.inline(versions)))


def as_of_join(facts: DataFrame, history: DataFrame, key: str, moment: str, columns: list[str]) -> DataFrame:
    """Facts with the columns of the version that was valid at their time; nulls if none was.

    Versions do not overlap, so no fact is multiplied; Spark joins on the key and tests the times
    there, and splits keys with many facts.
    """
    versions = history.select(
        F.col(key).alias("_key"), F.struct(*columns).alias("_version"), F.col(FROM).alias("_from"), F.col(TO).alias("_to")
    )
    time = F.col(moment).cast("timestamp_ntz")
    valid = (F.col(key) == F.col("_key")) & (time >= F.col("_from")) & (F.col("_to").isNull() | (time < F.col("_to")))
    joined = facts.join(versions, valid, "left")
    return joined.select(*facts.columns, *[F.col(f"_version.{column}").alias(column) for column in columns])
