"""Marts that follow new events: only the dates that events arrived for are computed again.

A store is a folder with the events in a folder per day, and for each mart a base table with the
figures that depend on a single day, in a folder per day too. New events are added to their days;
these days of the bases are replaced by dynamic partition overwrite, reading the events of these
days only. What looks across days (rolling, lagged and cumulative columns) is a plan over the
bases, which have a row per day, or per day and category.

A session may go on over midnight, so its figures do not depend on a single day. Its base has a row per
day, session and user (``session_days``). New days change only sessions that have events on
them; those whose other days alone are too long a session never counted and do not start to. What
is left gives the dates to compute again, from the sessions that have a row on these dates. That reads the
narrow rows of all days, not the events.

One writer at a time. A refresh that fails is repeated as a whole: a batch is written again under its
name, and replacing a day again gives the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.functions.dates import seconds_crossed
from cartlens.plans import facts, intermediate, staging
from cartlens.schemas import MAX_SESSION_HOURS

#: Base tables and how they follow from the staged events of some days.
BASES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "daily_funnel": lambda staged: facts.daily_funnel(intermediate.int_user_journey(staged)),
    "daily_category_revenue": facts.daily_category_revenue,
    "daily_activity": facts.daily_events,
    "session_days": intermediate.session_days,
}


def _days(df: DataFrame, column: str) -> list[dt.date]:
    """The different dates, in order: a row per day."""
    return [row[0] for row in df.select(column).distinct().orderBy(column).collect()]


def add_events(spark: SparkSession, store: str, events: DataFrame, batch: str) -> list[dt.date]:
    """Add a batch of raw events to their days; returns these days.

    ``batch`` names the batch: one that is in the store already is written again, not added twice.
    """
    dated = events.withColumns({"batch": F.lit(batch), "event_date": F.to_date("timestamp")})
    (
        dated.hint("rebalance", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "batch")
        .parquet(f"{store}/events")
    )
    known = spark.read.parquet(f"{store}/events")
    return _days(known.filter(F.col("batch") == batch).filter("event_date is not null"), "event_date")


def _replace_days(df: DataFrame, path: str, column: str) -> None:
    (
        df.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def refresh(
    spark: SparkSession, store: str, days: list[dt.date], as_of: dt.datetime, bases: Collection[str] = tuple(BASES)
) -> None:
    """Compute these days of the bases again from the events of the store.

    A store that keeps only some marts names their bases, the same ones each time.
    """
    if not days:
        return
    events = spark.read.parquet(f"{store}/events")
    # literals, so that the folders of other days are not listed for reading
    touched = events.filter(F.col("event_date").isin(days)).drop("event_date", "batch")
    staged = staging.stg_events(touched, as_of)
    for name in bases:
        _replace_days(BASES[name](staged), f"{store}/{name}", "event_date")
    if "session_days" in bases:
        _refresh_sessions(spark, store, days)


def _of_sessions(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of the sessions and users in ``wanted``; a missing session is one like any other."""
    keys = wanted.select(F.col("session_id").alias("_session"), F.col("user_id").alias("_user")).distinct()
    same = F.col("session_id").eqNullSafe(F.col("_session")) & (F.col("user_id") == F.col("_user"))
    return rows.join(keys, same, "left_semi")


def sessions_to_date_again(rows: DataFrame, days: list[dt.date]) -> list[dt.date]:
    """The dates on which a session may have begun, or may begin now, that has events on ``days``."""
    new = F.col("event_date").isin(days)
    others = _of_sessions(rows.filter(~new), rows.filter(new))
    short = (
        others.groupBy("session_id", "user_id")
        .agg(F.min("session_start").alias("start"), F.max("session_end").alias("end"))
        .filter(seconds_crossed("start", "end") <= MAX_SESSION_HOURS * 3600)
    )
    both = short.select(F.explode(F.array(F.to_date("start"), F.to_date("end"))).alias("event_date"))
    return sorted({*days, *_days(both, "event_date")})


def _refresh_sessions(spark: SparkSession, store: str, days: list[dt.date]) -> None:
    rows = spark.read.parquet(f"{store}/session_days")
    dates = sessions_to_date_again(rows, days)
    seen = rows.filter(F.col("event_date").isin(dates))
    begun = intermediate.sessions_of_days(_of_sessions(rows, seen)).filter(F.col("session_date").isin(dates))
    # a date on which no session begins any more gets a row too, in place of the one it had
    every = spark.createDataFrame([(date,) for date in dates], "session_date date")
    _replace_days(every.join(facts.daily_sessions(begun), "session_date", "left"), f"{store}/daily_sessions", "session_date")


def engagement_mart(spark: SparkSession, store: str, as_of: dt.datetime) -> DataFrame:
    """``facts.fct_daily_engagement`` of all events of the store."""
    activity, sessions = (spark.read.parquet(f"{store}/{name}") for name in ("daily_activity", "daily_sessions"))
    return facts.engagement_over_days(activity, sessions, as_of)


def funnel_mart(spark: SparkSession, store: str, as_of: dt.datetime) -> DataFrame:
    """``facts.fct_funnel`` of all events of the store."""
    return facts.funnel_over_days(spark.read.parquet(f"{store}/daily_funnel"), as_of)


def revenue_mart(spark: SparkSession, store: str, stg_products: DataFrame, as_of: dt.datetime) -> DataFrame:
    """``facts.fct_revenue`` of all events of the store."""
    return facts.revenue_over_days(spark.read.parquet(f"{store}/daily_category_revenue"), stg_products, as_of)
