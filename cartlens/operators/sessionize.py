"""Sessions by inactivity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.functions.values import hash_key
from cartlens.schemas import SESSION_TIMEOUT_MINUTES


def _slice(time: str, minutes: int) -> Column:
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    return F.floor(micros / F.lit(minutes * 60_000_000).cast("bigint")).cast("bigint")


def session_slices(
    events: DataFrame,
    user: str = "user_id",
    time: str = "timestamp",
    minutes: int = SESSION_TIMEOUT_MINUTES,
) -> DataFrame:
    """One row per user and time slice with the session the slice belongs to.

    Two events of a user share a session iff the gap is shorter than ``minutes``.
    Inside a slice of exactly that width every gap is shorter, so a slice never
    holds a session break and its first and last moment are all that matters. The
    window therefore sees at most 48 slices per user and day, however many events
    one user has; the events themselves are only pre-aggregated.
    """
    slices = (
        events.filter(F.col(user).isNotNull() & F.col(time).isNotNull())
        .groupBy(F.col(user), _slice(time, minutes).alias("slice"))
        .agg(
            F.min(time).alias("slice_start"),
            F.max(time).alias("slice_end"),
            F.count(F.lit(1)).alias("slice_events"),
        )
    )
    by_user = Window.partitionBy(user).orderBy("slice")
    so_far = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gap = F.unix_micros(F.col("slice_start").cast("timestamp")) - F.unix_micros(
        F.lag("slice_end").over(by_user).cast("timestamp")
    )
    opens = F.coalesce(gap >= minutes * 60_000_000, F.lit(True))
    return (
        slices.withColumn("opens", opens)
        .withColumn("session_number", F.count_if("opens").over(so_far))
        .withColumn("session_start", F.max(F.when(F.col("opens"), F.col("slice_start"))).over(so_far))
        .drop("opens")
    )


def _session_id(user: str) -> Column:
    start = F.date_format("session_start", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.concat(F.lit("SES_"), hash_key(F.concat(F.col(user), F.lit("@"), start), 16))


def gap_sessions(
    events: DataFrame,
    user: str = "user_id",
    time: str = "timestamp",
    minutes: int = SESSION_TIMEOUT_MINUTES,
) -> DataFrame:
    """One row per inactivity session: id, bounds and number of events."""
    return (
        session_slices(events, user, time, minutes)
        .groupBy(user, "session_number", "session_start")
        .agg(
            F.max("slice_end").alias("session_end"),
            F.sum("slice_events").alias("event_count"),
        )
        .withColumn("session_id", _session_id(user))
    )


def with_gap_sessions(
    events: DataFrame,
    user: str = "user_id",
    time: str = "timestamp",
    minutes: int = SESSION_TIMEOUT_MINUTES,
    name: str = "session_id",
) -> DataFrame:
    """Events with the id of their inactivity session.

    The slice side of the join is unique, so adaptive skew handling may split the
    event side of a hot slice.
    """
    slices = session_slices(events, user, time, minutes).select(
        F.col(user).alias("_user"), F.col("slice").alias("_slice"), _session_id(user).alias("_id")
    )
    sliced = events.drop(name).withColumn("_at", _slice(time, minutes))
    return sliced.join(
        slices, (F.col(user) == F.col("_user")) & (F.col("_at") == F.col("_slice")), "left"
    ).select(*[c for c in events.columns if c != name], F.col("_id").alias(name))
