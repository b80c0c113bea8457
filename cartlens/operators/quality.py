"""Table-level quality checks; each returns its issues as rows, none when clean."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlens.functions.dates import literal_like
from cartlens.schemas import MAX_NULL_RATE, MAX_REVENUE_Z, MAX_SESSION_EVENTS

SEVERITIES = ["high", "medium", "low"]


def _row(
    check: str,
    severity: str,
    message: Column,
    column: Column | None = None,
    count: Column | None = None,
    rate: Column | None = None,
    max_value: Column | None = None,
) -> Column:
    def given(value: Column | None, dtype: str) -> Column:
        return (F.lit(None) if value is None else value).cast(dtype)

    return F.struct(
        F.lit(check).alias("check"),
        F.lit(severity).alias("severity"),
        given(column, "string").alias("column"),
        given(count, "bigint").alias("count"),
        given(rate, "double").alias("null_rate"),
        given(max_value, "double").alias("max_value"),
        message.alias("message"),
    )


def _found(count: Column, what: str) -> Column:
    return F.concat(F.lit("Found "), count.cast("string"), F.lit(f" {what}"))


def _where(condition: Column, row: Column) -> Column:
    """An array of the row, empty unless the condition holds."""
    return F.filter(F.array(row), lambda _: F.coalesce(condition, F.lit(False)))


def _listed(source: DataFrame, *rows: Column) -> DataFrame:
    """The issues in arrays of one row."""
    return source.select(F.inline(F.concat(*rows)))


def duplicate_ids(events: DataFrame) -> DataFrame:
    """Event ids used more than once; counts every copy."""
    copies = events.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))
    found = copies.filter(F.col("copies") > 1).agg(F.sum("copies").alias("n"))
    n = F.col("n")
    return _listed(found, _where(n > 0, _row("duplicates", "high", _found(n, "duplicate event IDs"), count=n)))


def _missing(df: DataFrame, column: str) -> Column:
    quoted = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return quoted.isNull() | F.isnan(quoted)
    return quoted.isNull()


def _counted_nulls(df: DataFrame) -> Column:
    """An array of (name, missing) over the columns, as an aggregate."""
    pairs = [
        F.struct(F.lit(name).alias("name"), F.count_if(_missing(df, name)).alias("missing"))
        for name in df.columns
    ]
    return F.array(*pairs) if pairs else F.array().cast("array<struct<name:string,missing:bigint>>")


def _null_rows(counts: Column, total: Column, threshold: float) -> Column:
    def issue(x: Column) -> Column:
        rate = F.try_divide(x["missing"].cast("double"), total)
        percent = F.format_number(rate * 100, 1)
        message = F.concat(F.lit("Column '"), x["name"], F.lit("' has "), percent, F.lit("% null values"))
        return _row("null_rate", "medium", message, column=x["name"], rate=rate)

    return F.filter(F.transform(counts, issue), lambda x: x["null_rate"] > threshold)


def null_rates(df: DataFrame, threshold: float = MAX_NULL_RATE) -> DataFrame:
    """Columns whose share of missing values is above ``threshold``; one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), _counted_nulls(df).alias("counts"))
    return _listed(counted, _null_rows(F.col("counts"), F.col("n"), threshold))


def _positive() -> Column:
    amount = F.col("revenue").cast("double")
    return F.when((amount > 0) & ~F.isnan(amount), amount)


def _moments() -> Column:
    return F.struct(F.avg(_positive()).alias("mean"), F.stddev_samp(_positive()).alias("deviation"))


def _outliers(events: DataFrame, moments: Column, z_threshold: float) -> DataFrame:
    """One row: number n and the largest, top."""
    distance = F.abs(_positive() - moments["mean"]) / moments["deviation"]
    outlying = events.filter((moments["deviation"] > 0) & (distance > z_threshold))
    return outlying.agg(F.count(F.lit(1)).alias("n"), F.max(_positive()).alias("top"))


def _outlier_rows() -> Column:
    n, top = F.col("n"), F.col("top")
    issue = _row("revenue_outliers", "low", _found(n, "revenue outliers"), count=n, max_value=top)
    return _where(n > 0, issue)


def revenue_outliers(events: DataFrame, z_threshold: float = MAX_REVENUE_Z) -> DataFrame:
    """Positive revenues more than ``z_threshold`` sample deviations from their mean."""
    moments = events.agg(_moments().alias("moments")).scalar()
    return _listed(_outliers(events, moments, z_threshold), _outlier_rows())


def _counted_late(events: DataFrame, as_of: dt.datetime) -> Column:
    return F.count_if(F.col("timestamp") > literal_like(events, "timestamp", as_of))


def _late_rows(n: Column) -> Column:
    return _where(n > 0, _row("future_timestamps", "high", _found(n, "events with future timestamps"), count=n))


def future_timestamps(events: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Events later than ``as_of``."""
    return _listed(events.agg(_counted_late(events, as_of).alias("n")), _late_rows(F.col("n")))


def crowded_sessions(events: DataFrame, max_events: int = MAX_SESSION_EVENTS) -> DataFrame:
    """Sessions with more than ``max_events`` events; counts sessions."""
    found = (
        events.filter(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(F.count(F.lit(1)).alias("events"))
        .filter(F.col("events") > max_events)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n = F.col("n")
    message = _found(n, f"sessions with >{max_events} events")
    return _listed(found, _where(n > 0, _row("session_integrity", "medium", message, count=n)))


TOTALS = "totals"


def _with_totals(events: DataFrame, as_of: dt.datetime) -> DataFrame:
    """All issues, and a row ``totals`` with the number of events.

    Four scans: one for everything that is counted per row, one for the outliers, which need
    the first one's moments, and a grouping each by event and by session.
    """
    counted = F.struct(
        F.count(F.lit(1)).alias("total"),
        _counted_nulls(events).alias("nulls"),
        _counted_late(events, as_of).alias("late"),
        _moments().alias("moments"),
    )
    # a single struct, so that all its uses are one and the same sub-query
    profile = events.agg(counted.alias("profile")).scalar()
    outliers = _outliers(events, profile["moments"], MAX_REVENUE_Z)
    total = F.col("profile.total")
    per_row = _listed(
        outliers.withColumn("profile", profile),
        F.array(_row(TOTALS, "all", F.lit(""), count=total)),
        _null_rows(F.col("profile.nulls"), total, MAX_NULL_RATE),
        _outlier_rows(),
        _late_rows(F.col("profile.late")),
    )
    return per_row.unionByName(duplicate_ids(events)).unionByName(crowded_sessions(events))


def all_issues(events: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The issues of all checks."""
    return _with_totals(events, as_of).filter(F.col("check") != TOTALS)


def high_severity(issues: DataFrame) -> DataFrame:
    return issues.filter(F.col("severity") == "high")


def report(events: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Totals first, then the issues of all checks by severity; nothing runs before it is read.

    The window goes over the issues, a row per check and column at most.
    """
    found = _with_totals(events, as_of)
    is_total = F.col("check") == TOTALS
    issues = F.count_if(~is_total).over(Window.partitionBy(F.lit(0)))
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity"))
    totals = F.concat(
        F.lit("Total records: "),
        F.format_number("count", 0),
        F.lit(", issues found: "),
        issues.cast("string"),
    )
    return found.select(
        rank.cast("bigint").alias("rank"),
        "severity",
        "check",
        F.when(is_total, totals).otherwise(F.col("message")).alias("message"),
    ).orderBy("rank", "check", "message")
