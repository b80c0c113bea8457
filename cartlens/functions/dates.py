"""Date and time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def literal_like(df: DataFrame, column: str, moment: dt.datetime) -> Column:
    """``moment`` in the type of ``column``, so that the column itself stays uncast
    and the comparison can be pushed down to the file reader."""
    return moment_of(moment).cast(df.schema[column].dataType)


def moment_of(moment: dt.datetime) -> Column:
    """Zone-free timestamp literal."""
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def day(moment: dt.date | dt.datetime) -> Column:
    return F.lit(moment.strftime("%Y-%m-%d")).cast("date")


def seconds_crossed(start: Column | str, end: Column | str) -> Column:
    """Second boundaries between two moments (not elapsed full seconds)."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def seconds_elapsed(start: Column | str, end: Column | str) -> Column:
    """Elapsed time in seconds with fractions."""

    def micros(moment: Column | str) -> Column:
        column = F.col(moment) if isinstance(moment, str) else moment
        return F.unix_micros(column.cast("timestamp"))

    return (micros(end) - micros(start)).cast("double") / F.lit(1e6)


def days_crossed(start: Column | str, end: Column) -> Column:
    """Midnights between two moments."""
    return F.datediff(F.to_date(end), F.to_date(start))


def weekday_from_sunday(date: Column | str) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(date) - 1


def weekday_from_monday(date: Column | str) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(date)
