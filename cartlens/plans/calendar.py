"""Calendar tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.functions.dates import day, weekday_from_monday, weekday_from_sunday
from cartlens.schemas import CALENDAR_DAYS_AHEAD, CALENDAR_START


def days_between(bounds: DataFrame, name: str = "date") -> DataFrame:
    """One row per day from ``first`` to ``last``, both included.

    ``bounds`` has one row; it may come from an aggregate over a table.
    """
    span = F.sequence(F.to_date("first"), F.to_date("last"), F.expr("interval 1 day"))
    ordered = F.col("last") >= F.col("first")
    return bounds.select(F.explode(F.when(ordered, span)).alias(name))


def date_range(
    spark: SparkSession,
    start: dt.date,
    end: dt.date | None = None,
    days: int | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Days from ``start`` to ``end``; without an end to ``start + days`` (that is
    ``days + 1`` rows); without both to ``as_of``."""
    if end is None:
        end = start + dt.timedelta(days=days) if days is not None else as_of
    if end is None:
        raise ValueError("one of end, days and as_of is needed")
    return days_between(spark.range(1).select(day(start).alias("first"), day(end).alias("last")))


def calendar_bounds(spark: SparkSession, as_of: dt.datetime) -> DataFrame:
    """Default range: a fixed start up to the days ahead of ``as_of``, end excluded."""
    return spark.range(1).select(
        F.lit(CALENDAR_START).cast("date").alias("first"),
        F.date_add(day(as_of), CALENDAR_DAYS_AHEAD - 1).alias("last"),
    )


def _period_end(date: Column, unit: str, months: int) -> Column:
    return F.date_sub(F.add_months(F.trunc(date, unit), months), 1)


def dim_date(bounds: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Calendar with weeks from Monday, day_of_week from Sunday = 0."""
    d, today = F.col("date_key"), day(as_of)
    weekday = weekday_from_sunday(d)
    weekend = weekday.isin(0, 6)

    def recent(days: int) -> Column:
        return d.between(F.date_sub(today, days), F.date_sub(today, 1))

    week_start = F.trunc(d, "week")
    return days_between(bounds, "date_key").select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofyear(d).alias("day_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_short"),
        F.date_format(d, "yyyy-MM-dd").alias("date_iso"),
        F.date_format(d, "yyyyMMdd").alias("date_int"),
        F.date_format(d, "MM/dd/yyyy").alias("date_us"),
        F.date_format(d, "dd.MM.yyyy").alias("date_eu"),
        F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
        week_start.alias("week_start"),
        F.date_add(week_start, 6).alias("week_end"),
        F.trunc(d, "month").alias("month_start"),
        F.last_day(d).alias("month_end"),
        F.trunc(d, "quarter").alias("quarter_start"),
        _period_end(d, "quarter", 3).alias("quarter_end"),
        F.trunc(d, "year").alias("year_start"),
        _period_end(d, "year", 12).alias("year_end"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        (d == F.trunc(d, "month")).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
        (d == F.trunc(d, "year")).alias("is_year_start"),
        (d == _period_end(d, "year", 12)).alias("is_year_end"),
        (d == today).alias("is_today"),
        (d == F.date_sub(today, 1)).alias("is_yesterday"),
        recent(7).alias("is_last_7_days"),
        recent(30).alias("is_last_30_days"),
        recent(90).alias("is_last_90_days"),
        F.date_sub(d, 7).alias("same_day_last_week"),
        F.add_months(d, -1).alias("same_day_last_month"),
        F.add_months(d, -12).alias("same_day_last_year"),
    )


def calendar_iso(bounds: DataFrame) -> DataFrame:
    """Calendar with an integer key and day_of_week from Monday = 0."""
    d = F.col("date")
    weekday = weekday_from_monday(d)
    return days_between(bounds, "date").select(
        d,
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekday.isin(5, 6).alias("is_weekend"),
        (d == F.trunc(d, "month")).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
    )
