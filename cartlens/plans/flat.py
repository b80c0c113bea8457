"""The four flat tables of the batch job and its summaries.

Their definitions differ on purpose from the layered models: weekdays start on
Monday, durations have fractions, conversion is purchases per session, a zero
denominator counts as one, and groups with a null key are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions.dates import seconds_elapsed, weekday_from_monday
from cartlens.functions.metrics import count_type, per_at_least_one, rate
from cartlens.operators.rollup import Measure, least, most, rollup, rollup_by, row_count, total


def flat_events(events: DataFrame) -> DataFrame:
    """All event columns with date parts."""
    weekday = weekday_from_monday("timestamp")
    return events.withColumns(
        {
            "event_date": F.to_date("timestamp"),
            "event_hour": F.hour("timestamp"),
            "day_of_week": weekday,
            "is_weekend": weekday.isin(5, 6),
        }
    )


def _type_counts() -> list[Column]:
    return [
        count_type("page_view").alias("page_views"),
        count_type("product_view").alias("product_views"),
        count_type("add_to_cart").alias("add_to_carts"),
        count_type("purchase").alias("purchases"),
    ]


def _type_measures() -> dict[str, Measure]:
    kind = F.col("event_type")
    return {
        "page_views": row_count(kind == "page_view"),
        "product_views": row_count(kind == "product_view"),
        "add_to_carts": row_count(kind == "add_to_cart"),
        "purchases": row_count(kind == "purchase"),
    }


def _first_known(column: str) -> Column:
    """First non-null value by time, then event id."""
    order = F.when(F.col(column).isNotNull(), F.struct("timestamp", "event_id"))
    return F.min_by(column, order)


def flat_sessions(events: DataFrame) -> DataFrame:
    """One row per session and user, whatever its length."""
    keyed = events.filter(F.col("session_id").isNotNull() & F.col("user_id").isNotNull())
    return (
        keyed.groupBy("session_id", "user_id")
        .agg(
            F.min("timestamp").alias("session_start"),
            F.max("timestamp").alias("session_end"),
            F.count("event_id").alias("event_count"),
            *_type_counts(),
            F.sum("revenue").alias("total_revenue"),
            F.countDistinct("product_id").alias("unique_products"),
            _first_known("country").alias("countries"),
            _first_known("device").alias("devices"),
        )
        .withColumn("session_duration_seconds", seconds_elapsed("session_start", "session_end"))
        .withColumn("is_converted", F.col("purchases") > 0)
    )


def flat_daily_metrics(events: DataFrame) -> DataFrame:
    """One row per date; conversion is purchases per session."""
    dated = events.withColumn("event_date", F.to_date("timestamp")).filter(
        F.col("event_date").isNotNull()
    )
    return rollup(
        dated,
        ["event_date"],
        {
            "total_events": row_count(F.col("event_id").isNotNull()),
            **_type_measures(),
            "total_revenue": total("revenue"),
        },
        {"unique_users": ("user_id", None), "unique_sessions": ("session_id", None)},
    ).withColumns(
        {
            "conversion_rate": F.try_divide(
                F.col("purchases").cast("double"), F.col("unique_sessions")
            ),
            "avg_revenue_per_user": F.try_divide(
                F.col("total_revenue").cast("double"), F.col("unique_users")
            ),
        }
    )


def flat_product_performance(events: DataFrame) -> DataFrame:
    """One row per product and category; events without a category are left out."""
    known = events.filter(F.col("product_id").isNotNull() & F.col("category").isNotNull())
    return (
        known.groupBy("product_id", "category")
        .agg(
            count_type("product_view").alias("view_count"),
            count_type("add_to_cart").alias("cart_adds"),
            count_type("purchase").alias("purchases"),
            F.sum("revenue").alias("total_revenue"),
            F.countDistinct("user_id").alias("unique_viewers"),
        )
        .withColumn("cart_rate", per_at_least_one("cart_adds", "view_count"))
        .withColumn("purchase_rate", per_at_least_one("purchases", "view_count"))
    )


def metric_summary(events: DataFrame, event_column: str = "event_type") -> DataFrame:
    """Overall totals and rates, beside each event type and its number of events.

    Columns the table does not have leave their figures out or at 0; without event types the
    result is one row.
    """
    have = set(events.columns)
    measures = {"total_events": row_count()}
    if event_column in have:
        kind = F.col(event_column)
        measures |= {
            "_views": row_count(kind == "product_view"),
            "_carts": row_count(kind == "add_to_cart"),
            "_purchases": row_count(kind == "purchase"),
        }
    if "revenue" in have:
        paid = F.col("revenue") > 0
        measures |= {
            "total_revenue": total("revenue"),
            "_paid": total(F.when(paid, F.col("revenue").cast("double"))),
            "_payments": row_count(paid),
        }
    distinct = {"unique_users": "user_id", "unique_sessions": "session_id"}
    counted = {name: (column, None) for name, column in distinct.items() if column in have}
    if event_column in have:
        totals = rollup_by(events, event_column, measures, counted)
        totals = totals.withColumnsRenamed({event_column: "event_type", "count": "events"})
    else:
        totals = rollup(events, [], measures, counted)
    totals = totals.withColumns({name: F.lit(0) for name in distinct if name not in counted})
    if "revenue" in have:
        totals = totals.withColumn("avg_order_value", rate("_paid", "_payments"))
    if event_column in have:
        totals = totals.withColumns(
            {
                "view_to_cart_rate": rate("_carts", "_views"),
                "cart_to_purchase_rate": rate("_purchases", "_carts"),
                "overall_conversion_rate": rate("_purchases", "_views"),
            }
        )
    return totals.drop("_views", "_carts", "_purchases", "_paid", "_payments")


def _counts(df: DataFrame, column: str) -> DataFrame:
    known = df.filter(F.col(column).isNotNull())
    return known.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Number of rows per non-null value, most frequent first."""
    return _counts(df, column).orderBy(F.desc("count"), column)


def event_profile(events: DataFrame) -> DataFrame:
    """Event types with share, next to the totals of the whole data set."""
    totals = rollup_by(
        events,
        "event_type",
        {
            "total_events": row_count(),
            "first_event": least("timestamp"),
            "last_event": most("timestamp"),
            "total_revenue": total("revenue"),
        },
        {"unique_users": ("user_id", None), "unique_sessions": ("session_id", None)},
    )
    return totals.withColumn("percent", F.col("count") * 100.0 / F.col("total_events")).orderBy(
        F.desc("count"), "event_type"
    )
