"""Queries over the flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.functions.metrics import per_at_least_one, rate
from cartlens.plans.flat import value_counts


def kpi_latest(daily_metrics: DataFrame) -> DataFrame:
    """Latest day with the change against the row before; the change is null when
    there is no earlier row or its value is not positive."""
    by_date = Window.orderBy("event_date")

    def change(column: str) -> Column:
        before = F.lag(column).over(by_date).cast("double")
        return F.when(before > 0, (F.col(column).cast("double") - before) / before)

    return (
        daily_metrics.select(
            "event_date",
            "unique_users",
            change("unique_users").alias("unique_users_change"),
            "unique_sessions",
            change("unique_sessions").alias("unique_sessions_change"),
            "total_revenue",
            change("total_revenue").alias("total_revenue_change"),
            rate("purchases", "unique_sessions").alias("conversion_rate"),
        )
        .orderBy(F.desc("event_date"))
        .limit(1)
    )


def trend(daily_metrics: DataFrame, days: int | None = None) -> DataFrame:
    """Daily series up to ``days`` before the last date (``days + 1`` dates)."""
    series = daily_metrics
    if days is not None:
        last = daily_metrics.agg(F.max("event_date").alias("last")).scalar()
        series = series.filter(F.col("event_date") >= F.date_sub(last, days))
    return series.select(
        "event_date",
        "unique_users",
        "unique_sessions",
        "total_revenue",
        per_at_least_one("purchases", "unique_sessions").alias("conversion_rate"),
    ).orderBy("event_date")


def funnel_overall(daily_metrics: DataFrame) -> DataFrame:
    """Five stages with their share of the first and of the previous stage.

    Checkouts fall back to purchases where the daily table does not count them.
    """
    checkout = "checkout_starts" if "checkout_starts" in daily_metrics.columns else "purchases"
    # Stage labels in order.
    stages = {
        "Page Views": "page_views",
        "Product Views": "product_views",
        "Add to Cart": "add_to_carts",
        "Checkout": checkout,
        "Purchase": "purchases",
    }
    sums = daily_metrics.agg(
        *[F.sum(column).alias(f"s{i}") for i, column in enumerate(stages.values())]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(label).alias("stage"),
                F.col(f"s{i}").alias("count"),
                _share(f"s{i}", "s0").alias("conversion_rate"),
                (_share(f"s{i}", f"s{i - 1}") if i else F.lit(None).cast("double")).alias(
                    "step_rate"
                ),
            )
            for i, label in enumerate(stages)
        ]
    )
    return sums.select(F.inline(rows))


def _share(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def top_products(product_performance: DataFrame, k: int = 10) -> DataFrame:
    """The k products with the highest revenue."""
    return (
        product_performance.select("product_id", "category", "total_revenue", "purchases")
        .orderBy(F.desc("total_revenue"), "product_id", "category")
        .limit(k)
    )


def category_conversion(product_performance: DataFrame, k: int = 10) -> DataFrame:
    """The k categories with the highest purchases per view."""
    return (
        product_performance.groupBy("category")
        .agg(F.sum("view_count").alias("view_count"), F.sum("purchases").alias("purchases"))
        .withColumn("conversion_rate", per_at_least_one("purchases", "view_count"))
        .orderBy(F.desc("conversion_rate"), "category")
        .limit(k)
    )


def duration_histogram(sessions: DataFrame, limit: int = 3600, bins: int = 50) -> DataFrame:
    """Sessions shorter than ``limit`` seconds in equal bins."""
    width = limit / bins
    duration = F.col("session_duration_seconds")
    return (
        sessions.filter(duration < limit)
        .groupBy(F.floor(duration / width).alias("bin"))
        .agg(F.count(F.lit(1)).alias("sessions"))
        .select("bin", (F.col("bin") * width).alias("bin_start"), "sessions")
        .orderBy("bin")
    )


def sessions_by_device(sessions: DataFrame) -> DataFrame:
    return value_counts(sessions, "devices")


def sessions_by_quality(sessions: DataFrame) -> DataFrame:
    """Empty when the session table has no quality column."""
    if "session_quality" not in sessions.columns:
        sessions = sessions.limit(0).withColumn("session_quality", F.lit(None).cast("string"))
    return value_counts(sessions, "session_quality")


def events_by_source(events: DataFrame) -> DataFrame:
    return value_counts(events, "traffic_source")


def revenue_by_source(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("traffic_source").isNotNull())
        .groupBy("traffic_source")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy("traffic_source")
    )
