"""Daily engagement, funnel and category revenue.

Windows without a partition run over one row per date only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cartlens.functions.dates import moment_of
from cartlens.functions.metrics import growth, rate
from cartlens.operators.rollup import Measure, least, most, rollup, row_count, total

# Output name and value of the device and source breakdowns.
DEVICE_BREAKDOWN = {"mobile": "mobile", "desktop": "desktop", "tablet": "tablet"}
SOURCE_BREAKDOWN = {
    "organic": "organic",
    "paid": "paid_search",
    "social": "social",
    "email": "email",
    "direct": "direct",
}


def _by_date() -> WindowSpec:
    return Window.orderBy("event_date")


def _by_category() -> WindowSpec:
    return Window.partitionBy("category").orderBy("event_date")


def _last(rows: int, window: WindowSpec) -> WindowSpec:
    """The current row and the ``rows - 1`` before it; rows, not days."""
    return window.rowsBetween(1 - rows, Window.currentRow)


def _mean(column: str, window: WindowSpec) -> Column:
    return F.avg(F.col(column).cast("double")).over(window)


def daily_events(stg_events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return rollup(
        stg_events,
        ["event_date"],
        {
            "total_events": row_count(),
            "page_views": row_count(kind == "page_view"),
            "product_views": row_count(kind == "product_view"),
            "searches": row_count(kind == "search"),
            "add_to_cart_events": row_count(kind == "add_to_cart"),
            "checkout_starts": row_count(kind == "begin_checkout"),
            "purchases": row_count(kind == "purchase"),
            "signups": row_count(kind == "signup"),
            "logins": row_count(kind == "login"),
            "total_revenue": total("revenue_amount"),
            **{
                f"{name}_events": row_count(F.col("device_type") == value)
                for name, value in DEVICE_BREAKDOWN.items()
            },
            **{
                f"{name}_events": row_count(F.col("traffic_source") == value)
                for name, value in SOURCE_BREAKDOWN.items()
            },
        },
        {
            "daily_active_users": ("user_id", None),
            "total_sessions": ("session_id", None),
            "unique_products_viewed": ("product_id", None),
            "unique_categories_viewed": ("product_category", None),
        },
    )


def _means(columns: dict[str, str]) -> dict[str, Measure]:
    """Sums and counts from which ``_mean_of`` gets the mean of non-null values."""
    sums = {f"{name}_sum": total(column) for name, column in columns.items()}
    known = {
        f"{name}_known": total(F.when(F.col(column).isNotNull(), 1)) for name, column in columns.items()
    }
    return sums | known


def _mean_of(name: str) -> Column:
    return (F.col(f"{name}_sum").cast("double") / F.col(f"{name}_known")).alias(name)


def daily_sessions(int_sessions: DataFrame) -> DataFrame:
    """Sessions by the date they started on, in one pass over the sessions."""
    means = {
        "avg_session_duration": "session_duration_seconds",
        "avg_events_per_session": "total_events",
        "avg_engagement_score": "engagement_score",
    }
    counts = {
        "sessions": ("session_id", None),
        "converted_sessions": ("session_id", "converted"),
    }
    return rollup(
        int_sessions, ["session_date"], _means(means), counts, {"converted": F.col("is_converted")}
    ).select("session_date", *counts, *[_mean_of(name) for name in means])


def fct_daily_engagement(
    stg_events: DataFrame, int_sessions: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """One row per date with activity, rolling and period-over-period figures."""
    return engagement_over_days(daily_events(stg_events), daily_sessions(int_sessions), as_of)


def engagement_over_days(activity: DataFrame, sessions: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Daily engagement of ``daily_events`` and ``daily_sessions`` rows."""
    begun = sessions.drop("sessions")
    days = activity.join(begun, F.col("event_date") == F.col("session_date"), "left").drop("session_date")
    week = _last(7, _by_date())
    return (
        days.withColumns(
            {
                # null, not 0, on a date without any session start
                "conversion_rate": rate("converted_sessions", "total_sessions"),
                "avg_order_value": rate("total_revenue", "purchases"),
                "events_per_user": rate("total_events", "daily_active_users"),
                "revenue_per_user": rate("total_revenue", "daily_active_users"),
                "dau_7d_avg": _mean("daily_active_users", week),
                "revenue_7d_avg": _mean("total_revenue", week),
                "wau_approximation": F.sum("daily_active_users").over(week),
                "prev_day_dau": F.lag("daily_active_users", 1).over(_by_date()),
                "prev_day_revenue": F.lag("total_revenue", 1).over(_by_date()),
                "prev_day_purchases": F.lag("purchases", 1).over(_by_date()),
                "prev_week_dau": F.lag("daily_active_users", 7).over(_by_date()),
                "prev_week_revenue": F.lag("total_revenue", 7).over(_by_date()),
            }
        )
        .withColumns(
            {
                "dau_dod_change": growth("daily_active_users", "prev_day_dau"),
                "revenue_dod_change": growth("total_revenue", "prev_day_revenue"),
                "dau_wow_change": growth("daily_active_users", "prev_week_dau"),
                "revenue_wow_change": growth("total_revenue", "prev_week_revenue"),
                "_updated_at": moment_of(as_of),
            }
        )
        .orderBy("event_date")
    )


def daily_funnel(int_user_journey: DataFrame) -> DataFrame:
    """Distinct users and sessions per stage and drop-off, and mean stage times, in
    one pass over the journeys."""
    stages = ["site", "product", "cart", "checkout", "purchase"]
    drop_offs = {
        "bounced_users": "landing_bounce",
        "product_exit_users": "product_exit",
        "cart_abandoned_users": "cart_abandoned",
        "checkout_abandoned_users": "checkout_abandoned",
        "converted_users": "converted",
    }
    means = {
        f"avg_{time}": time
        for time in (
            "time_to_product_view",
            "time_to_cart",
            "time_to_checkout",
            "time_to_purchase",
            "total_time_to_purchase",
        )
    }
    counts = (
        {f"users_at_{stage}": ("user_id", stage) for stage in stages}
        | {f"sessions_at_{stage}": ("session_id", stage) for stage in stages}
        | {name: ("user_id", stage) for name, stage in drop_offs.items()}
    )
    return rollup(
        int_user_journey,
        ["event_date"],
        {"total_revenue": total("total_revenue")} | _means(means),
        counts,
        {stage: F.col(f"reached_{stage}") for stage in stages}
        | {stage: F.col("drop_off_stage") == stage for stage in drop_offs.values()},
    ).select("event_date", *counts, "total_revenue", *[_mean_of(name) for name in means])


def fct_funnel(int_user_journey: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row per date with stage counts, rates and their weekly comparison."""
    return funnel_over_days(daily_funnel(int_user_journey), as_of)


def funnel_over_days(days: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The funnel of ``daily_funnel`` rows."""
    rates = {
        "site_to_product_rate": ("users_at_product", "users_at_site"),
        "product_to_cart_rate": ("users_at_cart", "users_at_product"),
        "cart_to_checkout_rate": ("users_at_checkout", "users_at_cart"),
        "checkout_to_purchase_rate": ("users_at_purchase", "users_at_checkout"),
        "overall_conversion_rate": ("users_at_purchase", "users_at_site"),
        "bounce_rate": ("bounced_users", "users_at_site"),
        "cart_abandonment_rate": ("cart_abandoned_users", "users_at_cart"),
        "checkout_abandonment_rate": ("checkout_abandoned_users", "users_at_checkout"),
        "avg_order_value": ("total_revenue", "users_at_purchase"),
        "revenue_per_visitor": ("total_revenue", "users_at_site"),
    }
    week = _last(7, _by_date())
    return (
        days
        .withColumns({name: rate(*pair) for name, pair in rates.items()})
        .withColumns(
            {
                "conversion_rate_7d_avg": _mean("overall_conversion_rate", week),
                "cart_abandonment_7d_avg": _mean("cart_abandonment_rate", week),
                "prev_week_conversion_rate": F.lag("overall_conversion_rate", 7).over(_by_date()),
                "prev_week_cart_abandonment": F.lag("cart_abandonment_rate", 7).over(_by_date()),
                "_updated_at": moment_of(as_of),
            }
        )
        .orderBy("event_date")
    )


def daily_category_revenue(stg_events: DataFrame) -> DataFrame:
    """Paid purchases per date and category."""
    revenue = F.col("revenue_amount")
    paid = stg_events.filter((F.col("event_type") == "purchase") & (revenue > 0)).withColumn(
        "category", F.coalesce("product_category", F.lit("Unknown"))
    )
    sums = rollup(
        paid,
        ["event_date", "category"],
        {
            "gross_revenue": total("revenue_amount"),
            "transactions": row_count(),
            "min_transaction_value": least("revenue_amount"),
            "max_transaction_value": most("revenue_amount"),
            **{
                f"{name}_revenue": total("revenue_amount", F.col("device_type") == value)
                for name, value in DEVICE_BREAKDOWN.items()
            },
            **{
                f"{name}_revenue": total("revenue_amount", F.col("traffic_source") == value)
                for name, value in SOURCE_BREAKDOWN.items()
            },
        },
        {
            "transaction_count": ("event_id", None),
            "purchasing_users": ("user_id", None),
            "purchasing_sessions": ("session_id", None),
            "unique_products_sold": ("product_id", None),
        },
    )
    mean = F.col("gross_revenue").cast("double") / F.col("transactions")
    return sums.withColumn("avg_transaction_value", mean).drop("transactions")


def fct_revenue(stg_events: DataFrame, stg_products: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row per date and category of paid purchases."""
    return revenue_over_days(daily_category_revenue(stg_events), stg_products, as_of)


def revenue_over_days(days: DataFrame, stg_products: DataFrame, as_of: dt.datetime) -> DataFrame:
    """``daily_category_revenue`` rows with share, rolling and cumulative revenue.

    The catalogue is reduced to one row per category before the join, so a category
    with many products does not multiply the daily rows.
    """
    prices = stg_products.groupBy("category").agg(
        F.avg(F.col("price").cast("double")).alias("category_avg_price")
    )
    total = F.sum("gross_revenue").over(Window.partitionBy("event_date"))
    running = _by_category().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        days.join(prices, "category", "left")
        .withColumn("daily_total_revenue", total)
        .withColumns(
            {
                "category_revenue_share": F.col("gross_revenue").cast("double")
                / F.nullif(F.col("daily_total_revenue").cast("double"), F.lit(0.0)),
                "revenue_7d_rolling": F.sum("gross_revenue").over(_last(7, _by_category())),
                "revenue_7d_avg": _mean("gross_revenue", _last(7, _by_category())),
                "revenue_30d_rolling": F.sum("gross_revenue").over(_last(30, _by_category())),
                "prev_day_revenue": F.lag("gross_revenue", 1).over(_by_category()),
                "prev_week_revenue": F.lag("gross_revenue", 7).over(_by_category()),
                "cumulative_revenue": F.sum("gross_revenue").over(running),
            }
        )
        .withColumns(
            {
                "revenue_dod_growth": growth("gross_revenue", "prev_day_revenue"),
                "revenue_wow_growth": growth("gross_revenue", "prev_week_revenue"),
                "_updated_at": moment_of(as_of),
            }
        )
        .orderBy("event_date", "category")
    )
