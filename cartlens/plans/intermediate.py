"""Sessions, funnel journeys and product performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions.dates import seconds_crossed
from cartlens.functions.metrics import count_type, rate, revenue_where
from cartlens.operators.ranking import continuous_percentiles
from cartlens.operators.rollup import least, most, rollup, row_count, total
from cartlens.schemas import EVENT_TYPES, MAX_SESSION_HOURS

# Weight of one event in the engagement score.
ENGAGEMENT_WEIGHTS = {
    "page_views": 1.0,
    "product_views": 2.0,
    "searches": 1.5,
    "add_to_cart_events": 5.0,
    "checkout_starts": 10.0,
    "purchases": 20.0,
}


# The event types that the score counts.
ENGAGEMENT_TYPES = {
    "page_views": "page_view",
    "product_views": "product_view",
    "searches": "search",
    "add_to_cart_events": "add_to_cart",
    "checkout_starts": "begin_checkout",
    "purchases": "purchase",
}


def _engagement_score() -> Column:
    return sum((F.col(c) * weight for c, weight in ENGAGEMENT_WEIGHTS.items()), F.lit(0.0))


def session_days(stg_events: DataFrame) -> DataFrame:
    """What a day adds to a session: one row per date, session and user, to be added up later."""
    return stg_events.groupBy("event_date", "session_id", "user_id").agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("total_events"),
        *[count_type(kind).alias(name) for name, kind in ENGAGEMENT_TYPES.items()],
    )


def sessions_of_days(days: DataFrame, max_hours: int = MAX_SESSION_HOURS) -> DataFrame:
    """The sessions of ``session_days`` rows, with the columns of ``int_sessions`` that daily
    engagement reads."""
    sums = ["total_events", *ENGAGEMENT_TYPES]
    return (
        days.groupBy("session_id", "user_id")
        .agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.min("event_date").alias("session_date"),
            *[F.sum(name).alias(name) for name in sums],
        )
        .withColumn("session_duration_seconds", seconds_crossed("session_start", "session_end"))
        .filter(F.col("session_duration_seconds") <= max_hours * 3600)
        .withColumns({"is_converted": F.col("purchases") > 0, "engagement_score": _engagement_score()})
    )


def int_sessions(stg_events: DataFrame, max_hours: int = MAX_SESSION_HOURS) -> DataFrame:
    """One row per session and user; sessions longer than ``max_hours`` are dropped.

    Device, country and source are the smallest value of the session. The known
    event types are told apart by their counts, so only other types have to be
    counted as distinct values.
    """
    unknown_type = F.when(~F.col("event_type").isin(EVENT_TYPES), F.col("event_type"))
    kind = F.col("event_type")
    grouped = rollup(
        stg_events.withColumn("unknown_type", unknown_type),
        ["session_id", "user_id"],
        {
            "session_start": least("event_timestamp"),
            "session_end": most("event_timestamp"),
            "session_date": least("event_date"),
            "device_type": least("device_type"),
            "country_code": least("country_code"),
            "traffic_source": least("traffic_source"),
            "total_events": row_count(),
            "page_views": row_count(kind == "page_view"),
            "product_views": row_count(kind == "product_view"),
            "searches": row_count(kind == "search"),
            "add_to_cart_events": row_count(kind == "add_to_cart"),
            "remove_from_cart_events": row_count(kind == "remove_from_cart"),
            "checkout_starts": row_count(kind == "begin_checkout"),
            "purchases": row_count(kind == "purchase"),
            "signups": row_count(kind == "signup"),
            "logins": row_count(kind == "login"),
            "session_revenue": total("revenue_amount"),
            "max_order_value": most("revenue_amount"),
        },
        {
            "unknown_types": ("unknown_type", None),
            "unique_products_viewed": ("product_id", None),
            "unique_categories_viewed": ("product_category", None),
        },
        fine=True,
    )
    counted_types = [
        "page_views",
        "product_views",
        "searches",
        "add_to_cart_events",
        "remove_from_cart_events",
        "checkout_starts",
        "purchases",
        "signups",
        "logins",
    ]
    types = sum((F.when(F.col(c) > 0, 1).otherwise(0) for c in counted_types), F.col("unknown_types"))
    duration = F.col("session_duration_seconds")
    bought, checkout, cart = (
        F.col(name) > 0 for name in ("purchases", "checkout_starts", "add_to_cart_events")
    )
    return (
        grouped.withColumn(
            "session_duration_seconds", seconds_crossed("session_start", "session_end")
        )
        .filter(duration <= max_hours * 3600)
        .withColumns(
            {
                "duration_category": F.when(duration < 30, "Bounce")
                .when(duration < 120, "Quick")
                .when(duration < 600, "Engaged")
                .when(duration < 1800, "Deep")
                .otherwise("Extended"),
                "unique_event_types": types,
                "is_converted": bought,
                "has_cart_activity": cart,
                "started_checkout": checkout,
                "engagement_score": _engagement_score(),
                "session_quality": F.when(bought, "High Value")
                .when(checkout, "High Intent")
                .when(cart, "Engaged")
                .when(F.col("product_views") >= 3, "Browsing")
                .otherwise("Low Engagement"),
            }
        )
        .drop("unknown_types", "signups", "logins")
    )


# Funnel stages in order with their event type and their names in
# the time, count, flag and stage columns.
STAGES = [
    ("page_view", "first_page_view", "page_view_count", "reached_site", "page_view"),
    ("product_view", "first_product_view", "product_view_count", "reached_product", "product_view"),
    ("add_to_cart", "first_add_to_cart", "add_to_cart_count", "reached_cart", "cart"),
    ("begin_checkout", "first_checkout", "checkout_count", "reached_checkout", "checkout"),
    ("purchase", "first_purchase", "purchase_count", "reached_purchase", "purchase"),
]


def int_user_journey(stg_events: DataFrame) -> DataFrame:
    """One row per user, session and date with the funnel stages reached.

    A stage counts without the earlier ones, so stage times may be negative.
    """
    firsts = [
        F.min(F.when(F.col("event_type") == event, F.col("event_timestamp"))).alias(first)
        for event, first, *_ in STAGES
    ]
    counted = [count_type(event).alias(count) for event, _, count, *_ in STAGES]
    journeys = stg_events.groupBy("user_id", "session_id", "event_date").agg(
        *firsts, *counted, F.sum("revenue_amount").alias("total_revenue")
    )

    reached = {flag: F.col(first).isNotNull() for _, first, _, flag, _ in STAGES}
    deepest, depth = F.lit("none"), F.lit(0)
    for position, (_, _, _, flag, stage) in enumerate(STAGES, start=1):
        deepest = F.when(reached[flag], stage).otherwise(deepest)
        depth = F.when(reached[flag], position).otherwise(depth)
    # the first stage missing after one that was reached, looked at from the end
    drop_off = (
        F.when(reached["reached_purchase"], "converted")
        .when(reached["reached_checkout"], "checkout_abandoned")
        .when(reached["reached_cart"], "cart_abandoned")
        .when(reached["reached_product"], "product_exit")
        .when(reached["reached_site"], "landing_bounce")
        .otherwise("no_engagement")
    )
    return journeys.withColumns(
        {
            **reached,
            "deepest_stage": deepest,
            "time_to_product_view": seconds_crossed("first_page_view", "first_product_view"),
            "time_to_cart": seconds_crossed("first_product_view", "first_add_to_cart"),
            "time_to_checkout": seconds_crossed("first_add_to_cart", "first_checkout"),
            "time_to_purchase": seconds_crossed("first_checkout", "first_purchase"),
            "total_time_to_purchase": seconds_crossed("first_page_view", "first_purchase"),
            "funnel_depth": depth,
            "drop_off_stage": drop_off,
        }
    )


def product_revenue(stg_events: DataFrame) -> DataFrame:
    """The revenue of ``product_metrics`` alone, which one plain aggregation gives."""
    return (
        stg_events.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(revenue_where(F.col("event_type") == "purchase").alias("total_revenue"))
    )


def product_metrics(stg_events: DataFrame) -> DataFrame:
    """Distinct views, carts, purchases and their rates per product."""
    about_products = stg_events.filter(F.col("product_id").isNotNull())
    kind = F.col("event_type")
    metrics = rollup(
        about_products,
        ["product_id"],
        {
            "total_revenue": total("revenue_amount", kind == "purchase"),
            "first_interaction_date": least("event_date"),
            "last_interaction_date": most("event_date"),
        },
        {
            "total_views": ("event_id", "view"),
            "unique_viewers": ("user_id", "view"),
            "view_sessions": ("session_id", "view"),
            "cart_adds": ("event_id", "cart"),
            "users_added_to_cart": ("user_id", "cart"),
            "cart_removes": ("event_id", "remove"),
            "purchases": ("event_id", "purchase"),
            "purchasing_users": ("user_id", "purchase"),
            "active_days": ("event_date", None),
        },
        {
            "view": kind == "product_view",
            "cart": kind == "add_to_cart",
            "remove": kind == "remove_from_cart",
            "purchase": kind == "purchase",
        },
    )
    return metrics.withColumns(
        {
            "view_to_cart_rate": rate("cart_adds", "total_views"),
            "cart_to_purchase_rate": rate("purchases", "cart_adds"),
            "overall_conversion_rate": rate("purchases", "total_views"),
            "avg_order_value": rate("total_revenue", "purchases"),
            "cart_abandonment_rate": rate(F.col("cart_adds") - F.col("purchases"), "cart_adds"),
        }
    )


def int_product_performance(stg_events: DataFrame, stg_products: DataFrame) -> DataFrame:
    """Product metrics with catalogue attributes and tiers.

    The revenue tier compares with the 90th and 50th percentile over all products.
    The percentiles are scalars of the plan, which read the revenue alone; products
    the catalogue does not know stay, with nulls.
    """
    metrics = product_metrics(stg_events)
    bounds = continuous_percentiles(product_revenue(stg_events), "total_revenue", [0.5, 0.9])
    catalogue = stg_products.select(
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "brand",
        "price",
        "price_tier",
        "rating",
        "rating_tier",
        "is_in_stock",
    )
    conversion, revenue = F.col("overall_conversion_rate"), F.col("total_revenue").cast("double")
    whole = metrics.join(catalogue, "product_id", "left").withColumn("bounds", bounds)
    return whole.withColumns(
        {
            "revenue_tier": F.when(revenue >= F.get("bounds", F.lit(1)), "Top Performer")
            .when(revenue >= F.get("bounds", F.lit(0)), "Above Average")
            .when(F.col("total_revenue") > 0, "Below Average")
            .otherwise("No Sales"),
            "conversion_tier": F.when(conversion >= 0.10, "High Converting")
            .when(conversion >= 0.05, "Average Converting")
            .when(conversion >= 0.01, "Low Converting")
            .otherwise("Very Low"),
        }
    ).drop("bounds")
