"""User and product dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions.dates import day, days_crossed, moment_of
from cartlens.operators.ranking import with_ntiles
from cartlens.session import kept


def user_activity(int_sessions: DataFrame) -> DataFrame:
    """Lifetime activity per user.

    Sessions are already unique per user, so their number needs no distinct count.
    """
    return int_sessions.groupBy("user_id").agg(
        F.count("session_id").alias("total_sessions"),
        F.countDistinct("session_date").alias("active_days"),
        F.min("session_date").alias("first_activity_date"),
        F.max("session_date").alias("last_activity_date"),
        *[
            F.sum(source).alias(name)
            for source, name in (
                ("total_events", "total_events"),
                ("page_views", "total_page_views"),
                ("product_views", "total_product_views"),
                ("purchases", "total_purchases"),
                ("session_revenue", "total_revenue"),
            )
        ],
        F.avg("session_duration_seconds").alias("avg_session_duration"),
        F.avg("engagement_score").alias("avg_engagement_score"),
    )


def with_rfm_scores(activity: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Recency, frequency and monetary scores from 1 to 5.

    Frequency and monetary are exact quintiles over all users, ties ordered by user
    id. ``activity`` is scanned several times and should be a stored result.
    """
    recency = days_crossed("last_activity_date", day(as_of))
    scored = activity.withColumns(
        {
            "recency_days": recency,
            "monetary": F.coalesce("total_revenue", F.col("total_sessions") * 0),
            "recency_score": F.when(recency <= 7, 5)
            .when(recency <= 14, 4)
            .when(recency <= 30, 3)
            .when(recency <= 60, 2)
            .otherwise(1),
        }
    )
    ranked = {"frequency_score": "total_sessions", "monetary_score": "monetary"}
    return with_ntiles(scored, 5, ranked, "user_id").drop("monetary")


def dim_users(stg_users: DataFrame, int_sessions: DataFrame, as_of: dt.datetime) -> DataFrame:
    """All known users with lifetime activity, scores and tiers.

    The activity is written once and feeds the sort for both quintiles and the join, so the
    events behind it are read a single time.
    """
    activity = with_rfm_scores(kept(user_activity(int_sessions)), as_of)
    users = stg_users.select(
        "user_id",
        "user_segment",
        "preferred_device",
        "acquisition_source",
        "country_code",
        "city",
        "account_created_at",
        "account_created_date",
        "account_age_days",
        "tenure_tier",
        "is_email_subscribed",
    )

    def or_zero(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0))

    revenue, purchases, recency = (
        or_zero("total_revenue"),
        or_zero("total_purchases"),
        F.col("recency_days"),
    )
    joined = users.join(activity, "user_id", "left")
    scores = {
        name: F.coalesce(F.col(name), F.lit(1))
        for name in ("recency_score", "frequency_score", "monetary_score")
    }
    return joined.select(
        *users.columns,
        or_zero("total_sessions").alias("lifetime_sessions"),
        or_zero("active_days").alias("lifetime_active_days"),
        "first_activity_date",
        "last_activity_date",
        or_zero("total_events").alias("lifetime_events"),
        or_zero("total_page_views").alias("lifetime_page_views"),
        or_zero("total_product_views").alias("lifetime_product_views"),
        purchases.alias("lifetime_purchases"),
        revenue.alias("lifetime_revenue"),
        or_zero("avg_session_duration").alias("avg_session_duration_seconds"),
        or_zero("avg_engagement_score").alias("avg_engagement_score"),
        F.coalesce(recency, F.lit(999)).alias("recency_days"),
        *[score.alias(name) for name, score in scores.items()],
        sum(scores.values(), F.lit(0)).alias("rfm_total_score"),
        F.when(revenue >= 1000, "VIP")
        .when(revenue >= 500, "High Value")
        .when(revenue >= 100, "Medium Value")
        .when(revenue > 0, "Low Value")
        .otherwise("No Purchase")
        .alias("customer_value_tier"),
        F.when(F.col("last_activity_date").isNull(), "Never Active")
        .when(recency <= 7, "Active")
        .when(recency <= 30, "Recent")
        .when(recency <= 90, "Lapsing")
        .otherwise("Churned")
        .alias("activity_status"),
        F.when(purchases > 1, "Repeat Buyer")
        .when(purchases == 1, "One-Time Buyer")
        .otherwise("Non-Buyer")
        .alias("buyer_status"),
        moment_of(as_of).alias("_updated_at"),
    )


def dim_products(
    stg_products: DataFrame, int_product_performance: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """The whole catalogue with performance; products without events get zeros."""
    performance = int_product_performance.select(
        "product_id",
        *[
            F.col(source).alias(name)
            for source, name in (
                ("total_views", "total_views"),
                ("unique_viewers", "unique_viewers"),
                ("cart_adds", "total_cart_adds"),
                ("purchases", "total_purchases"),
                ("total_revenue", "total_revenue"),
                ("view_to_cart_rate", "view_to_cart_rate"),
                ("cart_to_purchase_rate", "cart_to_purchase_rate"),
                ("overall_conversion_rate", "overall_conversion_rate"),
                ("cart_abandonment_rate", "cart_abandonment_rate"),
                ("avg_order_value", "avg_order_value"),
                ("active_days", "active_days"),
            )
        ],
        "first_interaction_date",
        "last_interaction_date",
        "revenue_tier",
        "conversion_tier",
    )
    dates = ("first_interaction_date", "last_interaction_date")
    tiers = {"revenue_tier": "No Sales", "conversion_tier": "Very Low"}
    numbers = [c for c in performance.columns if c not in ("product_id", *dates, *tiers)]
    filled = stg_products.join(performance, "product_id", "left").withColumns(
        {name: F.coalesce(F.col(name), F.lit(0)) for name in numbers}
        | {name: F.coalesce(F.col(name), F.lit(default)) for name, default in tiers.items()}
    )
    revenue, views, conversion = (
        F.col(name) for name in ("total_revenue", "total_views", "overall_conversion_rate")
    )
    return filled.select(
        *[c for c in stg_products.columns if c != "_loaded_at"],
        *numbers[:-1],
        *dates,
        "active_days",
        *tiers,
        F.when((revenue > 0) & (conversion > 0.05), "Star")
        .when((views > 100) & (conversion <= 0.02), "Underperformer")
        .when(views < 10, "Low Visibility")
        .otherwise("Standard")
        .alias("product_health"),
        "_loaded_at",
        moment_of(as_of).alias("_updated_at"),
    )
