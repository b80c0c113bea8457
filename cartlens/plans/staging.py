"""Cleaning of the three raw tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions.dates import (
    day,
    days_crossed,
    literal_like,
    moment_of,
    weekday_from_sunday,
)


def _or(column: str, default: str | int | float | bool) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def stg_events(events: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row per usable event; events after ``as_of`` are left out."""
    now = literal_like(events, "timestamp", as_of)
    usable = events.filter(
        F.col("event_id").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("timestamp").isNotNull()
        & (F.col("timestamp") <= now)
    )
    weekday = weekday_from_sunday("timestamp")
    bought = (F.col("event_type") == "purchase") & (F.col("revenue") > 0)
    return usable.select(
        "event_id",
        "event_type",
        "user_id",
        "session_id",
        F.col("timestamp").alias("event_timestamp"),
        F.to_date("timestamp").alias("event_date"),
        F.hour("timestamp").alias("event_hour"),
        weekday.alias("day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"),
        _or("device", "unknown").alias("device_type"),
        _or("country", "XX").alias("country_code"),
        _or("traffic_source", "direct").alias("traffic_source"),
        "product_id",
        F.col("category").alias("product_category"),
        _or("revenue", 0).cast(events.schema["revenue"].dataType).alias("revenue_amount"),
        F.coalesce(bought, F.lit(False)).alias("is_revenue_event"),
        F.col("properties").alias("event_properties"),
        moment_of(as_of).alias("_loaded_at"),
    )


def stg_products(products: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Catalogue with defaults and tiers; a missing price or rating falls into the
    last tier."""
    price, rating = F.col("price"), F.col("rating")
    return products.filter(F.col("product_id").isNotNull()).select(
        "product_id",
        "product_name",
        _or("category", "Uncategorized").alias("category"),
        _or("subcategory", "Other").alias("subcategory"),
        _or("brand", "Unknown Brand").alias("brand"),
        price.try_cast("decimal(10,2)").alias("price"),
        F.when(price < 25, "Budget")
        .when(price < 100, "Mid-Range")
        .when(price < 500, "Premium")
        .otherwise("Luxury")
        .alias("price_tier"),
        F.coalesce(rating.try_cast("decimal(2,1)"), F.lit(0).cast("decimal(2,1)")).alias("rating"),
        F.when(rating >= 4.5, "Excellent")
        .when(rating >= 4.0, "Good")
        .when(rating >= 3.0, "Average")
        .otherwise("Below Average")
        .alias("rating_tier"),
        _or("review_count", 0).alias("review_count"),
        _or("in_stock", True).alias("is_in_stock"),
        moment_of(as_of).alias("_loaded_at"),
    )


def stg_users(users: DataFrame, as_of: dt.datetime) -> DataFrame:
    """User profiles with defaults and tenure in calendar days."""
    age = days_crossed("created_at", day(as_of))
    return users.filter(F.col("user_id").isNotNull()).select(
        "user_id",
        _or("segment", "unknown").alias("user_segment"),
        _or("primary_device", "unknown").alias("preferred_device"),
        _or("traffic_source", "direct").alias("acquisition_source"),
        _or("country", "XX").alias("country_code"),
        "city",
        F.col("created_at").alias("account_created_at"),
        F.to_date("created_at").alias("account_created_date"),
        age.alias("account_age_days"),
        F.when(age <= 30, "New")
        .when(age <= 90, "Developing")
        .when(age <= 365, "Established")
        .otherwise("Veteran")
        .alias("tenure_tier"),
        _or("is_subscribed", False).alias("is_email_subscribed"),
        _or("lifetime_value", 0).alias("historical_ltv"),
        moment_of(as_of).alias("_loaded_at"),
    )
