"""Declared column assertions and cross-table assertions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.schemas import DEVICES, EVENT_TYPES, SEGMENTS, TRAFFIC_SOURCES


@dataclass(frozen=True)
class Assertion:
    column: str
    test: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    inclusive: bool = True

    def broken(self) -> Column:
        """True where a row violates the assertion; nulls only violate not_null."""
        column = F.col(self.column)
        if self.test == "not_null":
            return column.isNull()
        if self.test == "accepted_values":
            return ~column.isin(list(self.values))
        if self.test == "accepted_range":
            outside = F.lit(False)
            if self.low is not None:
                outside = outside | (column < self.low if self.inclusive else column <= self.low)
            if self.high is not None:
                outside = outside | (column > self.high if self.inclusive else column >= self.high)
            return outside
        raise ValueError(self.test)


def not_null(*columns: str) -> list[Assertion]:
    return [Assertion(column, "not_null") for column in columns]


def unique(*columns: str) -> list[Assertion]:
    return [Assertion(column, "unique") for column in columns]


def accepted(column: str, values: list[str]) -> list[Assertion]:
    return [Assertion(column, "accepted_values", values=tuple(values))]


def within(
    column: str, low: float | None = None, high: float | None = None, inclusive: bool = True
) -> list[Assertion]:
    return [Assertion(column, "accepted_range", low=low, high=high, inclusive=inclusive)]


# What is declared about every table.
DECLARED: dict[str, list[Assertion]] = {
    "raw.events": [
        *unique("event_id"),
        *not_null("event_id", "event_type", "user_id", "timestamp"),
    ],
    "seeds.products": [*unique("product_id"), *not_null("product_id")],
    "seeds.users": [*unique("user_id"), *not_null("user_id")],
    "stg_events": [
        *unique("event_id"),
        *not_null(
            "event_id", "event_type", "user_id", "session_id", "event_timestamp", "event_date"
        ),
        *accepted("event_type", EVENT_TYPES),
        *accepted("device_type", [*DEVICES, "unknown"]),
        *accepted("traffic_source", TRAFFIC_SOURCES),
        *within("revenue_amount", low=0),
    ],
    "stg_products": [
        *unique("product_id"),
        *not_null("product_id", "product_name", "category", "price"),
        *within("price", low=0, inclusive=False),
        *accepted("price_tier", ["Budget", "Mid-Range", "Premium", "Luxury"]),
        *within("rating", low=0, high=5),
    ],
    "stg_users": [
        *unique("user_id"),
        *not_null("user_id", "user_segment"),
        *accepted("user_segment", [*SEGMENTS, "unknown"]),
        *accepted("tenure_tier", ["New", "Developing", "Established", "Veteran"]),
    ],
    "int_sessions": [
        *unique("session_id"),
        *not_null(
            "session_id",
            "user_id",
            "session_start",
            "session_end",
            "session_duration_seconds",
            "is_converted",
        ),
        *within("session_duration_seconds", low=0),
        *accepted(
            "session_quality",
            ["High Value", "High Intent", "Engaged", "Browsing", "Low Engagement"],
        ),
    ],
    "int_user_journey": [
        *not_null("user_id", "session_id"),
        *accepted(
            "deepest_stage", ["none", "page_view", "product_view", "cart", "checkout", "purchase"]
        ),
        *within("funnel_depth", low=0, high=5),
        *accepted(
            "drop_off_stage",
            [
                "converted",
                "checkout_abandoned",
                "cart_abandoned",
                "product_exit",
                "landing_bounce",
                "no_engagement",
            ],
        ),
    ],
    "int_product_performance": [
        *unique("product_id"),
        *not_null("product_id", "total_views"),
        *within("total_views", low=0),
        *within("view_to_cart_rate", low=0, high=1),
        *within("overall_conversion_rate", low=0, high=1),
    ],
    "dim_users": [
        *unique("user_id"),
        *not_null("user_id", "user_segment"),
        *within("lifetime_revenue", low=0),
        *accepted(
            "customer_value_tier",
            ["VIP", "High Value", "Medium Value", "Low Value", "No Purchase"],
        ),
        *accepted(
            "activity_status", ["Active", "Recent", "Lapsing", "Churned", "Never Active"]
        ),
        *accepted("buyer_status", ["Repeat Buyer", "One-Time Buyer", "Non-Buyer"]),
    ],
    "dim_products": [
        *unique("product_id"),
        *not_null("product_id", "product_name", "category", "price"),
        *within("price", low=0, inclusive=False),
        *within("overall_conversion_rate", low=0, high=1),
    ],
    "dim_date": [
        *unique("date_key"),
        *not_null("date_key", "year", "month"),
        *within("month", low=1, high=12),
        *within("day_of_week", low=0, high=6),
    ],
    "fct_daily_engagement": [
        *unique("event_date"),
        *not_null("event_date", "daily_active_users", "total_sessions"),
        *within("daily_active_users", low=0),
        *within("total_revenue", low=0),
        *within("conversion_rate", low=0, high=1),
    ],
    "fct_funnel": [
        *unique("event_date"),
        *not_null("event_date", "users_at_site", "users_at_purchase"),
        *within("overall_conversion_rate", low=0, high=1),
        *within("cart_abandonment_rate", low=0, high=1),
    ],
    "fct_revenue": [
        *not_null("event_date", "category"),
        *within("gross_revenue", low=0),
        *within("transaction_count", low=0),
    ],
}


def violations(df: DataFrame, table: str, assertions: list[Assertion] | None = None) -> DataFrame:
    """Number of violations of every assertion of one table.

    Row assertions are counted in one pass; a unique column adds a grouping by that column
    first, over which the row counts are summed, and counts repeated values. Each further
    unique column is a grouping of its own.
    """
    assertions = DECLARED[table] if assertions is None else assertions
    uniques = [a for a in assertions if a.test == "unique"]
    rows = [a for a in assertions if a.test != "unique"]
    if len(uniques) > 1:
        found = violations(df, table, rows + uniques[:1])
        for other in uniques[1:]:
            found = found.unionByName(violations(df, table, [other]))
        return found
    counted = [F.count_if(a.broken()).alias(f"v{i}") for i, a in enumerate(rows)]
    if uniques:
        key = uniques[0].column
        grouped = df.groupBy(F.col(key).alias("_key")).agg(
            F.count(F.lit(1)).alias("_copies"), *counted
        )
        totals = grouped.agg(
            *[F.coalesce(F.sum(f"v{i}"), F.lit(0)).alias(f"v{i}") for i in range(len(rows))],
            F.count_if(F.col("_key").isNotNull() & (F.col("_copies") > 1)).alias("_unique"),
        )
    else:
        totals = df.agg(*counted)
    listed = [(a, f"v{i}") for i, a in enumerate(rows)] + [(a, "_unique") for a in uniques]
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.lit(a.column).alias("column_name"),
                        F.lit(a.test).alias("test"),
                        F.col(source).cast("bigint").alias("violations"),
                    )
                    for a, source in listed
                ]
            )
        )
    )


def funnel_order(fct_funnel: DataFrame) -> DataFrame:
    """Dates on which a stage has more users than the stage before it."""
    stages = ["site", "product", "cart", "checkout", "purchase"]
    verdict = F.lit("PASS")
    for before, after in reversed(list(zip(stages, stages[1:], strict=False))):
        more = F.col(f"users_at_{after}") > F.col(f"users_at_{before}")
        verdict = F.when(more, f"FAIL: {after} > {before}").otherwise(verdict)
    return (
        fct_funnel.select("event_date", *[f"users_at_{stage}" for stage in stages])
        .withColumn("funnel_check_result", verdict)
        .filter(F.col("funnel_check_result") != "PASS")
    )


def revenue_consistency(
    fct_daily_engagement: DataFrame, fct_revenue: DataFrame, tolerance: float = 0.01
) -> DataFrame:
    """Dates whose daily revenue differs from the sum over their categories."""
    categories = fct_revenue.groupBy("event_date").agg(
        F.sum("gross_revenue").alias("category_revenue")
    )
    daily = fct_daily_engagement.select(
        "event_date", F.col("total_revenue").alias("engagement_revenue")
    )
    gap = F.abs(F.col("engagement_revenue") - F.coalesce("category_revenue", F.lit(0)))
    return (
        daily.join(categories, "event_date", "left")
        .withColumn("difference", gap)
        .filter(F.col("difference") > tolerance)
    )


def orphan_session_users(int_sessions: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Users of sessions that the user dimension does not know."""
    users = int_sessions.select("user_id").distinct()
    return users.join(dim_users.select("user_id"), "user_id", "left_anti")
