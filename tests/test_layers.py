"""Boundary rules of the layered models with a few literal rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartlens import schemas
from cartlens.operators.assertions import DECLARED, funnel_order, revenue_consistency, violations
from cartlens.plans import calendar, dimensions, facts, intermediate, staging
from tests.conftest import AS_OF, moment, rows


def test_declared_assertions_are_complete():
    tests = [a.test for table in DECLARED.values() for a in table]
    assert {t: tests.count(t) for t in set(tests)} == {
        "not_null": 45,
        "unique": 13,
        "accepted_values": 12,
        "accepted_range": 20,
    }


# staging


def test_staging_drops_unusable_and_future_events(make_events):
    events = make_events(
        {"event_id": None},
        {"user_id": None},
        {"timestamp": None},
        {"timestamp": "2024-02-01 12:00:00.000001"},
        {"timestamp": "2024-02-01 12:00:00", "session_id": None},
    )
    kept = staging.stg_events(events, AS_OF).collect()
    assert [row.session_id for row in kept] == [None]


def test_staging_defaults_and_weekdays(make_events):
    events = make_events(
        {
            "timestamp": "2024-01-07 23:59:59",  # a Sunday
            "device": None,
            "country": None,
            "traffic_source": None,
            "revenue": None,
            "event_type": "purchase",
        },
        {"timestamp": "2024-01-08 00:00:00", "event_type": "purchase", "revenue": 3.0},
    )
    sunday, monday = staging.stg_events(events, AS_OF).orderBy("event_timestamp").collect()
    assert (sunday.day_of_week, sunday.is_weekend, sunday.event_hour) == (0, True, 23)
    assert (sunday.device_type, sunday.country_code, sunday.traffic_source) == (
        "unknown",
        "XX",
        "direct",
    )
    assert (sunday.revenue_amount, sunday.is_revenue_event) == (0.0, False)
    assert (monday.day_of_week, monday.is_weekend, monday.is_revenue_event) == (1, False, True)


def test_product_tiers(spark):
    cases = [
        (24.99, 4.5, "Budget", "Excellent"),
        (25.0, 4.49, "Mid-Range", "Good"),
        (100.0, 4.0, "Premium", "Good"),
        (500.0, 3.0, "Luxury", "Average"),
        (None, None, "Luxury", "Below Average"),
        (99.99, 2.99, "Mid-Range", "Below Average"),
    ]
    raw = [(f"P{i}", None, None, None, p, None, r, None, None) for i, (p, r, *_) in enumerate(cases)]
    staged = staging.stg_products(spark.createDataFrame(raw, schemas.PRODUCTS), AS_OF)
    assert rows(staged.orderBy("product_id"), "price_tier", "rating_tier") == [
        case[2:] for case in cases
    ]
    first = staged.filter("product_id = 'P4'").first()
    assert (first.category, first.subcategory, first.brand, first.review_count) == (
        "Uncategorized",
        "Other",
        "Unknown Brand",
        0,
    )
    assert first.is_in_stock is True and float(first.rating) == 0 and first.price is None


@pytest.mark.parametrize(
    ("age", "tier"),
    [
        (30, "New"),
        (31, "Developing"),
        (90, "Developing"),
        (91, "Established"),
        (365, "Established"),
        (366, "Veteran"),
        (None, "Veteran"),
    ],
)
def test_tenure_counts_calendar_days(spark, age, tier):
    # created in the last second of the day: the midnights count, not the hours
    created = age is not None and dt.datetime(2024, 2, 1, 23, 59, 59) - dt.timedelta(days=age)
    raw = ("U", None, None, None, None, None, created or None, None, None)
    user = staging.stg_users(spark.createDataFrame([raw], schemas.USERS), AS_OF).first()
    assert (user.account_age_days, user.tenure_tier) == (age, tier)
    assert (user.user_segment, user.preferred_device, user.acquisition_source) == (
        "unknown",
        "unknown",
        "direct",
    )


# sessions and journeys


def sessions_of(make_events, *events, **options):
    return intermediate.int_sessions(staging.stg_events(make_events(*events), AS_OF), **options)


@pytest.mark.parametrize(
    ("end", "seconds", "category"),
    [
        ("10:00:29", 29, "Bounce"),
        ("10:00:30", 30, "Quick"),
        ("10:02:00", 120, "Engaged"),
        ("10:10:00", 600, "Deep"),
        ("10:30:00", 1800, "Extended"),
    ],
)
def test_duration_categories(make_events, end, seconds, category):
    session = sessions_of(make_events, {}, {"timestamp": f"2024-01-10 {end}"}).first()
    assert (session.session_duration_seconds, session.duration_category) == (seconds, category)


def test_duration_counts_second_boundaries(make_events):
    session = sessions_of(
        make_events,
        {"timestamp": "2024-01-10 10:00:00.900000"},
        {"timestamp": "2024-01-10 10:00:02.100000"},
    ).first()
    assert session.session_duration_seconds == 2


def test_sessions_longer_than_a_day_are_dropped(make_events):
    whole = {"timestamp": "2024-01-11 10:00:00"}
    longer = {"timestamp": "2024-01-11 10:00:01"}
    assert sessions_of(make_events, {}, whole).count() == 1
    assert sessions_of(make_events, {}, longer).count() == 0


def test_session_over_midnight_keeps_its_start_date(make_events):
    session = sessions_of(
        make_events, {"timestamp": "2024-01-10 23:50:00"}, {"timestamp": "2024-01-11 00:10:00"}
    ).first()
    assert session.session_date == dt.date(2024, 1, 10)


def test_session_measures(make_events):
    session = sessions_of(
        make_events,
        {"device": "tablet", "country": "US"},
        {"event_type": "search", "device": "desktop", "country": None},
        {"event_type": "product_view", "product_id": "P1", "category": "A"},
        {"event_type": "product_view", "product_id": "P2", "category": "A"},
        {"event_type": "add_to_cart", "product_id": "P2"},
        {"event_type": "purchase", "revenue": 20.0, "product_id": "P2"},
        {"event_type": "purchase", "revenue": 5.0},
    ).first()
    assert (session.device_type, session.country_code) == ("desktop", "US")
    assert (session.total_events, session.unique_event_types) == (7, 5)
    assert (session.unique_products_viewed, session.unique_categories_viewed) == (2, 1)
    assert (session.session_revenue, session.max_order_value) == (25.0, 20.0)
    assert session.engagement_score == 1 + 1.5 + 4 + 5 + 40
    assert (session.is_converted, session.session_quality) == (True, "High Value")


@pytest.mark.parametrize(
    ("types", "quality"),
    [
        (["begin_checkout"], "High Intent"),
        (["add_to_cart"], "Engaged"),
        (["product_view"] * 3, "Browsing"),
        (["product_view"] * 2, "Low Engagement"),
    ],
)
def test_session_quality(make_events, types, quality):
    session = sessions_of(make_events, *[{"event_type": t} for t in types]).first()
    assert session.session_quality == quality


def test_unknown_event_types_count_as_types(make_events):
    kinds = ["odd", "odd", "strange", "login", "login", "signup", None]
    session = sessions_of(make_events, *[{"event_type": kind} for kind in kinds]).first()
    assert (session.total_events, session.unique_event_types) == (7, 4)


def test_events_without_a_session_form_one_per_user(make_events):
    found = sessions_of(make_events, {"session_id": None}, {"session_id": None}, {"user_id": "U2"})
    assert sorted(rows(found, "user_id", "total_events", "unique_event_types")) == [
        ("U2", 1, 1),
        ("USER_0000000000B7", 2, 1),
    ]


def journey_of(make_events, *events):
    return intermediate.int_user_journey(staging.stg_events(make_events(*events), AS_OF))


def test_journey_times_may_be_negative_or_missing(make_events):
    journey = journey_of(
        make_events,
        {"event_type": "purchase", "timestamp": "2024-01-10 10:00:00"},
        {"event_type": "page_view", "timestamp": "2024-01-10 10:00:10"},
    ).first()
    assert journey.total_time_to_purchase == -10
    assert journey.time_to_cart is None
    assert (journey.deepest_stage, journey.funnel_depth) == ("purchase", 5)
    assert journey.drop_off_stage == "converted"


@pytest.mark.parametrize(
    ("kind", "stage", "drop_off"),
    [
        ("login", "none", "no_engagement"),
        ("page_view", "page_view", "landing_bounce"),
        ("product_view", "product_view", "product_exit"),
        ("add_to_cart", "cart", "cart_abandoned"),
        ("begin_checkout", "checkout", "checkout_abandoned"),
    ],
)
def test_drop_off(make_events, kind, stage, drop_off):
    journey = journey_of(make_events, {"event_type": kind}).first()
    assert (journey.deepest_stage, journey.drop_off_stage) == (stage, drop_off)


def test_journey_splits_by_date(make_events):
    found = journey_of(
        make_events, {"timestamp": "2024-01-10 23:59:59"}, {"timestamp": "2024-01-11 00:00:00"}
    )
    assert found.count() == 2


# products


def performance_of(spark, make_events, *events):
    catalogue = staging.stg_products(spark.createDataFrame([], schemas.PRODUCTS), AS_OF)
    return intermediate.int_product_performance(
        staging.stg_events(make_events(*events), AS_OF), catalogue
    )


def test_product_counts_are_distinct_and_abandonment_may_be_negative(spark, make_events):
    found = performance_of(
        spark,
        make_events,
        {"event_id": "E1", "event_type": "product_view", "product_id": "P"},
        {"event_id": "E1", "event_type": "product_view", "product_id": "P"},
        {"event_type": "add_to_cart", "product_id": "P"},
        {"event_type": "purchase", "product_id": "P", "revenue": 4.0},
        {"event_type": "purchase", "product_id": "P", "revenue": 8.0},
        {"event_type": "purchase", "revenue": 100.0},
    ).first()
    assert (found.total_views, found.cart_adds, found.purchases) == (1, 1, 2)
    assert (found.total_revenue, found.avg_order_value) == (12.0, 6.0)
    assert (found.cart_abandonment_rate, found.overall_conversion_rate) == (-1.0, 2.0)
    assert (found.product_name, found.conversion_tier) == (None, "High Converting")


def test_all_zero_revenue_makes_every_product_a_top_performer(spark, make_events):
    events = [{"event_type": "product_view", "product_id": f"P{i}"} for i in range(4)]
    tiers = rows(performance_of(spark, make_events, *events), "revenue_tier")
    assert set(tiers) == {("Top Performer",)}


def test_generated_purchases_without_product_leave_products_unsold(spark, make_events):
    found = performance_of(
        spark,
        make_events,
        {"event_type": "product_view", "product_id": "P1"},
        {"event_type": "purchase", "revenue": 50.0},
    ).first()
    assert (found.purchases, found.total_revenue) == (0, 0.0)


# dimensions


def test_user_scores_and_statuses(spark, make_events):
    last_seen = {"A": 1, "B": 8, "C": 14, "D": 15, "E": 31, "F": 61, "G": 91}
    events = []
    for user, days in last_seen.items():
        time = dt.datetime(2024, 2, 1) - dt.timedelta(days=days)
        events.append({"user_id": user, "session_id": f"S{user}", "timestamp": time})
    staged = staging.stg_events(make_events(*events), AS_OF)
    users = spark.createDataFrame(
        [(user, *[None] * 8) for user in [*last_seen, "Z"]], schemas.USERS
    )
    found = dimensions.dim_users(
        staging.stg_users(users, AS_OF), intermediate.int_sessions(staged), AS_OF
    ).orderBy("user_id")
    assert rows(found, "recency_days", "recency_score", "activity_status") == [
        (1, 5, "Active"),
        (8, 4, "Recent"),
        (14, 4, "Recent"),
        (15, 3, "Recent"),
        (31, 2, "Lapsing"),
        (61, 1, "Lapsing"),
        (91, 1, "Churned"),
        (999, 1, "Never Active"),
    ]
    assert rows(found, "frequency_score") == [(1,), (1,), (2,), (2,), (3,), (4,), (5,), (1,)]
    never = found.collect()[-1]
    assert (never.lifetime_sessions, never.rfm_total_score) == (0, 3)
    assert (never.customer_value_tier, never.buyer_status) == ("No Purchase", "Non-Buyer")


@pytest.mark.parametrize(
    ("amounts", "tier", "buyer"),
    [
        ([1000.0], "VIP", "One-Time Buyer"),
        ([500.0, 499.99], "High Value", "Repeat Buyer"),
        ([100.0], "Medium Value", "One-Time Buyer"),
        ([0.01], "Low Value", "One-Time Buyer"),
    ],
)
def test_value_tiers(spark, make_events, amounts, tier, buyer):
    events = make_events(*[{"event_type": "purchase", "revenue": a} for a in amounts])
    users = spark.createDataFrame([("USER_0000000000B7", *[None] * 8)], schemas.USERS)
    found = dimensions.dim_users(
        staging.stg_users(users, AS_OF),
        intermediate.int_sessions(staging.stg_events(events, AS_OF)),
        AS_OF,
    ).first()
    assert (found.customer_value_tier, found.buyer_status) == (tier, buyer)


def test_product_health(spark):
    products = [(f"P{i}", "n", "c", "s", 5.0, "b", 4.0, 1, True) for i in range(5)]
    staged = staging.stg_products(spark.createDataFrame(products, schemas.PRODUCTS), AS_OF)
    performance = spark.createDataFrame(
        [("P0", 50, 1.0, 0.06), ("P1", 101, 1.0, 0.02), ("P2", 9, 1.0, 0.0), ("P3", 100, 0.0, 0.02)],
        "product_id string, total_views bigint, total_revenue double, overall_conversion_rate double",
    )
    absent = {
        "unique_viewers": "bigint",
        "cart_adds": "bigint",
        "purchases": "bigint",
        "view_to_cart_rate": "double",
        "cart_to_purchase_rate": "double",
        "cart_abandonment_rate": "double",
        "avg_order_value": "double",
        "active_days": "bigint",
        "first_interaction_date": "date",
        "last_interaction_date": "date",
        "revenue_tier": "string",
        "conversion_tier": "string",
    }
    performance = performance.withColumns({c: F.lit(None).cast(t) for c, t in absent.items()})
    found = dimensions.dim_products(staged, performance, AS_OF).orderBy("product_id")
    assert [r[0] for r in rows(found, "product_health")] == [
        "Star",
        "Underperformer",
        "Low Visibility",
        "Standard",
        "Low Visibility",
    ]
    assert set(rows(found, "revenue_tier", "conversion_tier")) == {("No Sales", "Very Low")}


# facts


def engagement_of(make_events, *events):
    staged = staging.stg_events(make_events(*events), AS_OF)
    return facts.fct_daily_engagement(staged, intermediate.int_sessions(staged), AS_OF)


def test_windows_go_by_rows_not_days(make_events):
    days = [1, 2, 3, 4, 5, 6, 7, 20, 21]  # the gap does not shorten the window
    events = [
        {"timestamp": dt.datetime(2024, 1, day), "session_id": f"S{day}", "user_id": f"U{u}"}
        for day in days
        for u in range(day)
    ]
    found = engagement_of(make_events, *events).collect()
    assert [row.wau_approximation for row in found][-2:] == [2 + 3 + 4 + 5 + 6 + 7 + 20, 66]
    assert [row.prev_week_dau for row in found] == [None] * 7 + [1, 2]
    assert found[0].dau_dod_change == 0 and found[6].dau_wow_change == 0
    assert found[7].dau_wow_change == 19.0
    assert found[1].dau_7d_avg == 1.5


def test_sessions_count_on_their_start_date(make_events):
    first, second = engagement_of(
        make_events,
        {"timestamp": "2024-01-10 23:50:00"},
        {"timestamp": "2024-01-11 00:10:00", "event_type": "purchase", "revenue": 9.0},
    ).collect()
    assert (first.total_sessions, first.converted_sessions, first.conversion_rate) == (1, 1, 1.0)
    # no session starts on the second day: null, not zero
    assert (second.total_sessions, second.converted_sessions) == (1, None)
    assert second.conversion_rate is None
    assert (second.avg_order_value, first.avg_order_value) == (9.0, 0.0)


def test_funnel_counts_users_once_per_day(make_events):
    staged = staging.stg_events(
        make_events(
            {"session_id": "S1"},
            {"session_id": "S2"},
            {"session_id": "S2", "event_type": "add_to_cart"},
            {"session_id": "S3", "user_id": "U2", "event_type": "purchase", "revenue": 30.0},
        ),
        AS_OF,
    )
    funnel = facts.fct_funnel(intermediate.int_user_journey(staged), AS_OF)
    day = funnel.first()
    assert (day.users_at_site, day.sessions_at_site, day.users_at_cart) == (1, 2, 1)
    # one user in two drop-off groups
    assert (day.bounced_users, day.cart_abandoned_users, day.converted_users) == (1, 1, 1)
    assert (day.users_at_product, day.product_to_cart_rate) == (0, 0.0)
    assert (day.avg_order_value, day.revenue_per_visitor) == (30.0, 30.0)
    assert day.avg_time_to_cart is None
    assert funnel_order(funnel).first().funnel_check_result == "FAIL: cart > product"


def test_category_revenue_windows(spark, make_events):
    products = [(f"P{i}", "n", "A", "s", float(i), "b", 4.0, 1, True) for i in (10, 20)]
    staged_products = staging.stg_products(spark.createDataFrame(products, schemas.PRODUCTS), AS_OF)
    buy = {"event_type": "purchase", "revenue": 10.0}
    staged = staging.stg_events(
        make_events(
            *[buy | {"timestamp": dt.datetime(2024, 1, d), "category": "A"} for d in range(1, 10)],
            buy | {"timestamp": "2024-01-09 10:00:00", "category": None, "revenue": 30.0},
            buy | {"timestamp": "2024-01-09 11:00:00", "revenue": 0.0},
            {"timestamp": "2024-01-09 12:00:00", "revenue": 99.0},
        ),
        AS_OF,
    )
    revenue = facts.fct_revenue(staged, staged_products, AS_OF)
    last = {r.category: r for r in revenue.collect() if r.event_date == dt.date(2024, 1, 9)}
    assert set(last) == {"A", "Unknown"}
    known, unknown = last["A"], last["Unknown"]
    assert (known.revenue_7d_rolling, known.revenue_30d_rolling) == (70.0, 90.0)
    assert (known.cumulative_revenue, known.prev_week_revenue) == (90.0, 10.0)
    assert (known.category_revenue_share, known.daily_total_revenue) == (0.25, 40.0)
    assert (known.category_avg_price, unknown.category_avg_price) == (15.0, None)
    # two products of the category do not double the transactions
    assert (known.transaction_count, known.revenue_dod_growth) == (1, 0.0)
    assert (unknown.prev_day_revenue, unknown.revenue_dod_growth) == (None, 0.0)

    engagement = facts.fct_daily_engagement(staged, intermediate.int_sessions(staged), AS_OF)
    gap = revenue_consistency(engagement, revenue).collect()
    assert [(r.event_date.day, r.difference) for r in gap] == [(9, 99.0)]


# calendars


def test_calendar_covers_the_default_range(spark):
    days = calendar.dim_date(calendar.calendar_bounds(spark, AS_OF), AS_OF)
    first, last = days.agg(F.min("date_key"), F.max("date_key")).first()
    assert (first, last) == (dt.date(2023, 1, 1), dt.date(2024, 3, 1))
    flags = days.agg(*[F.count_if(f"is_last_{n}_days").alias(f"n{n}") for n in (7, 30, 90)]).first()
    assert tuple(flags) == (7, 30, 90)
    assert [r.date_key.day for r in days.filter("is_today").collect()] == [1]


def test_calendar_values(spark):
    days = calendar.dim_date(calendar.calendar_bounds(spark, AS_OF), AS_OF)
    day = days.filter("date_key = date'2024-02-29'").first()
    assert (day.day_of_week, day.week_of_year, day.day_of_year) == (4, 9, 60)
    assert (day.week_start, day.week_end) == (dt.date(2024, 2, 26), dt.date(2024, 3, 3))
    assert (day.quarter_end, day.year_end) == (dt.date(2024, 3, 31), dt.date(2024, 12, 31))
    assert (day.same_day_last_month, day.same_day_last_year) == (
        dt.date(2024, 1, 29),
        dt.date(2023, 2, 28),
    )
    assert (day.month_name, day.day_short, day.date_us, day.date_eu) == (
        "February",
        "Thu",
        "02/29/2024",
        "29.02.2024",
    )
    assert day.is_month_end and not day.is_month_start


def test_date_ranges(spark):
    start = dt.date(2024, 1, 30)
    assert calendar.date_range(spark, start, days=3).count() == 4
    assert calendar.date_range(spark, start, end=start).count() == 1
    assert calendar.date_range(spark, start, end=dt.date(2024, 1, 1)).count() == 0
    assert calendar.date_range(spark, start, as_of=dt.date(2024, 2, 1)).count() == 3
    with pytest.raises(ValueError, match="needed"):
        calendar.date_range(spark, start)


def test_integer_calendar(spark):
    bounds = spark.sql("select date'2024-01-06' first, date'2024-01-08' last")
    found = calendar.calendar_iso(bounds).orderBy("date")
    assert rows(found, "date_key", "day_of_week", "is_weekend") == [
        (20240106, 5, True),
        (20240107, 6, True),
        (20240108, 0, False),
    ]


# assertions


def test_violations_are_found(make_events):
    events = make_events(
        {"event_id": "E1"},
        {"event_id": "E1", "session_id": None},
        {"event_id": "E2", "event_type": "odd", "device": "tv", "revenue": -1.0},
        {"event_id": "E3", "traffic_source": "radio", "timestamp": moment("2024-01-01")},
    )
    found = violations(staging.stg_events(events, AS_OF), "stg_events").collect()
    broken = {(r.column_name, r.test): r.violations for r in found if r.violations}
    assert broken == {
        ("event_id", "unique"): 1,
        ("session_id", "not_null"): 1,
        ("event_type", "accepted_values"): 1,
        ("device_type", "accepted_values"): 1,
        ("traffic_source", "accepted_values"): 1,
        ("revenue_amount", "accepted_range"): 1,
    }


def test_exclusive_range_and_nulls(spark):
    prices = spark.createDataFrame([(0.0,), (1.0,), (None,)], "price double")
    declared = [a for a in DECLARED["stg_products"] if a.column == "price"]
    found = {r.test: r.violations for r in violations(prices, "stg_products", declared).collect()}
    assert found == {"not_null": 1, "accepted_range": 1}
