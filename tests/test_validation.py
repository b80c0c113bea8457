"""Row rules: the unit cases of the data model and its edge cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlens import schemas
from cartlens.operators.validation import (
    require_validity,
    validate_events,
    validate_products,
    validate_users,
)


def broken(validation):
    return [sorted(row.errors) for row in validation.invalid.select("errors").collect()]


def test_valid_event_is_accepted(make_events):
    checked = validate_events(make_events({}))
    assert checked.valid.count() == 1 and broken(checked) == []


def test_unknown_event_type_is_rejected(make_events):
    assert broken(validate_events(make_events({"event_type": "teleport"}))) == [["event_type"]]


def test_missing_required_columns_reject_every_row(spark):
    events = spark.createDataFrame([("page_view",)], "event_type string")
    assert broken(validate_events(events)) == [
        ["event_id", "properties", "session_id", "timestamp", "user_id"]
    ]


def test_nested_json_properties_are_accepted(make_events):
    text = '{"basket": {"lines": [{"sku": "B7"}]}}'
    assert validate_events(make_events({"properties": text})).valid.count() == 1


def test_negative_revenue_is_rejected(make_events):
    events = make_events({"event_type": "purchase", "revenue": -0.5})
    assert broken(validate_events(events)) == [["revenue"]]


@pytest.mark.parametrize(
    ("properties", "accepted"),
    [
        ("{}", True),
        ('"text"', True),
        (' {"a": [1, {"b": null}]} \n', True),
        ('{"a": 1, "a": 2}', True),
        ("[1]", False),
        ('{"a": NaN, "b": [-Infinity, Infinity]}', True),
        ('{"a": NaN', False),
        ('{"a": Nan}', False),
        ("NaN", False),
        ("null", False),
        ("1", False),
        ("", False),
        (None, False),
        ('{"a": 1', False),
        ('{"a": 1} x', False),
        ('{"a": 1} {"b": 2}', False),
        ('{"a": 1}, {"b": 2}', False),
    ],
)
def test_properties_must_be_one_object_or_string(make_events, properties, accepted):
    checked = validate_events(make_events({"properties": properties}))
    assert (checked.valid.count() == 1) is accepted


@pytest.mark.parametrize(
    ("column", "value", "accepted"),
    [
        ("event_id", "EVT_0f1e2d3c4b5a6978", False),
        ("event_id", "EVT_0F1E2D3C4B5A69780", False),
        ("event_id", None, False),
        ("session_id", None, False),
        ("device", " mobile ", False),
        ("device", None, True),
        ("country", "USA", False),
        ("country", " US ", True),
        ("country", None, True),
        ("traffic_source", "radio", False),
        ("product_id", "PROD_8A7B6C5D", True),
        ("product_id", "PROD_1", False),
        ("revenue", None, False),
        ("revenue", float("nan"), False),
        ("revenue", 100000.0, True),
        ("revenue", 100000.01, False),
    ],
)
def test_event_rules(make_events, column, value, accepted):
    checked = validate_events(make_events({column: value}))
    assert (checked.valid.count() == 1) is accepted


def test_surrounding_whitespace_is_removed_from_text_only(make_events):
    events = make_events({"event_id": " \tEVT_0F1E2D3C4B5A6978 \n", "category": " Toys "})
    row = validate_events(events).valid.first()
    assert (row.event_id, row.category) == ("EVT_0F1E2D3C4B5A6978", "Toys")


def test_absent_revenue_column_means_zero(make_events):
    assert validate_events(make_events({}).drop("revenue")).valid.first().revenue == 0.0


def test_text_columns_are_read_as_moments_and_numbers(make_events):
    texts = [
        ("2024-01-10T10:00:00Z", "5.5"),
        ("2024-01-10T12:00:00+02:00", "1"),
        ("2024", "1"),
        ("yesterday", "1"),
        ("2024-01-10", "much"),
    ]
    spark = make_events({}).sparkSession
    events = make_events({}).drop("timestamp", "revenue").crossJoin(
        spark.createDataFrame(texts, "timestamp string, revenue string")
    )
    checked = validate_events(events)
    good = {(row.timestamp, row.revenue) for row in checked.valid.collect()}
    ten = dt.datetime(2024, 1, 10, 10)
    assert good == {(ten, 5.5), (ten, 1.0)}
    assert sorted(broken(checked)) == [["revenue"], ["timestamp"], ["timestamp"]]


def test_wrong_column_type_is_rejected(make_events):
    events = make_events({}).withColumn("event_id", F.lit(5))
    assert broken(validate_events(events)) == [["event_id"]]


PRODUCT = {
    "product_id": "PROD_8A7B6C5D",
    "product_name": "Test Product",
    "category": "Electronics",
    "subcategory": None,
    "price": 99.99,
    "brand": None,
    "rating": None,
    "review_count": None,
    "in_stock": True,
}


def product(spark, **changes):
    row = PRODUCT | changes
    return spark.createDataFrame([tuple(row[c] for c in schemas.PRODUCTS.names)], schemas.PRODUCTS)


@pytest.mark.parametrize(
    ("changes", "codes"),
    [
        ({}, None),
        ({"price": 0.0}, ["price"]),
        ({"price": None}, ["price"]),
        ({"price": 100000.5}, ["price"]),
        ({"rating": 6.0}, ["rating"]),
        ({"rating": 5.0, "review_count": 0}, None),
        ({"review_count": -1}, ["review_count"]),
        ({"product_name": "  "}, ["product_name"]),
        ({"product_name": "x" * 201}, ["product_name"]),
        ({"category": None}, ["category"]),
        ({"in_stock": None}, ["in_stock"]),
    ],
)
def test_product_rules(spark, changes, codes):
    assert broken(validate_products(product(spark, **changes))) == ([codes] if codes else [])


def test_product_defaults_for_absent_columns(spark):
    columns = ("product_id", "product_name", "category", "price")
    row = validate_products(product(spark).select(*columns)).valid.first()
    assert row.in_stock is True and row.rating is None


def test_fractional_review_count_text(spark):
    base = product(spark).drop("review_count")
    texts = {"3": True, "3.0": True, "3.5": False}
    for text, accepted in texts.items():
        checked = validate_products(base.withColumn("review_count", F.lit(text)))
        assert (checked.valid.count() == 1) is accepted


USER = {
    "user_id": "USER_0000000000B7",
    "segment": "power_buyer",
    "primary_device": "mobile",
    "traffic_source": "organic",
    "country": "US",
    "city": None,
    "created_at": dt.datetime(2024, 1, 1),
    "is_subscribed": False,
    "lifetime_value": 0.0,
}


@pytest.mark.parametrize(
    ("changes", "codes"),
    [
        ({}, None),
        ({"segment": "invalid_segment"}, ["segment"]),
        ({"primary_device": None}, ["primary_device"]),
        ({"country": None}, ["country"]),
        ({"lifetime_value": -1.0}, ["lifetime_value"]),
        ({"lifetime_value": float("nan")}, ["lifetime_value"]),
        ({"created_at": None}, ["created_at"]),
    ],
)
def test_user_rules(spark, changes, codes):
    row = USER | changes
    users = spark.createDataFrame([tuple(row[c] for c in schemas.USERS.names)], schemas.USERS)
    assert broken(validate_users(users)) == ([codes] if codes else [])


def test_empty_input(spark):
    checked = validate_events(spark.createDataFrame([], T.StructType([])))
    figures = checked.result().first()
    assert (figures.total_records, figures.validity_rate) == (0, 0.0)
    assert checked.valid.count() == 0
    with pytest.raises(ValueError, match="only 0.0%"):
        require_validity(figures.asDict())


def test_mixed_input_counts_and_summary(make_events):
    checked = validate_events(make_events({}, {"event_id": "invalid_id", "revenue": -1.0}))
    assert checked.result().first().asDict() == {
        "total_records": 2,
        "valid_records": 1,
        "invalid_records": 1,
        "validity_rate": 50.0,
    }
    summary = {row.rule: row.errors for row in checked.error_summary().collect()}
    assert summary == {"any": 1, "event_id": 1, "revenue": 1}


def test_samples_are_limited_per_rule(make_events):
    events = make_events(*[{"device": "tv"} for _ in range(9)], {"country": "USA"})
    samples = validate_events(events).error_samples("event_id").collect()
    assert sorted(s.rule for s in samples) == ["country"] + ["device"] * 5
    assert all(len(s.data) <= 200 and s.data.startswith('{"event_id"') for s in samples)


def test_fail_fast(make_events):
    assert validate_events(make_events({})).fail_fast().count() == 1
    with pytest.raises(Exception, match="ValidationError: device"):
        validate_events(make_events({"device": "tv"})).fail_fast().collect()


def test_gate_is_strict_about_the_minimum():
    require_validity({"validity_rate": 95.0}, 95.0)
    with pytest.raises(ValueError, match="94.9%.*95.0%"):
        require_validity({"validity_rate": 94.9}, 95.0)


def test_whole_numbers_are_epoch_times(spark, make_events):
    events = make_events({}, {}, {})
    values = [(f"EVT_{i:016X}", v) for i, v in enumerate([1_704_067_200, 1_704_067_200_123, None])]
    numbered = spark.createDataFrame(values, "event_id string, n long")
    events = events.join(numbered, "event_id").withColumn("timestamp", F.col("n")).drop("n")
    checked = validate_events(events)
    assert sorted(str(r.timestamp) for r in checked.valid.collect()) == [
        "2024-01-01 00:00:00",
        "2024-01-01 00:00:00.123000",
    ]
    assert broken(checked) == [["timestamp"]]
    assert broken(validate_events(events.withColumn("timestamp", F.lit(True)))) == [["timestamp"]] * 3


def test_samples_and_invalid_rows_show_what_was_given(spark, make_events):
    given = make_events({}).withColumns(
        {"revenue": F.lit("abc"), "timestamp": F.lit("not a time"), "device": F.lit(None).cast("string")}
    )
    validation = validate_events(given)
    row = validation.invalid.first()
    assert (row.revenue, row.timestamp) == (None, None)
    assert (row.raw.revenue, row.raw.timestamp) == ("abc", "not a time")
    short = given.select("event_id", "timestamp", "revenue", "device")
    found = {s.rule: s.data for s in validate_events(short).error_samples("event_id").collect()}
    assert '"timestamp":"not a time","device":null,"revenue":"abc"' in found["revenue"]
    assert found["revenue"] == found["timestamp"]
