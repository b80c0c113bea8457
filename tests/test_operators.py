"""Operators against brute force."""

from __future__ import annotations

import datetime as dt
import decimal as dec
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartlens.operators.ranking import continuous_percentiles, with_ntile, with_ntiles
from cartlens.operators.rollup import distinct_counts, least, most, rollup, rollup_by, row_count, total
from cartlens.operators.sessionize import gap_sessions, with_gap_sessions


@pytest.mark.parametrize("size", [0, 1, 3, 5, 7, 1003])
@pytest.mark.parametrize("values", [3, 400])
def test_ntile_equals_the_window_function(spark, size, values):
    random.seed(size)
    rows = [(f"U{i:05d}", random.randrange(values)) for i in range(size)]
    random.shuffle(rows)
    users = spark.createDataFrame(rows, "user_id string, x bigint").repartition(6)
    ours = with_ntile(users, 5, "x", "user_id", "tile")
    plain = users.withColumn("tile", F.ntile(5).over(Window.orderBy("x", "user_id")))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_ntile_with_one_value_for_a_third_of_all_rows(spark):
    users = spark.range(30000).select(
        F.format_string("U%06d", "id").alias("user_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("decimal(18,2)").alias("x"),
    )
    tiles = with_ntile(users, 5, "x", "user_id", "tile").groupBy("tile").count().collect()
    assert sorted(map(tuple, tiles)) == [(tile, 6000) for tile in range(1, 6)]


def test_ntile_puts_nulls_first(spark):
    users = spark.createDataFrame(
        [("a", None), ("b", 1), ("c", None), ("d", 2)], "user_id string, x bigint"
    )
    ours = with_ntile(users, 3, "x", "user_id", "tile").collect()
    plain = users.withColumn("tile", F.ntile(3).over(Window.orderBy("x", "user_id"))).collect()
    assert sorted(map(str, ours)) == sorted(map(str, plain))


def test_several_ntiles_from_one_sort(spark):
    random.seed(8)
    rows = [(f"U{i:05d}", random.randrange(9), random.choice([None, 1.5, random.random()])) for i in range(503)]
    users = spark.createDataFrame(rows, "user_id string, x bigint, y double").repartition(6)
    ours = with_ntiles(users, 4, {"a": "x", "b": "y"}, "user_id")
    plain = users.withColumns(
        {n: F.ntile(4).over(Window.orderBy(v, "user_id")) for n, v in (("a", "x"), ("b", "y"))}
    )
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


FRACTIONS = [0.0, 0.05, 0.5, 0.9, 0.999, 1.0]


def percentiles(df, accuracy=10_000):
    found = continuous_percentiles(df, "x", FRACTIONS, accuracy)
    return df.sparkSession.range(1).select(found.alias("found")).first()["found"]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 10, 997])
@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_percentiles_interpolate(spark, size, accuracy):
    random.seed(size)
    values = [round(random.expovariate(0.1), 2) for _ in range(size)]
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, x double").repartition(5)
    assert percentiles(df, accuracy) == pytest.approx(np.quantile(values, FRACTIONS).tolist())


@pytest.mark.parametrize("accuracy", [10_000, 200, 20])
def test_percentiles_of_many_rows_with_ties(spark, accuracy):
    df = spark.range(0, 200_000, numPartitions=13).select(
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(10**6)) / 100).alias("x")
    )
    values = [row.x for row in df.collect()]
    assert percentiles(df, accuracy) == pytest.approx(np.quantile(values, FRACTIONS).tolist())


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([(1, None)], "id bigint, x double")
    assert percentiles(empty) == [None] * len(FRACTIONS)


def test_distinct_counts_equal_count_distinct(spark):
    random.seed(5)
    rows = [
        (
            random.choice("abc"),
            random.choice(["u1", "u2", "u3", None]),
            random.randrange(40),
            random.random() < 0.3,
        )
        for _ in range(800)
    ]
    df = spark.createDataFrame(rows, "k string, user string, item int, hit boolean")
    counts = {
        "users": ("user", None),
        "hit_users": ("user", "hit"),
        "items": ("item", None),
        "low_items": ("item", "low"),
        "hit_items": ("item", "hit"),
    }
    flags = {"hit": F.col("hit"), "low": F.col("item") < 7}
    ours = distinct_counts(df, ["k"], counts, flags)
    plain = df.groupBy("k").agg(
        F.countDistinct("user").alias("users"),
        F.countDistinct(F.when(flags["hit"], F.col("user"))).alias("hit_users"),
        F.countDistinct("item").alias("items"),
        F.countDistinct(F.when(flags["low"], F.col("item"))).alias("low_items"),
        F.countDistinct(F.when(flags["hit"], F.col("item"))).alias("hit_items"),
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_groups_without_entities_and_null_keys_stay(spark):
    df = spark.createDataFrame(
        [("a", None), (None, "u1"), (None, "u2")], "k string, user string"
    )
    both = rollup(df, ["k"], {"n": row_count()}, {"users": ("user", None)})
    assert sorted(map(str, map(tuple, both.collect()))) == ["('a', 1, 0)", "(None, 2, 2)"]


def some_measures():
    return {
        "n": row_count(),
        "hits": row_count(F.col("hit")),
        "first": least("item"),
        "last": most("user"),
        "paid": total("price"),
        "hits_paid": total("price", F.col("hit")),
    }


def test_measures_ride_with_distinct_counts(spark):
    random.seed(6)
    rows = [
        (
            random.choice(["a", "b", None]),
            random.choice(["u1", "u2", None]),
            random.choice([*range(9), None]),
            random.choice([True, False, None]),
            random.choice([None, dec.Decimal("1.25"), dec.Decimal("99999999.99")]),
        )
        for _ in range(600)
    ]
    df = spark.createDataFrame(rows, "k string, user string, item int, hit boolean, price decimal(10,2)")
    counts = {"users": ("user", None), "items": ("item", "hit")}
    plain = [
        F.count(F.lit(1)).alias("n"),
        F.count_if("hit").alias("hits"),
        F.min("item").alias("first"),
        F.max("user").alias("last"),
        F.sum("price").alias("paid"),
        F.sum(F.when(F.col("hit"), F.col("price")).otherwise(F.col("price") * 0)).cast("decimal(20,2)").alias("hits_paid"),
        F.countDistinct("user").alias("users"),
        F.countDistinct(F.when(F.col("hit"), F.col("item"))).alias("items"),
    ]
    for frame in (df, df.limit(0)):
        for keys in (["k"], []):
            wanted = frame.groupBy(*keys).agg(*plain)
            for fine in (False, True) if keys else (False,):
                ours = rollup(frame, keys, some_measures(), counts, {"hit": F.col("hit")}, fine)
                # a product of decimals has another type
                assert ours.dtypes[:-3] == wanted.dtypes[:-3]
                assert sorted(map(str, ours.collect())) == sorted(map(str, wanted.collect()))


def test_rollup_by_label(spark):
    rows = [("a", "u1", 1, True), ("a", "u2", 2, None), ("b", "u1", 3, False), (None, "u3", 4, True)]
    df = spark.createDataFrame(rows, "k string, user string, item int, hit boolean")
    measures = some_measures()
    for name in ("paid", "hits_paid"):
        del measures[name]
    found = rollup_by(df, "k", measures, {"users": ("user", None)})
    assert found.columns == ["k", "count", "n", "hits", "first", "last", "users"]
    assert sorted(map(tuple, found.collect())) == [("a", 2, 4, 2, 1, "u3", 3), ("b", 1, 4, 2, 1, "u3", 3)]
    assert rollup_by(df.limit(0), "k", measures, {"users": ("user", None)}).collect() == []


def brute_force_sessions(events):
    """Session start of every event by walking each user's events in order."""
    starts, last, current = {}, {}, {}
    for event, user, time in sorted(events, key=lambda e: e[2]):
        if user not in last or (time - last[user]).total_seconds() >= 1800:
            current[user] = time
        last[user] = time
        starts[event] = current[user]
    return starts


def test_gap_sessions_equal_brute_force(spark):
    random.seed(11)
    base = dt.datetime(2024, 1, 1)
    events, number = [], 0
    # one user has a third of all events
    for user, size in [("hot", 400), *[(f"u{i}", 40) for i in range(20)]]:
        time = base
        for _ in range(size):
            time += dt.timedelta(seconds=random.choice([0, 5, 900, 1799, 1800, 1801, 7200]))
            number += 1
            events.append((f"e{number}", user, time))
    df = spark.createDataFrame(events, "event_id string, user_id string, timestamp timestamp_ntz")
    expected = brute_force_sessions(events)

    marked = with_gap_sessions(df).collect()
    assert len(marked) == len(events)
    by_session = {}
    for row in marked:
        by_session.setdefault(row.session_id, set()).add((row.user_id, expected[row.event_id]))
    assert all(len(starts) == 1 for starts in by_session.values())

    sessions = gap_sessions(df).collect()
    wanted = {}
    for event, user, _ in events:
        wanted[(user, expected[event])] = wanted.get((user, expected[event]), 0) + 1
    assert {(s.user_id, s.session_start): s.event_count for s in sessions} == wanted
    assert len(by_session) == len(sessions)


def test_a_gap_of_exactly_the_timeout_opens_a_session(make_events):
    events = make_events(
        {"timestamp": "2024-01-10 10:00:00"},
        {"timestamp": "2024-01-10 10:29:59.999999"},
        {"timestamp": "2024-01-10 10:59:59.999999"},
    )
    sessions = gap_sessions(events).orderBy("session_start").collect()
    assert [(s.session_number, s.event_count) for s in sessions] == [(1, 2), (2, 1)]
