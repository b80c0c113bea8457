"""Trailing counts, histories, incremental marts and streams against plain versions."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cartlens.operators import history
from cartlens.operators.sessionize import gap_sessions
from cartlens.operators.trailing import trailing_distinct
from cartlens.operators.validation import validate_events
from cartlens.plans import facts, incremental, intermediate, staging
from cartlens.sources.testbed import AS_OF
from cartlens.streaming import sessions as stream
from verification import queries

DAY = dt.timedelta(days=1)
START = dt.date(2024, 1, 1)


@pytest.mark.parametrize("days", [1, 2, 7, 40])
def test_trailing_distinct(spark, days):
    random.seed(days)
    rows = [(random.choice([*"abcdef", None]), START + random.choice([0, 1, 2, 5, 9, 12, 13, 30, 31]) * DAY) for _ in range(60)]
    rows += [("hot", START + i % 3 * DAY) for i in range(300)] + [("a", None)]
    df = spark.createDataFrame(rows, "user string, day date").repartition(5)
    found = trailing_distinct(df, "user", "day", {"n": days, "one": 1})
    known = [(user, day) for user, day in rows if user is not None and day is not None]
    wanted = {
        (day, len({u for u, d in known if day - days * DAY < d <= day}), len({u for u, d in known if d == day}))
        for _, day in known
    }
    assert {tuple(r) for r in found.collect()} == wanted
    assert trailing_distinct(df.limit(0), "user", "day", {"n": days}).collect() == []


def plain_history(snapshots):
    versions: dict[str, list] = {}
    for at, rows in snapshots:
        for key in {*rows, *versions}:
            own = versions.setdefault(key, [])
            current = own[-1] if own and own[-1][3] is None else None
            if current and rows.get(key) != current[0]:
                current[3] = at
                current = None
            if key in rows and not current:
                own.append([rows[key], len(own) + 1, at, None])
    return {(key, *value, n, start, end) for key, own in versions.items() for value, n, start, end in own}


def test_history_of_snapshots(spark):
    random.seed(3)
    snapshots = []
    for i in range(5):
        rows = {f"k{k}": (random.choice(["x", "y", None]), random.choice([1, None])) for k in range(30) if random.random() < 0.8}
        snapshots.append((dt.datetime(2024, 1, 1 + i), rows))
    found = None
    for at, rows in snapshots:
        df = spark.createDataFrame([(k, *v) for k, v in rows.items()], "key string, a string, b int")
        found = history.first_version(df, "key", at) if found is None else history.with_snapshot(found, df, "key", at)
    names = ["key", "a", "b", "version", "valid_from", "valid_to"]
    wanted = plain_history(snapshots)
    assert {tuple(r) for r in found.select(names).collect()} == wanted and found.count() == len(wanted)

    times = [dt.datetime(2023, 12, 31), *[dt.datetime(2024, 1, d, h) for d in range(1, 7) for h in (0, 7)]]
    facts_ = [(f"k{k}", at, n) for n, (k, at) in enumerate((k, at) for k in range(31) for at in times)]
    df = spark.createDataFrame(facts_, "key string, at timestamp_ntz, n int")
    joined = {r["n"]: (r["a"], r["version"]) for r in history.as_of_join(df, found, "key", "at", ["a", "version"]).collect()}
    for key, at, n in facts_:
        valid = [(v[1], v[3]) for v in wanted if v[0] == key and v[4] <= at and (v[5] is None or at < v[5])]
        assert joined[n] == (valid[0] if valid else (None, None))


def test_marts_follow_new_events(spark, tmp_path, make_events):
    random.seed(4)
    kinds = ["page_view", "product_view", "add_to_cart", "begin_checkout", "purchase"]
    rows = []
    for i in range(400):
        kind = random.choice(kinds)
        user = random.randrange(40)
        rows.append(
            {
                "event_id": f"EVT_{i:016X}",
                "event_type": kind,
                "user_id": f"U{user}",
                "session_id": random.choice([f"S{user}-{random.randrange(9)}", None, f"S{user}"]),
                "timestamp": str(dt.datetime(2024, 1, random.choice([1, 2, 3, 8, 20]), random.randrange(24))),
                "category": random.choice(["A", "B", None]),
                "product_id": "P",
                "revenue": 5.0 if kind == "purchase" else 0.0,
            }
        )
    store, products = str(tmp_path), spark.createDataFrame([("A", 2.0)], "category string, price double")
    for batch, part in (("a", rows[:200]), ("b", rows[200:390]), ("c", rows[390:]), ("c", rows[390:])):
        days = incremental.add_events(spark, store, make_events(*part), batch)
        assert days == sorted({dt.date.fromisoformat(r["timestamp"][:10]) for r in part})
        incremental.refresh(spark, store, days, AS_OF)
    staged = staging.stg_events(make_events(*rows), AS_OF)
    for found, whole in (
        (incremental.funnel_mart(spark, store, AS_OF), facts.fct_funnel(intermediate.int_user_journey(staged), AS_OF)),
        (incremental.revenue_mart(spark, store, products, AS_OF), facts.fct_revenue(staged, products, AS_OF)),
        (
            incremental.engagement_mart(spark, store, AS_OF),
            facts.fct_daily_engagement(staged, intermediate.int_sessions(staged), AS_OF),
        ),
    ):
        columns = sorted(whole.columns)
        assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))


def test_late_events_move_join_and_end_sessions(spark, tmp_path, make_events):
    """Over midnight, backwards over midnight, and beyond the longest session."""

    def event(i, user, time):
        return {"event_id": f"EVT_{i:016X}", "user_id": user, "session_id": f"S{user}", "timestamp": f"2024-01-{time}"}

    first = [event(1, "a", "05 23:00:00"), event(2, "b", "06 01:00:00"), event(3, "c", "02 10:00:00"), event(4, "d", "01 10:00:00"), event(5, "d", "04 10:00:00")]
    later = [event(6, "a", "06 00:30:00"), event(7, "b", "05 23:30:00"), event(8, "c", "09 10:00:00"), event(9, "d", "09 10:00:00")]
    store, seen = str(tmp_path), []
    for batch, part in (("a", first), ("b", later)):
        seen += part
        days = incremental.add_events(spark, store, make_events(*part), batch)
        incremental.refresh(spark, store, days, AS_OF)
        staged = staging.stg_events(make_events(*seen), AS_OF)
        whole = facts.fct_daily_engagement(staged, intermediate.int_sessions(staged), AS_OF)
        found = incremental.engagement_mart(spark, store, AS_OF).select(whole.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    rows = spark.read.parquet(f"{store}/session_days")
    again = incremental.sessions_to_date_again(rows, days)
    assert [x.day for x in again] == [2, 5, 6, 9]  # not the days of d, whose session was too long before
    assert {r.session_date.day: r.sessions for r in spark.read.parquet(f"{store}/daily_sessions").collect()}[2] is None


def test_only_new_days_are_computed(spark, tmp_path, make_events):
    store = str(tmp_path)
    first = make_events({"timestamp": "2024-01-01 10:00:00"}, {"timestamp": "2024-01-02 10:00:00"})
    incremental.refresh(spark, store, incremental.add_events(spark, store, first, "a"), AS_OF)
    before = {path.name: path.stat().st_mtime_ns for path in tmp_path.glob("daily_funnel/event_date=2024-01-01/part*")}
    late = make_events({"event_id": "EVT_00000000000000FF", "timestamp": "2024-01-02 11:00:00"})
    days = incremental.add_events(spark, store, late, "b")
    assert days == [dt.date(2024, 1, 2)]
    incremental.refresh(spark, store, days, AS_OF)
    after = {path.name: path.stat().st_mtime_ns for path in tmp_path.glob("daily_funnel/event_date=2024-01-01/part*")}
    assert before and before == after


def test_streams_go_on_where_they_stopped(spark, tmp_path, make_events):
    def arrive(number, *rows):
        make_events(*rows).coalesce(1).write.parquet(f"{tmp_path}/in/events_{number}.parquet")

    def run():
        events = stream.event_stream(spark, f"{tmp_path}/in", files_per_batch=1)
        closed = stream.closed_sessions(stream.deduplicated(events))
        return stream.run_available(closed, f"{tmp_path}/out", f"{tmp_path}/state")

    def event(i, time):
        return {"event_id": f"EVT_{i:016X}", "timestamp": f"2024-01-10 {time}"}

    arrive(1, event(1, "10:00:00"), event(2, "10:29:59"), event(3, "10:59:59"), event(2, "10:29:59"))
    assert run().collect() == []  # all may still go on
    # a repetition, a late event of the second session, and one that moves the watermark
    arrive(2, event(1, "10:00:00"), event(4, "11:10:00"), event(5, "15:00:00"))
    found = run()
    assert sorted((str(r.session_start)[11:], str(r.session_end)[11:], r.event_count) for r in found.collect()) == [
        ("10:00:00", "10:29:59", 2),
        ("10:59:59", "11:10:00", 2),
    ]
    whole = spark.read.parquet(f"{tmp_path}/in/events_*.parquet").dropDuplicates(["event_id"])
    batch = gap_sessions(whole).filter("session_start < timestamp_ntz'2024-01-10 15:00:00'")
    names = ["user_id", "session_start", "session_end", "event_count"]
    assert sorted(map(tuple, found.select(names).collect())) == sorted(map(tuple, batch.select(names).collect()))


def test_a_week_arrives_from_several_tasks(spark, tmp_path, monkeypatch):
    def event(i, time, user=7, kind="click"):
        return i, dt.datetime.fromisoformat(f"2024-01-{time}"), user, kind, 1.0, '{"k": 1}'

    first = [event(1, "07 23:40:00", kind="purchase"), event(2, "01 09:00:00"), event(3, "01 09:20:00"), event(4, "05 10:00:00", 8)]
    later = [event(5, "08 00:05:00"), event(6, "14 12:00:00", 8), event(7, "14 12:30:00", 8), event(8, "20 08:00:00"), event(9, "29 08:00:00")]
    # a file per row, in no order of time
    for row in first + later:
        events = spark.createDataFrame([row], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
        events.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    parts = spark.range(20).selectExpr("id AS p_partkey", "'a kind' AS p_type")
    parts.write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(queries, "_batch_folder", lambda t: f"{tmp_path}/batch")
    found = queries.QUERIES["streamed_sessions"](spark, str(tmp_path)).collect()
    # the session over the end of the week is whole, the last event may still be followed
    assert sorted((r.user_id[-1], r.session_start[8:16], r.session_end[8:16], r.event_count) for r in found) == [
        ("7", "01 09:00", "01 09:20", 2),
        ("7", "07 23:40", "08 00:05", 2),
        ("7", "20 08:00", "20 08:00", 1),
        ("8", "05 10:00", "05 10:00", 1),
        ("8", "14 12:00", "14 12:00", 1),
        ("8", "14 12:30", "14 12:30", 1),
    ]
    # no task writes a whole week
    assert len(list(tmp_path.glob("batch/in/events_0.parquet/part-*"))) > 1


def test_iso_texts_without_separators(spark):
    texts = ["20240102", "20240102T030405", "20240102 030405", "2024-01-02T03:04:05.5", "20240102T030405Z", "2024010", "20240102x"]
    df = spark.createDataFrame([(f"EVT_{i:016X}", t) for i, t in enumerate(texts)], "event_id string, timestamp string")
    found = validate_events(df).checked.orderBy("event_id").select(F.col("timestamp").cast("string").alias("t")).collect()
    assert [r.t for r in found] == [
        "2024-01-02 00:00:00", "2024-01-02 03:04:05", "2024-01-02 03:04:05", "2024-01-02 03:04:05.5",
        "2024-01-02 03:04:05", None, None,
    ]
