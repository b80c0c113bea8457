"""Flat tables, dashboard queries, helpers, files and the two jobs."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cartlens import schemas
from cartlens.functions import metrics, values
from cartlens.plans import dashboard, flat
from cartlens.operators.validation import validate_events
from cartlens.plans import job
from cartlens.plans.job import run_flat_job, run_layered_job
from cartlens.sources.runs import Run
from cartlens.sources import tables, testbed
from cartlens.sources.testbed import AS_OF, raw_events, raw_products, raw_users
from tests.conftest import rows
from verification import queries

SF = "/root/testdata/sf0.001"


def test_flat_sessions_take_the_first_known_value(make_events):
    session = flat.flat_sessions(
        make_events(
            {"timestamp": "2024-01-10 10:00:00.250000", "country": None, "device": "tablet"},
            {"timestamp": "2024-01-10 10:00:01", "country": "FR", "device": "mobile"},
            {"timestamp": "2024-01-12 10:00:02", "country": "DE", "event_type": "purchase"},
        )
    ).first()
    assert (session.countries, session.devices, session.is_converted) == ("FR", "tablet", True)
    # fractional seconds and no limit on the length
    assert session.session_duration_seconds == 2 * 86400 + 1.75


def test_flat_events_count_weekdays_from_monday(make_events):
    event = flat.flat_events(make_events({"timestamp": "2024-01-07 10:00:00"})).first()
    assert (event.day_of_week, event.is_weekend) == (6, True)


def test_flat_conversion_is_purchases_per_session(make_events):
    buy = {"event_type": "purchase", "revenue": 5.0}
    day = flat.flat_daily_metrics(make_events(buy, buy, buy)).first()
    assert (day.conversion_rate, day.avg_revenue_per_user) == (3.0, 15.0)


def test_flat_products_drop_null_categories_and_divide_by_one(make_events):
    found = flat.flat_product_performance(
        make_events(
            {"product_id": "P1", "category": None, "event_type": "remove_from_cart"},
            {"product_id": "P1", "category": "A", "event_type": "purchase"},
            {"product_id": "P1", "category": "A", "event_type": "purchase"},
        )
    ).collect()
    assert [(r.view_count, r.purchases, r.purchase_rate) for r in found] == [(0, 2, 2.0)]


def test_metric_summary(make_events):
    found = flat.metric_summary(
        make_events(
            {"event_type": "product_view"},
            {"event_type": "add_to_cart"},
            {"event_type": "purchase", "revenue": 8.0},
            {"event_type": "purchase", "revenue": 0.0},
        )
    ).collect()
    assert {r.event_type: r.events for r in found} == {"product_view": 1, "add_to_cart": 1, "purchase": 2}
    found = found[0]
    assert (found.total_revenue, found.avg_order_value) == (8.0, 8.0)
    assert (found.view_to_cart_rate, found.cart_to_purchase_rate) == (1.0, 2.0)


def test_metric_summary_tolerates_missing_columns(make_events):
    found = flat.metric_summary(make_events({}).select("event_id")).first().asDict()
    assert found == {"total_events": 1, "unique_users": 0, "unique_sessions": 0}


def daily(spark, *rows_):
    return spark.createDataFrame(
        [(dt.date(2024, 1, day), users, sessions, revenue, buys) for day, users, sessions, revenue, buys in rows_],
        "event_date date, unique_users bigint, unique_sessions bigint, total_revenue double, "
        "purchases bigint",
    )


def test_latest_figures(spark):
    found = dashboard.kpi_latest(daily(spark, (1, 10, 0, 5.0, 1), (3, 15, 0, 0.0, 4))).first()
    assert (found.unique_users_change, found.total_revenue_change) == (0.5, -1.0)
    assert (found.unique_sessions_change, found.conversion_rate) == (None, 0.0)
    only = dashboard.kpi_latest(daily(spark, (1, 10, 5, 5.0, 1))).first()
    assert only.unique_users_change is None and only.conversion_rate == 0.2


def test_trend_keeps_one_date_more(spark):
    days = daily(spark, *[(d, 1, 0, 1.0, 2) for d in range(1, 21)])
    assert dashboard.trend(days, 7).count() == 8
    assert dashboard.trend(days).count() == 20
    assert dashboard.trend(days, 7).first().conversion_rate == 2.0


def test_funnel_falls_back_to_purchases(spark):
    days = spark.createDataFrame(
        [(10, 5, 2, 1), (10, 5, 0, 1)],
        "page_views bigint, product_views bigint, add_to_carts bigint, purchases bigint",
    )
    found = dashboard.funnel_overall(days).orderBy("position")
    assert rows(found, "count", "conversion_rate", "step_rate") == [
        (20, 1.0, None),
        (10, 0.5, 0.5),
        (2, 0.1, 0.2),
        (2, 0.1, 1.0),
        (2, 0.1, 1.0),
    ]
    with_checkouts = dashboard.funnel_overall(days.withColumn("checkout_starts", F.lit(3)))
    assert with_checkouts.filter("position = 4").first()["count"] == 6


def test_histogram_and_quality(spark):
    sessions = spark.createDataFrame([(0.0,), (71.9,), (72.0,), (3599.0,), (3600.0,)], "session_duration_seconds double")
    found = dashboard.duration_histogram(sessions)
    assert rows(found, "bin", "sessions") == [(0, 2), (1, 1), (49, 1)]
    assert dashboard.sessions_by_quality(sessions).collect() == []


def test_metric_expressions(spark):
    df = spark.createDataFrame(
        [(1, 2), (1, 0), (1, None), (1, -2), (None, 2)], "num bigint, den bigint"
    )
    found = rows(
        df,
        metrics.rate("num", "den"),
        metrics.growth("num", "den"),
        metrics.safe_divide("num", "den", 7),
        metrics.per_at_least_one("num", "den"),
    )
    assert found == [
        (0.5, -0.5, 0.5, 0.5),
        (0.0, 0.0, 7.0, 1.0),
        (0.0, 0.0, 7.0, None),
        (0.0, 0.0, -0.5, -0.5),
        (None, None, None, None),
    ]


def test_value_helpers(spark):
    df = spark.sql("select 'hello' t, ' \t x y \n' s, '[1, 2]' a, 'no json' n, '{\"k\": 5}' j")
    found = df.select(
        values.hash_key("t"),
        values.stripped("s"),
        values.json_or_empty("a").cast("string"),
        values.json_or_empty("n").cast("string"),
        F.variant_get(values.json_or_empty("j"), "$.k", "int"),
    ).first()
    assert tuple(found) == ("5D41402A", "x y", "[1,2]", "{}", 5)


def test_flatten_record(spark):
    df = spark.sql(
        "select named_struct('a', named_struct('b', 1, 'c', array(2)), 'x.y', 3) r, 4 s"
    )
    found = values.flatten_record(df)
    assert found.columns == ["r_a_b", "r_a_c", "r_x.y", "s"]
    assert tuple(found.first()) == (1, [2], 3, 4)


# files and jobs


def test_event_files_are_read_together(spark, tmp_path, make_events):
    folder = str(tmp_path)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        tables.read_event_files(spark, folder).count()
    for day in ("20240101", "20240102"):
        tables.write_file(make_events({}), folder, f"events_{day}")
    tables.write_file(make_events({}), folder, "other")
    assert tables.read_event_files(spark, folder, schemas.EVENTS).count() == 2


def test_absent_tables_are_tolerated(spark, tmp_path, make_events):
    folder = str(tmp_path)
    assert tables.load_flat_tables(spark, folder) == {}
    tables.write_file(make_events({}), folder, "fct_events")
    assert list(tables.load_flat_tables(spark, folder)) == ["fct_events"]
    assert tables.read_file(spark, folder, "fct_sessions") is None


def test_export_drops_mail_addresses(spark, tmp_path):
    users = spark.createDataFrame([("U", "a@b.c")], "user_id string, email string")
    products = spark.createDataFrame([("P",)], "product_id string")
    tables.export_reference_data(products, users, str(tmp_path))
    assert tables.read_file(spark, str(tmp_path), "users").columns == ["user_id"]
    assert tables.read_file(spark, str(tmp_path), "products").count() == 1


def test_catalog_tables_are_replaced(spark):
    tables.create_namespaces(spark)
    for size in (3, 2):
        tables.write_table(spark.range(size), "replaced", "staging")
    assert tables.source(spark, "staging", "replaced").count() == 2


def test_flat_job(spark, tmp_path):
    raw = raw_events(spark, SF)
    raw.write.parquet(f"{tmp_path}/in/events_all.parquet")
    places = f"{tmp_path}/in", f"{tmp_path}/out"
    done = run_flat_job(spark, *places, AS_OF)
    loaded = tables.load_flat_tables(spark, places[1])
    assert list(loaded) == list(tables.FLAT_TABLES)
    assert done.loaded == {name: df.count() for name, df in loaded.items()}
    assert {r["check"] for r in done.issues.collect()} >= {"null_rate", "revenue_outliers"}
    assert spark.table("analytics.fct_sessions").count() == done.loaded["fct_sessions"]
    row = done.record(spark).first()
    assert row.records_extracted == row.records_validated == raw.count()
    assert row.records_loaded == sum(done.loaded.values()) and row.validity_rate == 100.0
    assert row.quality_issues_count == done.issues.count() and row.errors_count == 0
    assert row.duration_seconds > 0 and row.start_time < row.end_time
    # a second run replaces the tables
    assert run_flat_job(spark, *places, AS_OF).loaded == done.loaded
    assert spark.table("analytics.fct_sessions").count() == done.loaded["fct_sessions"]


def test_flat_job_stops_at_the_gate(spark, tmp_path, make_events):
    good = [{} for _ in range(8)]
    tables.write_file(make_events(*good, {"device": "tv"}), f"{tmp_path}/in", "events_1")
    with pytest.raises(ValueError, match="88.9%.*95.0%") as caught:
        run_flat_job(spark, f"{tmp_path}/in", f"{tmp_path}/out", AS_OF, catalog=False)
    failed = caught.value.run.record(spark).first()
    assert (failed.errors_count, failed.records_extracted, failed.records_loaded) == (1, 9, 0)
    assert tables.load_flat_tables(spark, f"{tmp_path}/out") == {}


def test_a_failed_run_leaves_the_tables_of_the_one_before(spark, tmp_path, make_events, monkeypatch):
    places = f"{tmp_path}/in", f"{tmp_path}/out"
    view = {"event_type": "product_view", "product_id": "PROD_0000000A", "category": "A"}
    tables.write_file(make_events(view, {}), places[0], "events_1")
    first = run_flat_job(spark, *places, AS_OF, catalog=False, run_name="day")

    tables.write_file(make_events(view, {}, {}), places[0], "events_1")
    monkeypatch.setattr(job, "TABLES_AT_ONCE", 1)
    with monkeypatch.context() as broken:
        broken.setattr(flat, "flat_product_performance", lambda events: events.select(F.raise_error(F.lit("down"))))
        with pytest.raises(Exception, match="down") as caught:
            run_flat_job(spark, *places, AS_OF, catalog=False, run_name="day")
    assert caught.value.run.loaded == {}
    counts = {name: df.count() for name, df in tables.load_flat_tables(spark, places[1]).items()}
    assert counts == first.loaded and counts["fct_events"] == 2

    # complete tables are not written again
    monkeypatch.setattr(flat, "flat_events", lambda events: events.select(F.raise_error(F.lit("again"))))
    second = run_flat_job(spark, *places, AS_OF, catalog=False, run_name="day")
    assert second.loaded["fct_events"] == 3 and second.validity["total_records"] == 3
    counts = {name: df.count() for name, df in tables.load_flat_tables(spark, places[1]).items()}
    assert counts == second.loaded
    # a run that is published already is left as it is
    third = run_flat_job(spark, *places, AS_OF, catalog=False, run_name="day")
    assert third.loaded == second.loaded


def test_a_table_of_earlier_runs_only_is_absent(spark, tmp_path, make_events):
    places = f"{tmp_path}/in", f"{tmp_path}/out"
    view = {"event_type": "product_view", "product_id": "PROD_0000000A", "category": "A"}
    for rows_, known in (((view,), True), (({},), False)):
        tables.write_file(make_events(*rows_), places[0], "events_1")
        run_flat_job(spark, *places, AS_OF, catalog=False)
        assert (tables.read_file(spark, places[1], "fct_product_performance") is not None) == known


def test_only_complete_tables_are_published(spark, tmp_path):
    run = Run(spark, str(tmp_path), "r")
    run.write(spark.range(3), "a")
    with pytest.raises(ValueError, match="not written yet: b"):
        run.publish(["a", "b"])
    assert tables.read_file(spark, str(tmp_path), "a") is None
    again = Run(spark, str(tmp_path), "r")
    assert again.loaded == {"a": 3} and not Run(spark, str(tmp_path), "r", "other inputs").has("a")
    again.write(spark.range(2), "b")
    again.publish(["a", "b"])
    assert [tables.read_file(spark, str(tmp_path), x).count() for x in "ab"] == [3, 2]
    other = Run(spark, str(tmp_path), "r", "other inputs")
    assert other.folder != again.folder and not other.published


def test_flat_job_options(spark, tmp_path, make_events):
    warnings: list[str] = []
    later = {"timestamp": "2024-03-01 00:00:00"}
    tables.write_file(make_events(later, {}), f"{tmp_path}/in", "events_1")
    places = f"{tmp_path}/in", f"{tmp_path}/out"
    run_flat_job(spark, *places, AS_OF, catalog=False, warn=warnings.append)
    assert warnings == ["Found 1 events with future timestamps"]
    # no product events: no product table
    assert "fct_product_performance" not in tables.load_flat_tables(spark, places[1])
    assert run_flat_job(spark, *places, AS_OF, quality_checks=False, catalog=False).issues is None


def test_files_with_different_columns(spark, tmp_path, make_events):
    folder = f"{tmp_path}/in"
    tables.write_file(make_events({"event_type": "purchase", "revenue": 5.0}), folder, "events_1")
    tables.write_file(make_events({}, {}).drop("revenue"), folder, "events_2")
    tables.write_file(make_events({}).drop("session_id"), folder, "events_3")
    events = tables.read_event_files(spark, folder)
    assert sorted(events.columns) == sorted(make_events({}).columns)
    figures = validate_events(events).result().first()
    assert (figures.total_records, figures.valid_records) == (4, 1)


def test_rows_are_numbered_over_all_files(spark, tmp_path, make_events):
    rows_ = [{"event_id": f"EVT_{i:016X}", "device": "tv" if i % 3 == 0 else "mobile"} for i in range(30)]
    for number, (start, end) in enumerate([(0, 7), (7, 7), (7, 20), (20, 30)]):
        part = make_events(*rows_[start:end]).coalesce(1).sortWithinPartitions("event_id")
        part.write.option("parquet.block.size", 1024).parquet(f"{tmp_path}/events_{number}.parquet")
    events = tables.read_event_files(spark, str(tmp_path), places=True)
    place = [tables.FILE, tables.ROW_IN_FILE]
    numbered = tables.with_row_numbers(events.select("event_id", *place), events)
    assert sorted((r["row"], r["event_id"]) for r in numbered.collect()) == [(i, f"EVT_{i:016X}") for i in range(30)]
    found = tables.with_row_numbers(validate_events(events).first_errors(place, 4), events).orderBy("row").collect()
    assert [(r["position"], r["row"], r["rule"]) for r in found] == [(i + 1, 3 * i, "device") for i in range(4)]
    assert found[1]["message"] == "ValidationError: device"
    assert found[1]["data"].startswith('{"event_id":"EVT_0000000000000003","event_type":') and len(found[1]["data"]) == 200


def test_sorted_files_come_from_several_tasks(spark, tmp_path, monkeypatch):
    # two days before and after the middle of the month in turn, ids in another order than times
    rows_ = [(i * 37 % 1024, dt.datetime(2024, 1, 13 + i % 4, i % 24), i % 9, "click", 1.0, '{"k": 3}') for i in range(1024)]
    events = spark.createDataFrame(rows_, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.range(20).selectExpr("id AS p_partkey", "'a kind' AS p_type").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(queries, "_batch_folder", lambda t: f"{tmp_path}/batch")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with more rows
    try:
        found = queries.QUERIES["validate_files_samples"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    damaged = testbed.damaged_events(spark, str(tmp_path))
    broken = {r["raw"].event_id: r["errors"] for r in validate_events(damaged).invalid.collect()}
    ordered = sorted((r.timestamp >= testbed.MID_MONTH, r.event_id) for r in damaged.collect())
    expected: dict[str, list[int]] = {}
    for number, (_, event_id) in enumerate(ordered):
        for rule in broken.get(event_id, []):
            expected.setdefault(rule, []).append(number)
    places = [(rule, i + 1, number) for rule, numbers in expected.items() for i, number in enumerate(numbers[:5])]
    assert sorted((r["rule"], r["position"], r["row"]) for r in found) == sorted(places)
    # no task sorts and writes a whole half
    assert all(len(list(tmp_path.glob(f"batch/events_{i}.parquet/part-*"))) > 1 for i in range(2))


def test_files_with_nanoseconds(spark, tmp_path, make_events):
    folder = tmp_path / "in"
    tables.write_file(make_events({"timestamp": "2024-01-03 00:00:01"}), str(folder), "events_1")
    moments = pa.array([1_704_067_200_123_456_789, 1_704_153_600_000_000_000], pa.timestamp("ns"))
    columns = {"event_id": ["EVT_00000000000000A1", "EVT_00000000000000A2"], "timestamp": moments}
    pq.write_table(pa.table(columns), folder / "events_2.parquet", version="2.6")
    found = tables.read_event_files(spark, str(folder)).select("timestamp").collect()
    assert sorted(str(r.timestamp) for r in found) == [
        "2024-01-01 00:00:00.123456",
        "2024-01-02 00:00:00",
        "2024-01-03 00:00:01",
    ]
    spark.conf.set(tables.NANOS_AS_LONG, "false")


def test_two_thousand_files_of_several_schemas(spark, tmp_path):
    units = ["ns", "us", "ms", "us"]
    moment = dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    for i in range(2000):
        columns = {
            "event_id": [f"EVT_{i:016X}"],
            "timestamp": pa.array([moment + dt.timedelta(seconds=i)], pa.timestamp(units[i % 4])),
            ["device", "country", "category"][i % 3]: ["x"],
        }
        table = pa.table(columns) if i != 9 else pa.table(columns).slice(0, 0)
        pq.write_table(table, tmp_path / f"events_{i:04d}.parquet", version="2.6")
    found = tables.read_event_files(spark, str(tmp_path), places=True)
    assert set(found.columns) == {"event_id", "timestamp", "device", "country", "category", tables.FILE, tables.ROW_IN_FILE}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and plan.count("Union") == 1
    figures = found.agg(
        F.count("event_id"), F.count("device"), F.min("timestamp"), F.max("timestamp"), F.countDistinct("timestamp")
    ).first()
    assert tuple(figures) == (1999, 666, moment, moment + dt.timedelta(seconds=1999), 1999)
    spark.conf.set(tables.NANOS_AS_LONG, "false")


def test_layered_job(spark, tmp_path):
    models = run_layered_job(
        spark,
        raw_events(spark, SF),
        raw_products(spark, SF),
        raw_users(spark, SF),
        AS_OF,
        str(tmp_path),
    )
    assert len(models) == 12
    for name in ("dim_users", "dim_products", "dim_date", "fct_funnel", "fct_revenue"):
        assert spark.table(f"analytics.{name}").count() == models[name].count() > 0
    assert spark.table("intermediate.int_sessions").count() == models["int_sessions"].count()
    assert spark.table("int_user_journey").count() == models["int_user_journey"].count()


def test_keys_and_ids_go_together(spark):
    ids = spark.range(2_000_000).selectExpr(testbed._id("PROD_", "id", 8) + " AS product_id")
    assert ids.distinct().count() == 2_000_000
    assert ids.where(~F.col("product_id").rlike(schemas.PRODUCT_ID)).isEmpty()


def test_flat_job_writes_events_by_date(spark, tmp_path):
    raw_events(spark, SF).write.parquet(f"{tmp_path}/in/events_all.parquet")
    plain = run_flat_job(spark, f"{tmp_path}/in", f"{tmp_path}/plain", AS_OF, catalog=False)
    dated = run_flat_job(spark, f"{tmp_path}/in", f"{tmp_path}/dated", AS_OF, by_date=True)
    assert dated.loaded == plain.loaded
    assert spark.table("analytics.fct_events").count() == plain.loaded["fct_events"]
    found = tables.read_file(spark, f"{tmp_path}/dated", "fct_events")
    expected = tables.read_file(spark, f"{tmp_path}/plain", "fct_events")
    assert sorted(found.dtypes) == sorted(expected.dtypes)
    assert found.select(expected.columns).exceptAll(expected).isEmpty()
    day = expected.agg(F.min("event_date")).first()[0]
    one_day = found.filter(F.col("event_date") == day)
    folders = {name.split("event_date=")[1].split("/")[0] for name in one_day.inputFiles()}
    assert str(day) in folders
    text = one_day._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text
