"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from cartlens.operators import quality
from cartlens.operators.sessionize import gap_sessions
from cartlens.plans import facts, flat, intermediate, staging
from cartlens.plans.flat import flat_sessions
from cartlens.sources.testbed import AS_OF
from verification.queries import PLANS, Tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture
def stored_events(spark, tmp_path):
    """The click stream as a plain table, without the mapping in the plan."""
    Tables(spark, FOLDER).events.write.parquet(f"{tmp_path}/events")
    return spark.read.parquet(f"{tmp_path}/events")


def test_the_time_filter_reaches_the_files(stored_events):
    plan = plan_of(staging.stg_events(stored_events, AS_OF).select("event_id"))
    assert "LessThanOrEqual(timestamp,2024-01-31T00:00)" in plan
    assert re.search(r"ReadSchema: struct<event_id:string,user_id:string,timestamp:timestamp_ntz>", plan)


def test_funnel_reads_only_its_columns(stored_events):
    staged = staging.stg_events(stored_events, AS_OF)
    plan = plan_of(facts.fct_funnel(intermediate.int_user_journey(staged), AS_OF))
    for schema in re.findall(r"ReadSchema: (.*)", plan):
        assert "properties" not in schema and "device" not in schema


# Queries whose results span the whole event, session or user set.
WIDE = [
    "stg_events",
    "int_sessions",
    "int_user_journey",
    "int_product_performance",
    "dim_users",
    "dim_products",
    "flat_sessions",
    "flat_product_performance",
    "sessionize_gap",
    "sessionize_events",
    "validate_events",
    "quintile_bucket",
]


@pytest.mark.parametrize("name", WIDE)
def test_no_cross_join_single_task_or_python(spark, name):
    # one-row figures that the plan looks up are no part of the wide rows
    plan = plan_of(PLANS[name](Tables(spark, FOLDER))).split("===== Subqueries =====")[0]
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "Python"):
        assert operator not in plan, operator


def test_windows_over_events_see_slices_only(stored_events):
    # a window directly above the scan would sort all events of a user in one task
    plan = plan_of(gap_sessions(stored_events))
    above_window = plan.index("Window")
    assert "HashAggregate" in plan[above_window:]


def test_skewed_session_is_spread(spark):
    """One session with a third of all events gives the same figures."""
    events = spark.range(30000).select(
        F.format_string("EVT_%016X", "id").alias("event_id"),
        F.when(F.col("id") % 2 == 0, "page_view").otherwise("product_view").alias("event_type"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("user_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("session_id"),
        F.timestamp_seconds(F.col("id") + 1704067200).cast("timestamp_ntz").alias("timestamp"),
        F.lit("{}").alias("properties"),
        F.lit("mobile").alias("device"),
        F.lit("US").alias("country"),
        F.lit("direct").alias("traffic_source"),
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_id"),
        F.lit("A").alias("category"),
        F.lit(0.0).alias("revenue"),
    )
    sessions = intermediate.int_sessions(staging.stg_events(events, AS_OF))
    hot = sessions.filter("user_id = 'HOT'").first()
    assert (hot.total_events, hot.unique_products_viewed, hot.page_views) == (10000, 10000, 5000)
    assert sessions.count() == 20001
    assert flat_sessions(events).filter("user_id = 'HOT'").first().unique_products == 10000


@pytest.mark.parametrize(
    "build",
    [
        lambda raw, staged: facts.daily_events(staged),
        lambda raw, staged: facts.daily_category_revenue(staged),
        lambda raw, staged: intermediate.product_metrics(staged),
        lambda raw, staged: flat.flat_daily_metrics(raw),
        lambda raw, staged: flat.metric_summary(raw),
        lambda raw, staged: flat.event_profile(raw),
    ],
)
def test_figures_and_distinct_counts_take_one_scan(stored_events, build):
    plan = plan_of(build(stored_events, staging.stg_events(stored_events, AS_OF)))
    assert len(set(re.findall(r"Scan parquet +\((\d+)\)", plan))) == 1


def test_all_checks_scan_the_events_four_times(spark, stored_events):
    report = quality.report(stored_events, AS_OF)
    report.collect()
    executed = [x.split("== Initial Plan ==")[0] for x in plan_of(report).split("== Final Plan ==")[1:]]
    scans = {number for part in executed for number in re.findall(r"Scan parquet +\((\d+)\)", part)}
    assert len(scans) == 4


def test_percentiles_start_no_job_while_the_plan_is_built(spark, stored_events):
    products = Tables(spark, FOLDER).stg_products
    context = spark.sparkContext
    context.setJobGroup("building", "the plan of product performance")
    try:
        performance = intermediate.int_product_performance(staging.stg_events(stored_events, AS_OF), products)
        assert not context.statusTracker().getJobIdsForGroup("building")
        assert performance.count()
        assert context.statusTracker().getJobIdsForGroup("building")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
