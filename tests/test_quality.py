from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartlens.operators import assertions, quality
from tests.conftest import AS_OF


@pytest.fixture
def sample(spark):
    day = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [
            ("EVT_1", "USER_1", "SES_1", day, 0.0),
            ("EVT_2", "USER_2", "SES_1", day, 100.0),
            ("EVT_3", "USER_3", "SES_2", day + dt.timedelta(days=1), 50.0),
        ],
        "event_id string, user_id string, session_id string, timestamp timestamp_ntz, revenue double",
    )


def test_no_duplicates(sample):
    assert quality.duplicate_ids(sample).count() == 0


def test_duplicates_count_every_copy(sample):
    issue = quality.duplicate_ids(sample.union(sample.limit(1))).first()
    assert (issue.check, issue.severity, issue["count"]) == ("duplicates", "high", 2)
    assert issue.message == "Found 2 duplicate event IDs"


def test_null_rate_above_threshold(sample):
    column = F.when(F.col("event_id") == "EVT_3", "value")
    issues = quality.null_rates(sample.withColumn("nullable", column), 0.5).collect()
    assert [i.message for i in issues] == ["Column 'nullable' has 66.7% null values"]


def test_null_rate_is_strict_and_counts_nan(sample):
    third = sample.withColumn(
        "revenue", F.when(F.col("event_id") == "EVT_1", float("nan")).otherwise(F.col("revenue"))
    )
    assert quality.null_rates(third, 0.3).first().column == "revenue"
    assert quality.null_rates(third, 1 / 3).count() == 0
    assert quality.null_rates(third.limit(0)).count() == 0


def test_outliers_use_the_sample_deviation_of_positive_revenue(spark):
    ordinary = [(10.0 + i % 3,) for i in range(30)]
    revenue = spark.createDataFrame([*ordinary, (1000.0,), (0.0,), (-5.0,)], "revenue double")
    issue = quality.revenue_outliers(revenue).first()
    assert (issue["count"], issue.max_value, issue.severity) == (1, 1000.0, "low")
    same = spark.createDataFrame([(5.0,)] * 20, "revenue double")
    assert quality.revenue_outliers(same).count() == 0
    assert quality.revenue_outliers(same.limit(1)).count() == 0


def test_future_timestamps(sample):
    late = sample.withColumn("timestamp", F.lit("2024-02-01 12:00:01").cast("timestamp_ntz"))
    assert quality.future_timestamps(sample, AS_OF).count() == 0
    assert quality.future_timestamps(late, AS_OF).first()["count"] == 3
    exact = sample.withColumn("timestamp", F.lit("2024-02-01 12:00:00").cast("timestamp_ntz"))
    assert quality.future_timestamps(exact, AS_OF).count() == 0


def test_crowded_sessions(spark):
    sessions = spark.range(2001).select(
        F.when(F.col("id") < 1001, "SES_A")
        .when(F.col("id") < 2001 - 0, F.when(F.col("id") < 2000, "SES_B"))
        .alias("session_id")
    )
    issue = quality.crowded_sessions(sessions).first()
    assert (issue["count"], issue.message) == (1, "Found 1 sessions with >1000 events")


def test_report_orders_by_severity(sample):
    events = sample.union(sample.limit(1)).withColumn("brand", F.lit(None).cast("string"))
    issues = quality.all_issues(events, AS_OF)
    lines = [(r.severity, r.check) for r in quality.report(events, AS_OF).collect()]
    assert lines == [("all", "totals"), ("high", "duplicates"), ("medium", "null_rate")]
    assert quality.high_severity(issues).count() == 1
    assert quality.report(events, AS_OF).first().message == "Total records: 4, issues found: 2"


def test_any_number_of_unique_columns(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (2, None, 3), (None, None, 4)], "x int, y string, z int")
    declared = [*assertions.unique("x", "y", "z"), *assertions.not_null("y")]
    found = {(r.column_name, r.test): r.violations for r in assertions.violations(df, "t", declared).collect()}
    assert found == {("x", "unique"): 1, ("y", "unique"): 1, ("z", "unique"): 1, ("y", "not_null"): 2}
