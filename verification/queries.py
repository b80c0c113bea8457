"""Every operator as a query over the supplied tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlens.functions import metrics, values
from cartlens.operators import assertions, history, quality, ranking, sessionize, trailing, validation
from cartlens.plans import calendar, dashboard, dimensions, facts, flat, incremental, intermediate, staging
from cartlens.plans.job import layered_models, run_flat_job
from cartlens.session import configure, durable, shared_folder
from cartlens.sources import testbed
from cartlens.sources.tables import (
    FILE,
    ROW_IN_FILE,
    create_namespaces,
    create_view,
    export_reference_data,
    read_event_files,
    read_file,
    read_reference_data,
    register_table,
    source,
    with_row_numbers,
    write_file,
)
from cartlens.sources.testbed import AS_OF, MID_MONTH
from cartlens.streaming import sessions as stream

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """One textual or double form per value, so that two engines hash alike."""
    columns = []
    for field in df.schema.fields:
        name, dtype = f"`{field.name}`", field.dataType
        form = name
        if isinstance(dtype, T.DateType):
            form = f"date_format({name}, 'yyyy-MM-dd')"
        elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            form = f"date_format({name}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
        elif isinstance(dtype, (T.DecimalType, T.DoubleType, T.FloatType)):
            form = f"round(cast({name} AS double), 6)"
        columns.append(f"{form} AS {name}")
    return df.selectExpr(*columns)


@lru_cache(maxsize=16)
def tables(spark: SparkSession, folder: str) -> Tables:
    """The tables of one scale factor, so that their plans are built once."""
    return Tables(spark, folder)


class Tables:
    """The raw and derived tables of one scale factor.

    Lazy plans are kept; tables that store something on the way are built anew.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = configure(spark), folder

    def read(self, table: str) -> DataFrame:
        return testbed.read(self.spark, self.folder, table)

    @cached_property
    def events(self) -> DataFrame:
        return testbed.raw_events(self.spark, self.folder)

    @cached_property
    def damaged(self) -> DataFrame:
        return testbed.damaged_events(self.spark, self.folder)

    @cached_property
    def products(self) -> DataFrame:
        return testbed.raw_products(self.spark, self.folder)

    @cached_property
    def users(self) -> DataFrame:
        return testbed.raw_users(self.spark, self.folder)

    @cached_property
    def stg_events(self) -> DataFrame:
        return staging.stg_events(self.events, AS_OF)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.products, AS_OF)

    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.users, AS_OF)

    @cached_property
    def sessions(self) -> DataFrame:
        return intermediate.int_sessions(self.stg_events)

    @cached_property
    def journey(self) -> DataFrame:
        return intermediate.int_user_journey(self.stg_events)

    @cached_property
    def performance(self) -> DataFrame:
        return intermediate.int_product_performance(self.stg_events, self.stg_products)

    @property
    def dim_users(self) -> DataFrame:
        return dimensions.dim_users(self.stg_users, self.sessions, AS_OF)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dimensions.dim_products(self.stg_products, self.performance, AS_OF)

    @cached_property
    def event_days(self) -> DataFrame:
        """Calendar range: the days of the events and 30 more."""
        return self.read("events").agg(
            F.to_date(F.min("ts")).alias("first"),
            F.date_add(F.to_date(F.max("ts")), 30).alias("last"),
        )

    @cached_property
    def order_days(self) -> DataFrame:
        return self.read("orders").agg(
            F.to_date(F.min("o_orderdate")).alias("first"),
            F.to_date(F.max("o_orderdate")).alias("last"),
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        return calendar.dim_date(self.event_days, AS_OF)

    @cached_property
    def engagement(self) -> DataFrame:
        return facts.fct_daily_engagement(self.stg_events, self.sessions, AS_OF)

    @cached_property
    def funnel(self) -> DataFrame:
        return facts.fct_funnel(self.journey, AS_OF)

    @cached_property
    def revenue(self) -> DataFrame:
        return facts.fct_revenue(self.stg_events, self.stg_products, AS_OF)

    @cached_property
    def flat_sessions(self) -> DataFrame:
        return flat.flat_sessions(self.events)

    @cached_property
    def daily(self) -> DataFrame:
        return flat.flat_daily_metrics(self.events)

    @cached_property
    def flat_products(self) -> DataFrame:
        return flat.flat_product_performance(self.events)


def _assert_columns(t: Tables) -> DataFrame:
    """All declared assertions on the raw tables and the twelve models."""
    models = layered_models(
        t.spark, t.events, t.products, t.users, AS_OF, keep=lambda name, table: durable(table)
    )
    tables = {
        "raw.events": t.events,
        "seeds.products": t.products,
        "seeds.users": t.users,
        **models,
    }
    return _union([assertions.violations(df, name) for name, df in tables.items()])


def _assert_damaged(t: Tables) -> DataFrame:
    raw = testbed.with_copies(t.damaged)
    return _union(
        [
            assertions.violations(raw, "raw.events"),
            assertions.violations(staging.stg_events(raw, AS_OF), "stg_events"),
        ]
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _revenue_gap(t: Tables) -> DataFrame:
    """Daily figures of the whole month against revenue known by mid-month."""
    early = staging.stg_events(t.events, MID_MONTH)
    return assertions.revenue_consistency(
        t.engagement, facts.fct_revenue(early, t.stg_products, MID_MONTH)
    )


def _orphans(t: Tables) -> DataFrame:
    sessions = intermediate.int_sessions(staging.stg_events(t.damaged, AS_OF))
    return assertions.orphan_session_users(sessions, t.stg_users)


def _macro_rates(t: Tables) -> DataFrame:
    lines = t.read("lineitem")
    per_part = lines.groupBy("l_partkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(F.col("l_returnflag") == "A").alias("accepted"),
        F.count(F.lit(1)).alias("lines"),
    )
    return per_part.select(
        "l_partkey",
        metrics.rate("returned", "lines").alias("return_rate"),
        metrics.rate("returned", "accepted").alias("returned_per_accepted"),
        metrics.growth("returned", "accepted").alias("growth_over_accepted"),
        metrics.safe_divide("returned", "accepted", -1).alias("safe_quotient"),
        metrics.per_at_least_one("returned", "accepted").alias("at_least_one"),
    )


def _revenue_where(t: Tables) -> DataFrame:
    return t.stg_events.groupBy("event_date").agg(
        metrics.revenue_where(F.col("device_type") == "mobile").alias("mobile_revenue"),
        metrics.revenue_where(F.col("country_code") == "US").alias("us_revenue"),
        metrics.count_type("search").alias("searches"),
    )


def _quintiles(t: Tables) -> DataFrame:
    return ranking.with_ntile(
        t.read("customer").select("c_custkey", "c_acctbal"), 5, "c_acctbal", "c_custkey", "quintile"
    )


def _hash_key(t: Tables) -> DataFrame:
    return t.read("customer").select(
        "c_custkey",
        values.hash_key("c_name").alias("short_key"),
        values.hash_key("c_name", 16).alias("long_key"),
    )


def _safe_json(t: Tables) -> DataFrame:
    parsed = values.json_or_empty("properties")
    return t.damaged.filter(F.col("event_id").isNotNull()).select(
        "event_id",
        F.try_variant_get(parsed, "$.k", "int").alias("k"),
        F.schema_of_variant(parsed).startswith("OBJECT").alias("is_object"),
    )


def _flatten(t: Tables) -> DataFrame:
    nested = t.read("orders").select(
        F.struct(
            F.col("o_orderkey").alias("key"),
            F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias("state"),
        ).alias("order"),
        F.struct(F.col("o_totalprice").alias("price")).alias("total"),
        F.col("o_custkey").alias("customer"),
    )
    return values.flatten_record(nested)


def _batch_folder(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/batch-{uuid.uuid4().hex}"


def _run_batch(t: Tables, folder: str, least: float = 90.0):
    return run_flat_job(
        t.spark, f"{folder}/in", f"{folder}/out", AS_OF, least, catalog=False, warn=lambda message: None
    )


def _batch_job(t: Tables) -> DataFrame:
    """Event files through validation, gate and load; the daily table read back."""
    folder = _batch_folder(t)
    t.damaged.write.parquet(f"{folder}/in/events_all.parquet")
    _run_batch(t, folder)
    return read_file(t.spark, f"{folder}/out", "fct_daily_metrics")


def _batch_mixed(t: Tables) -> DataFrame:
    """The same from files that lack a column each: what a file has must not be lost."""
    folder = _batch_folder(t)
    late = F.col("timestamp") >= F.lit(MID_MONTH)
    t.damaged.filter(late).drop("revenue").write.parquet(f"{folder}/in/events_1.parquet")
    t.damaged.filter(~late).drop("device").write.parquet(f"{folder}/in/events_2.parquet")
    _run_batch(t, folder, least=0.0)
    return read_file(t.spark, f"{folder}/out", "fct_daily_metrics")


def _batch_resumed(t: Tables) -> DataFrame:
    """The same after a run over half of the files and one that failed at the gate and was repeated."""
    folder = _batch_folder(t)
    late = F.col("timestamp") >= F.lit(MID_MONTH)
    t.damaged.filter(late).write.parquet(f"{folder}/in/events_1.parquet")
    places = t.spark, f"{folder}/in", f"{folder}/out", AS_OF
    options = {"catalog": False, "warn": lambda message: None, "run_name": "month"}
    run_flat_job(*places, 0.0, **options)
    t.damaged.filter(~F.coalesce(late, F.lit(False))).write.parquet(f"{folder}/in/events_2.parquet")
    try:
        run_flat_job(*places, 100.0, **options)
    except ValueError:
        run_flat_job(*places, 90.0, **options)
    return read_file(t.spark, f"{folder}/out", "fct_daily_metrics")


def _batch_metrics(t: Tables) -> DataFrame:
    """The run's record, without its times."""
    folder = _batch_folder(t)
    t.damaged.write.parquet(f"{folder}/in/events_all.parquet")
    return _run_batch(t, folder).record(t.spark).select(
        "records_extracted", "records_validated", "validity_rate", "errors_count"
    )


def _catalog_round_trip(t: Tables) -> DataFrame:
    """Written files, registered as a table and read back by its name."""
    create_namespaces(t.spark, ["staging"])
    path = write_file(t.stg_products, _batch_folder(t), "stg_products")
    register_table(t.spark, path, "registered_products", "staging")
    found = source(t.spark, "staging", "registered_products")
    return create_view(found, "registered_products_view").sparkSession.table("registered_products_view")


def _exported(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Catalogue and users exported to files and read back."""
    folder = _batch_folder(t)
    export_reference_data(t.products, t.users, folder)
    return read_reference_data(t.spark, folder)


def _date_range(t: Tables) -> DataFrame:
    """The days of the orders by their end, by their number, and up to a moment."""
    first, last = t.order_days.first()
    ranges = {
        "end": calendar.date_range(t.spark, first, end=last),
        "days": calendar.date_range(t.spark, first, days=(last - first).days),
        "as_of": calendar.date_range(t.spark, first, as_of=last),
    }
    whole = None
    for kind, days in ranges.items():
        part = days.select(F.lit(kind).alias("kind"), "date")
        whole = part if whole is None else whole.unionByName(part)
    return whole


def _staged(events: DataFrame, as_of) -> DataFrame:
    return staging.stg_events(events, as_of).drop("_loaded_at")


def _samples(t: Tables) -> DataFrame:
    found = validation.validate_events(t.damaged).error_samples("event_id")
    return found.select("rule", "position", "event_id")


def _file_samples(t: Tables) -> DataFrame:
    """The first broken rows of two sorted event tables: their number over both, message and text."""
    folder = _batch_folder(t)
    late = F.col("timestamp") >= F.lit(MID_MONTH)
    for number, part in enumerate((~late, late)):
        # a file per range of ids, named in their order; the other columns part rows of one id
        rows = t.damaged.filter(part).orderBy("event_id", "timestamp", "user_id")
        rows.write.parquet(f"{folder}/events_{number}.parquet")
    events = read_event_files(t.spark, folder, places=True)
    found = validation.validate_events(events).first_errors([FILE, ROW_IN_FILE])
    return with_row_numbers(found, events)


WEEKS = [MID_MONTH - dt.timedelta(days=7), MID_MONTH, MID_MONTH + dt.timedelta(days=7)]


def _weeks(t: Tables) -> list[DataFrame]:
    """The events in four parts, a week each; the purchases of all but the last come twice."""
    at, parts = F.col("timestamp"), []
    for start, end in zip([None, *WEEKS], [*WEEKS, None], strict=True):
        part = t.events
        part = part if start is None else part.filter(at >= F.lit(start))
        part = part if end is None else testbed.with_copies(part.filter(at < F.lit(end)))
        parts.append(part)
    return parts


def _streamed_sessions(t: Tables) -> DataFrame:
    """Sessions from weeks that arrive one by one, each read by a run of its own.

    The files of a week are in no order of time, so a run takes all of them as one batch.
    """
    folder = _batch_folder(t)
    for number, week in enumerate(_weeks(t)):
        week.write.parquet(f"{folder}/in/events_{number}.parquet")
        events = stream.event_stream(t.spark, f"{folder}/in", t.events.schema, files_per_batch=None)
        closed = stream.closed_sessions(stream.deduplicated(events))
        sessions = stream.run_available(closed, f"{folder}/sessions", f"{folder}/state")
    return sessions


def _history(t: Tables) -> DataFrame:
    """The users at three times: some come later, move, leave, or come back."""
    users = t.users.select("user_id", "segment", "city")
    last = F.substring("user_id", -1, 1)
    first = users.filter(last != "1")
    second = users.filter(last != "2").withColumn("city", F.when(last == "3", "MOVED").otherwise(F.col("city")))
    third = second.withColumn("segment", F.when(last == "3", F.lit(None)).otherwise(F.col("segment")))
    third = third.unionByName(users.filter(last == "2")).filter(last != "4")
    found = history.first_version(first, "user_id", WEEKS[0])
    for snapshot, at in ((second, WEEKS[1]), (third, WEEKS[2])):
        found = history.with_snapshot(found, snapshot, "user_id", at)
    return found


def _segments_at_purchase(t: Tables) -> DataFrame:
    """Revenue by the segment and city that a user had at the time."""
    bought = t.stg_events.filter(F.col("is_revenue_event")).select("user_id", "event_timestamp", "revenue_amount")
    known = history.as_of_join(bought, _history(t), "user_id", "event_timestamp", ["segment", "city", "version"])
    return known.groupBy("segment", "city", "version").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("revenue_amount").alias("revenue")
    )


def _incremental(t: Tables, *bases: str) -> str:
    """A store filled by three batches, of which the later ones hold events of earlier days too."""
    store = _batch_folder(t)
    number = F.pmod(F.xxhash64("event_id"), F.lit(10))
    late = F.col("timestamp") >= F.lit(MID_MONTH)
    batches = [~late & (number < 8), late & (number < 9), (~late & (number >= 8)) | (late & (number >= 9))]
    for i, part in enumerate(batches):
        days = incremental.add_events(t.spark, store, t.events.filter(part), f"b{i}")
        incremental.refresh(t.spark, store, days, AS_OF, bases)
    # a batch that is repeated changes nothing
    days = incremental.add_events(t.spark, store, t.events.filter(batches[1]), "b1")
    incremental.refresh(t.spark, store, days, AS_OF, bases)
    return store


def _incremental_revenue(t: Tables) -> DataFrame:
    store = _incremental(t, "daily_category_revenue")
    return incremental.revenue_mart(t.spark, store, t.stg_products, AS_OF)


def _incremental_engagement(t: Tables) -> DataFrame:
    return incremental.engagement_mart(t.spark, _incremental(t, "daily_activity", "session_days"), AS_OF)


def _incremental_funnel(t: Tables) -> DataFrame:
    return incremental.funnel_mart(t.spark, _incremental(t, "daily_funnel"), AS_OF)


def _moments(t: Tables) -> DataFrame:
    """Timestamps as texts and as whole numbers: which are accepted, and as what."""
    at = F.col("timestamp")
    text = F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    forms = [
        text,
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")),
        F.concat(text, F.lit("+02:00")),
        F.date_format(at, "yyyyMMdd"),
        F.date_format(at, "dd.MM.yyyy"),
        F.lit("2024-02-30 10:00:00"),
        F.lit(""),
    ]
    digit = F.conv(F.substring("event_id", -1, 1), 16, 10).cast("int")
    texts, numbers = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for i, form in enumerate(forms):
        texts = F.when(digit == i, form).otherwise(texts)
    seconds = F.unix_seconds(at.cast("timestamp"))
    numbers = F.when(digit == 8, seconds).when(digit == 9, seconds * 1000 + 7).when(digit == 10, F.lit(0))
    results = [
        validation.validate_events(t.events.filter(own).withColumn("timestamp", values_)).valid
        for own, values_ in ((digit < 8, texts), (digit >= 8, numbers))
    ]
    return _union([result.select("event_id", "timestamp") for result in results])


def _batch_record(t: Tables) -> DataFrame:
    """The run's whole record but its times."""
    folder = _batch_folder(t)
    t.damaged.write.parquet(f"{folder}/in/events_all.parquet")
    return _run_batch(t, folder).record(t.spark).drop("start_time", "end_time", "duration_seconds")


PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    "stg_events": lambda t: _staged(t.events, AS_OF),
    "stg_events_mid_month": lambda t: _staged(t.events, MID_MONTH),
    "stg_products": lambda t: t.stg_products.drop("_loaded_at"),
    "stg_users": lambda t: t.stg_users.drop("_loaded_at"),
    "int_sessions": lambda t: t.sessions,
    "int_user_journey": lambda t: t.journey,
    "int_product_performance": lambda t: t.performance,
    "dim_users": lambda t: t.dim_users.drop("_updated_at"),
    "dim_products": lambda t: t.dim_products.drop("_loaded_at", "_updated_at"),
    "dim_date": lambda t: t.dim_date,
    "fct_daily_engagement": lambda t: t.engagement.drop("_updated_at"),
    "fct_funnel": lambda t: t.funnel.drop("_updated_at"),
    "fct_revenue": lambda t: t.revenue.drop("_updated_at"),
    "flat_events": lambda t: flat.flat_events(t.events),
    "flat_sessions": lambda t: t.flat_sessions,
    "flat_daily_metrics": lambda t: t.daily,
    "flat_product_performance": lambda t: t.flat_products,
    "metric_summary": lambda t: flat.metric_summary(t.events),
    "event_profile": lambda t: flat.event_profile(t.events),
    "sessionize_gap": lambda t: sessionize.gap_sessions(t.events),
    "sessionize_events": lambda t: sessionize.with_gap_sessions(t.events).select(
        "event_id", "user_id", "timestamp", "session_id"
    ),
    "calendar_iso": lambda t: calendar.calendar_iso(t.order_days),
    "date_range": _date_range,
    "validate_events": lambda t: validation.validate_events(t.damaged).valid,
    "validate_events_errors": lambda t: validation.validate_events(t.damaged).error_summary(),
    "validate_events_samples": _samples,
    "validate_files_samples": _file_samples,
    "validate_events_moments": _moments,
    "batch_job_record": _batch_record,
    "trailing_active_users": lambda t: trailing.trailing_distinct(
        t.stg_events, "user_id", "event_date", {"active_users_7d": 7, "active_users_30d": 30}
    ),
    "streamed_sessions": _streamed_sessions,
    "user_history": _history,
    "revenue_by_segment_at_purchase": _segments_at_purchase,
    "incremental_funnel": lambda t: _incremental_funnel(t).drop("_updated_at"),
    "incremental_engagement": lambda t: _incremental_engagement(t).drop("_updated_at"),
    "incremental_revenue": lambda t: _incremental_revenue(t).drop("_updated_at"),
    "validate_products": lambda t: validation.validate_products(
        testbed.damaged_products(t.spark, t.folder)
    ).valid,
    "validate_users": lambda t: validation.validate_users(
        testbed.damaged_users(t.spark, t.folder)
    ).valid,
    "validity_rate": lambda t: validation.validate_events(t.damaged).result(),
    "dq_duplicates": lambda t: quality.duplicate_ids(testbed.with_copies(t.events)),
    "dq_null_rates": lambda t: quality.null_rates(t.events),
    "dq_revenue_outliers": lambda t: quality.revenue_outliers(t.events),
    "dq_future_timestamps": lambda t: quality.future_timestamps(t.events, MID_MONTH),
    "dq_session_integrity": lambda t: quality.crowded_sessions(t.events, 4),
    "dq_issues": lambda t: quality.all_issues(testbed.with_copies(t.events), MID_MONTH),
    "dq_high_severity": lambda t: quality.high_severity(
        quality.all_issues(testbed.with_copies(t.events), MID_MONTH)
    ),
    "dq_report": lambda t: quality.report(testbed.with_copies(t.events), MID_MONTH),
    "assert_columns": _assert_columns,
    "assert_columns_damaged": _assert_damaged,
    "assert_funnel_order": lambda t: assertions.funnel_order(t.funnel),
    "assert_revenue_consistency": _revenue_gap,
    "assert_orphan_sessions": _orphans,
    "kpi_latest": lambda t: dashboard.kpi_latest(t.daily),
    "trend_window": lambda t: dashboard.trend(t.daily, 7),
    "trend_conversion": lambda t: dashboard.trend(t.daily).select("event_date", "conversion_rate"),
    "funnel_overall": lambda t: dashboard.funnel_overall(t.daily),
    "top_products": lambda t: dashboard.top_products(t.flat_products),
    "category_conversion": lambda t: dashboard.category_conversion(t.flat_products),
    "duration_histogram": lambda t: dashboard.duration_histogram(t.flat_sessions),
    "sessions_by_device": lambda t: dashboard.sessions_by_device(t.flat_sessions),
    "sessions_by_quality": lambda t: dashboard.sessions_by_quality(t.sessions),
    "events_by_source": lambda t: dashboard.events_by_source(flat.flat_events(t.events)),
    "revenue_by_source": lambda t: dashboard.revenue_by_source(flat.flat_events(t.events)),
    "macro_rates": _macro_rates,
    "revenue_by_condition": _revenue_where,
    "quintile_bucket": _quintiles,
    "hash_key": _hash_key,
    "safe_json": _safe_json,
    "flatten_struct": _flatten,
    "batch_job_daily_metrics": _batch_job,
    "batch_job_mixed_files": _batch_mixed,
    "batch_job_resumed": _batch_resumed,
    "batch_job_metrics": _batch_metrics,
    "catalog_round_trip": lambda t: _catalog_round_trip(t).drop("_loaded_at"),
    "export_products": lambda t: staging.stg_products(_exported(t)[0], AS_OF).drop("_loaded_at"),
    "export_users": lambda t: staging.stg_users(_exported(t)[1], AS_OF).drop("_loaded_at"),
}


def _query(plan: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: comparable(plan(tables(spark, folder)))


QUERIES: dict[str, Query] = {name: _query(plan) for name, plan in PLANS.items()}
