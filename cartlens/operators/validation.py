"""Row validation as column expressions.

Each rule is a (code, condition) pair over normalised columns. A row is valid when
every condition is true; a condition that is null counts as broken.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlens import schemas as S
from cartlens.functions.values import is_json_record, stripped

ERRORS = "_errors"
RAW = "_raw"
ERROR_CLASS = "ValidationError"
_STORED_AS = {
    "text": "string",
    "value": "string",
    "record": "string",
    "flag": "boolean",
    "number": "double",
    "integer": "bigint",
    "moment": "timestamp_ntz",
}


@dataclass(frozen=True)
class Rule:
    """Rule for one column.

    ``kind`` decides how the stored value is read; ``holds`` is checked on the
    result. ``default`` replaces a column the table does not have; null values stay
    null and only pass when ``nullable``.
    """

    column: str
    kind: str
    holds: Callable[[Column], Column] | None = None
    nullable: bool = False
    default: object = None
    has_default: bool = False


@dataclass(frozen=True)
class Validation:
    """Outcome of a validation; all parts are lazy DataFrames over one checked input."""

    checked: DataFrame = field(repr=False)
    columns: list[str]

    @property
    def valid(self) -> DataFrame:
        """Normalised rows that break no rule."""
        return self.checked.filter(F.col(ERRORS) == "").select(*self.columns)

    @property
    def invalid(self) -> DataFrame:
        """Broken rows with the codes of their rules in ``errors`` and the ruled columns as given in ``raw``."""
        return self.checked.filter(F.col(ERRORS) != "").select(
            *[c for c in self.checked.columns if c not in (ERRORS, RAW)],
            F.col(RAW).alias("raw"),
            F.split(ERRORS, ",").alias("errors"),
        )

    def observed(self, seen: Observation) -> Validation:
        """The same, counting all and valid rows in whatever job reads them."""
        counts = F.count(F.lit(1)), F.count_if(F.col(ERRORS) == "")
        names = ("total_records", "valid_records")
        watched = self.checked.observe(seen, *(c.alias(n) for c, n in zip(counts, names, strict=True)))
        return Validation(watched, self.columns)

    def result(self) -> DataFrame:
        """One row: totals and the validity rate in percent (0 for no rows)."""
        total, good = F.col("total_records"), F.col("valid_records")
        return self.checked.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col(ERRORS) == "").alias("valid_records"),
        ).select(
            total,
            good,
            (total - good).alias("invalid_records"),
            F.when(total == 0, F.lit(0.0))
            .otherwise(good.cast("double") / total * 100)
            .alias("validity_rate"),
        )

    def error_summary(self) -> DataFrame:
        """Broken rows per error class (rule ``any``) and, finer, per rule."""
        codes = F.when(F.col(ERRORS) != "", F.concat(F.col(ERRORS), F.lit(",any")))
        return (
            self.checked.select(F.explode(F.split(codes, ",")).alias("rule"))
            .groupBy("rule")
            .agg(F.count(F.lit(1)).alias("errors"))
            .select(F.lit(ERROR_CLASS).alias("error_class"), "rule", "errors")
        )

    def error_samples(self, order_by: str, limit: int = 5) -> DataFrame:
        """Up to ``limit`` broken rows per rule with the first 200 characters of the row as given.

        The rank filter is applied inside each task before the shuffle, so a rule
        broken by most rows does not collect them; only the rows that remain become text.
        """
        ranked = Window.partitionBy("rule").orderBy(order_by, "tie")
        data = F.substring(F.to_json(RAW, {"ignoreNullFields": "false"}), 1, 200)
        return (
            self.checked.select("*", F.explode(F.split(ERRORS, ",")).alias("rule"))
            .filter(F.col("rule") != "")
            .select("rule", order_by, RAW, F.xxhash64(RAW).alias("tie"))
            .withColumn("position", F.row_number().over(ranked))
            .filter(F.col("position") <= limit)
            .select("rule", order_by, data.alias("data"), "position")
        )

    def first_errors(self, order: list[str], limit: int = 5) -> DataFrame:
        """The first ``limit`` broken rows per rule in an order of columns without ties.

        Columns: rule, position, the columns of the order, message with all broken rules of the
        row, and the first 200 characters of the row as given. As in ``error_samples`` the rank filter
        is applied inside each task, and only the rows that remain become text.
        """
        ranked = Window.partitionBy("rule").orderBy(*order)
        data = F.substring(F.to_json(RAW, {"ignoreNullFields": "false"}), 1, 200)
        return (
            self.checked.select("*", F.explode(F.split(ERRORS, ",")).alias("rule"))
            .filter(F.col("rule") != "")
            .select("rule", *order, RAW, ERRORS)
            .withColumn("position", F.row_number().over(ranked))
            .filter(F.col("position") <= limit)
            .select(
                "rule", "position", *order, F.concat(F.lit(f"{ERROR_CLASS}: "), ERRORS).alias("message"), data.alias("data")
            )
        )

    def fail_fast(self) -> DataFrame:
        """The valid rows; the job fails as soon as a broken row is met."""
        message = F.concat(F.lit(f"{ERROR_CLASS}: "), F.col(ERRORS))
        checked = F.when(F.col(ERRORS) == "", F.lit(True)).otherwise(
            F.raise_error(message).cast("boolean")
        )
        return self.checked.filter(checked).select(*self.columns)


def _read(df: DataFrame, rule: Rule) -> Column:
    """The column as the rule wants it; null stands for absent or unreadable."""
    if rule.column not in df.columns:
        return F.lit(rule.default).cast(_STORED_AS[rule.kind])
    column, dtype = F.col(rule.column), df.schema[rule.column].dataType
    text = isinstance(dtype, T.StringType)
    if rule.kind == "text":
        return stripped(column) if text else F.lit(None).cast("string")
    if rule.kind == "number":
        if text:
            return column.try_cast("double")
        return column if isinstance(dtype, T.NumericType) else F.lit(None).cast("double")
    if rule.kind == "flag" and isinstance(dtype, T.NumericType):
        return F.when(column.isin(0, 1), column.cast("boolean"))
    if rule.kind == "flag":
        return column.try_cast("boolean")
    if rule.kind == "integer":
        if isinstance(dtype, T.IntegralType):
            return column
        number = column.try_cast("double")
        return F.when(number == F.floor(number), number).try_cast("bigint")
    if rule.kind == "moment" and text:
        iso = column.rlike(r"\A\d{4}-?\d{2}-?\d{2}([T ]\d{2}|\z)")
        # the basic format, without separators, is ISO too
        dashed = F.regexp_replace(column, r"\A(\d{4})(\d{2})(\d{2})(?=[T ]|\z)", "$1-$2-$3")
        colons = F.regexp_replace(dashed, r"([T ]\d{2})(\d{2})(\d{2})(?!\d)", "$1:$2:$3")
        instant = F.try_to_timestamp(F.regexp_replace(colons, "Z$", "+00:00"))
        return F.when(iso, instant).cast("timestamp_ntz")
    if rule.kind == "moment" and isinstance(dtype, T.IntegralType):
        # seconds since 1970, or milliseconds where seconds would lie beyond the year 2286
        seconds = F.timestamp_seconds(column)
        return F.when(F.abs(column) <= 10**10, seconds).otherwise(F.timestamp_millis(column)).cast("timestamp_ntz")
    if rule.kind == "moment":
        known = isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))
        return column.cast("timestamp_ntz") if known else F.lit(None).cast("timestamp_ntz")
    return column


def _broken(df: DataFrame, rule: Rule) -> Column:
    """Code of the rule where it is broken, else null."""
    present = rule.column in df.columns
    raw = F.col(f"{RAW}.{rule.column}") if present else F.lit(None)
    value = F.col(rule.column)
    if not present and rule.has_default:
        return F.lit(None).cast("string")
    if rule.kind == "record":
        passes = is_json_record(value) if _is_text(df, rule.column) else value.isNotNull()
    elif rule.holds is None:
        passes = value.isNotNull()
    else:
        passes = F.coalesce(rule.holds(value), F.lit(False))
    if rule.nullable:
        passes = raw.isNull() | passes
    return F.when(~passes, F.lit(rule.column))


def _is_text(df: DataFrame, column: str) -> bool:
    return column in df.columns and isinstance(df.schema[column].dataType, T.StringType)


def check(df: DataFrame, rules: list[Rule]) -> Validation:
    """Normalise the ruled columns and list the broken rules of every row."""
    ruled = [rule.column for rule in rules]
    others = [column for column in df.columns if column not in ruled]
    raw = [F.col(column) for column in ruled if column in df.columns]
    # a generated row is computed once; a plain projection would be copied into every filter on it
    values = F.struct(*[_read(df, rule).alias(rule.column) for rule in rules])
    prepared = df.select(
        *others, (F.struct(*raw) if raw else F.lit(None)).alias(RAW), F.inline(F.array(values))
    ).select(*ruled, *others, RAW)
    # joined text instead of an array: null codes vanish without a lambda
    checked = prepared.withColumn(ERRORS, F.concat_ws(",", *[_broken(df, r) for r in rules]))
    return Validation(checked, ruled)


def _matches(pattern: str) -> Callable[[Column], Column]:
    return lambda value: value.rlike(pattern)


def _among(values: list[str]) -> Callable[[Column], Column]:
    return lambda value: value.isin(values)


def _length(low: int, high: int) -> Callable[[Column], Column]:
    return lambda value: F.length(value).between(low, high)


def _within(low: float, high: float | None = None) -> Callable[[Column], Column]:
    # NaN sorts above every number, so an upper bound rejects it
    top = float("inf") if high is None else high
    return lambda value: (value >= low) & (value.cast("double") <= top)


EVENT_RULES = [
    Rule("event_id", "text", _matches(S.EVENT_ID)),
    Rule("event_type", "value", _among(S.EVENT_TYPES)),
    Rule("user_id", "text", _matches(S.USER_ID)),
    Rule("session_id", "text", _matches(S.SESSION_ID)),
    Rule("timestamp", "moment"),
    Rule("properties", "record"),
    Rule("device", "value", _among(S.DEVICES), nullable=True),
    Rule("country", "text", _length(2, 2), nullable=True),
    Rule("traffic_source", "value", _among(S.TRAFFIC_SOURCES), nullable=True),
    Rule("product_id", "text", _matches(S.PRODUCT_ID), nullable=True),
    Rule("category", "text", nullable=True),
    Rule("revenue", "number", _within(0.0, S.MAX_REVENUE), default=0.0, has_default=True),
]

PRODUCT_RULES = [
    Rule("product_id", "text", _matches(S.PRODUCT_ID)),
    Rule("product_name", "text", _length(1, 200)),
    Rule("category", "text", _length(1, 100)),
    Rule("subcategory", "text", nullable=True),
    Rule("price", "number", lambda v: (v > 0) & (v.cast("double") <= S.MAX_PRICE)),
    Rule("brand", "text", nullable=True),
    Rule("rating", "number", _within(0.0, 5.0), nullable=True),
    Rule("review_count", "integer", _within(0), nullable=True),
    Rule("in_stock", "flag", default=True, has_default=True),
]

USER_RULES = [
    Rule("user_id", "text", _matches(S.USER_ID)),
    Rule("segment", "value", _among(S.SEGMENTS)),
    Rule("primary_device", "value", _among(S.DEVICES)),
    Rule("traffic_source", "value", _among(S.TRAFFIC_SOURCES)),
    Rule("country", "text", _length(2, 2)),
    Rule("city", "text", nullable=True),
    Rule("created_at", "moment"),
    Rule("is_subscribed", "flag", default=False, has_default=True),
    Rule("lifetime_value", "number", _within(0.0), default=0.0, has_default=True),
]


def validate_events(df: DataFrame) -> Validation:
    return check(df, EVENT_RULES)


def validate_products(df: DataFrame) -> Validation:
    return check(df, PRODUCT_RULES)


def validate_users(df: DataFrame) -> Validation:
    return check(df, USER_RULES)


def validity_of(counts: dict) -> dict:
    """The figures of ``Validation.result`` from observed counts."""
    total, valid = counts["total_records"], counts["valid_records"]
    rate = valid / total * 100 if total else 0.0
    return {
        "total_records": total,
        "valid_records": valid,
        "invalid_records": total - valid,
        "validity_rate": rate,
    }


def require_validity(figures: dict, minimum: float = S.MIN_VALIDITY_RATE) -> None:
    """The gate: an error when the rate is below ``minimum``."""
    rate = figures["validity_rate"]
    if rate < minimum:
        raise ValueError(f"only {rate:.1f}% of the rows are valid, {minimum:.1f}% are required")
