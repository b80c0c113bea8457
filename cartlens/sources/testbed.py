"""Mapping of the supplied star-schema tables onto the raw shop tables.

``events`` becomes the click stream, ``part`` the product catalogue and
``customer`` (with ``nation``) the user profiles. Every column is a pure function
of its input row; a product event looks its category up in ``part``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.datetime(2024, 1, 31)
MID_MONTH = dt.datetime(2024, 1, 15)

COUNTRIES = ["US", "UK", "DE", "FR"]
DEVICES = ["mobile", "desktop", "tablet"]
SOURCES = ["organic", "paid_search", "social", "email", "direct", "referral"]


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _pick(position: str, values: list[str]) -> str:
    """SQL for the value at ``position``; null beyond the end of the list."""
    branches = " ".join(f"WHEN {i} THEN '{value}'" for i, value in enumerate(values))
    return f"CASE {position} {branches} END"


def _id(prefix: str, key: str, length: int) -> str:
    """SQL for the key in hexadecimal digits: different keys have different ids."""
    return f"concat('{prefix}', lpad(hex({key}), {length}, '0'))"


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered_events(spark, folder).drop("number")


def _numbered_events(spark: SparkSession, folder: str) -> DataFrame:
    clicks = _pick("k % 3", ["add_to_cart", "begin_checkout", "remove_from_cart"])
    parts = read(spark, folder, "part")
    products = parts.count()  # from the files' footers
    typed = (
        read(spark, folder, "events")
        .selectExpr("*", "cast(get_json_object(props, '$.k') AS int) AS k")
        .selectExpr(
            "*",
            f"""CASE event_type WHEN 'view' THEN if(k < 50, 'page_view', 'product_view')
                     WHEN 'click' THEN {clicks}
                     WHEN 'error' THEN if(k % 2 = 0, 'search', 'login')
                     ELSE event_type END AS type""",
        )
        .selectExpr(
            "*",
            f"""CASE WHEN type IN ('product_view', 'add_to_cart', 'remove_from_cart',
                                   'begin_checkout', 'purchase')
                     THEN (event_id * 7 + k) % {products} ELSE -1 - event_id END AS product_key""",
        )
    )
    # events without a product have keys of their own, so that the join spreads them
    kinds = parts.selectExpr("p_partkey AS product_key", "p_type")
    return typed.join(kinds, "product_key", "left").selectExpr(
        f"{_id('EVT_', 'event_id', 16)} AS event_id",
        "type AS event_type",
        f"{_id('USER_', 'user_id', 12)} AS user_id",
        f"concat({_id('SES_', 'user_id', 10)}, lpad(hex(unix_date(to_date(ts))), 6, '0')) AS session_id",
        "ts AS timestamp",
        "props AS properties",
        f"{_pick('k % 4', DEVICES)} AS device",
        f"{_pick('user_id % 5', COUNTRIES)} AS country",
        f"{_pick('k % 7', SOURCES)} AS traffic_source",
        f"if(product_key >= 0, {_id('PROD_', 'product_key', 8)}, NULL) AS product_id",
        "if(type <> 'remove_from_cart', p_type, NULL) AS category",
        "cast(if(type = 'purchase', value, 0.0D) AS decimal(18,2)) AS revenue",
        "event_id AS number",
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").selectExpr(
        f"{_id('PROD_', 'p_partkey', 8)} AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "cast(NULL AS string) AS subcategory",
        "p_retailprice * p_size / 50.0D AS price",
        "p_brand AS brand",
        "p_size / 10.0D AS rating",
        "p_partkey % 5000 AS review_count",
        "p_partkey % 10 <> 0 AS in_stock",
    )


def raw_users(spark: SparkSession, folder: str) -> DataFrame:
    customers, nations = read(spark, folder, "customer"), read(spark, folder, "nation")
    return customers.join(
        nations, customers["c_nationkey"] == nations["n_nationkey"], "left"
    ).selectExpr(
        f"{_id('USER_', 'c_custkey', 12)} AS user_id",
        """CASE c_mktsegment WHEN 'BUILDING' THEN 'power_buyer' WHEN 'AUTOMOBILE' THEN 'browser'
                WHEN 'MACHINERY' THEN 'occasional' WHEN 'HOUSEHOLD' THEN 'new_user' END AS segment""",
        f"{_pick('c_custkey % 4', DEVICES)} AS primary_device",
        f"{_pick('c_custkey % 7', SOURCES)} AS traffic_source",
        f"{_pick('c_nationkey % 5', COUNTRIES)} AS country",
        "n_name AS city",
        f"timestamp_ntz'{AS_OF:%Y-%m-%d}' - make_dt_interval(cast(c_custkey * 7 % 730 AS int)) "
        "AS created_at",
        "c_custkey % 5 < 2 AS is_subscribed",
        "0.0D AS lifetime_value",
    )


def damaged_events(spark: SparkSession, folder: str) -> DataFrame:
    """The whole click stream; the low byte of the event number selects a damage.

    Some kinds are repaired by validation (surrounding whitespace), most are
    rejected, one names users nobody knows, most bytes mean none.
    """
    events = _numbered_events(spark, folder)
    damage = {
        "event_id": {
            0: F.lower("event_id"),
            3: F.concat(F.lit(" \t"), "event_id", F.lit("\n")),
        },
        "event_type": {7: F.lit("invalid_type")},
        "user_id": {
            13: F.lit(None),
            16: F.concat(F.lit("USER_F"), F.substring("event_id", 10, 11)),
        },
        "session_id": {6: F.lit(None)},
        "properties": {4: F.lit("[1]"), 8: F.lit('{"k": '), 14: F.lit('"text"')},
        "device": {2: F.lit(" mobile ")},
        "country": {5: F.lit("USA"), 11: F.lit(" US ")},
        "traffic_source": {12: F.lit("radio")},
        "product_id": {9: F.lit("PROD_1")},
        "revenue": {
            1: F.lit("-1.00").cast("decimal(18,2)"),
            10: F.lit("100000.01").cast("decimal(18,2)"),
            15: F.lit(None),
        },
    }
    byte = F.col("number") % 256

    def column(name: str) -> Column:
        value = F.col(name)
        for code, broken in damage.get(name, {}).items():
            value = F.when(byte == code, broken).otherwise(value)
        return value.alias(name)

    return events.select(*[column(name) for name in events.columns if name != "number"])


def damaged_products(spark: SparkSession, folder: str) -> DataFrame:
    last = F.substring("product_id", -1, 1)
    return raw_products(spark, folder).withColumns(
        {
            "price": F.when(last == "0", 0.0).otherwise(F.col("price")),
            "rating": F.when(last == "1", 6.0).otherwise(F.col("rating")),
            "product_name": F.when(last == "2", "  ").otherwise(F.col("product_name")),
            "category": F.when(last == "3", F.lit(None)).otherwise(F.col("category")),
            "review_count": F.when(last == "4", -1).otherwise(F.col("review_count")),
        }
    )


def damaged_users(spark: SparkSession, folder: str) -> DataFrame:
    last = F.substring("user_id", -1, 1)
    return raw_users(spark, folder).withColumns(
        {
            "segment": F.when(last == "0", "invalid_segment").otherwise(F.col("segment")),
            "lifetime_value": F.when(last == "1", -5.0).otherwise(F.col("lifetime_value")),
            "country": F.when(last == "2", " UK ").otherwise(F.col("country")),
        }
    )


def with_copies(events: DataFrame) -> DataFrame:
    """All events, the purchases twice."""
    return events.unionByName(events.filter(F.col("event_type") == "purchase"))
