"""Raw table schemas, closed vocabularies and thresholds."""

from __future__ import annotations

from pyspark.sql import types as T

# Wall-clock UTC without a zone, which is how such files are usually stored. It
# keeps every date expression independent of the session time zone and lets
# literal comparisons reach the Parquet reader.
TS = T.TimestampNTZType()

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("timestamp", TS),
        T.StructField("properties", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("traffic_source", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("revenue", T.DoubleType()),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("brand", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("review_count", T.LongType()),
        T.StructField("in_stock", T.BooleanType()),
    ]
)

USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("primary_device", T.StringType()),
        T.StructField("traffic_source", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("created_at", TS),
        T.StructField("is_subscribed", T.BooleanType()),
        T.StructField("lifetime_value", T.DoubleType()),
    ]
)

# The closed vocabularies of the data model.
EVENT_TYPES = [
    "page_view",
    "product_view",
    "add_to_cart",
    "remove_from_cart",
    "begin_checkout",
    "purchase",
    "search",
    "signup",
    "login",
]
DEVICES = ["mobile", "desktop", "tablet"]
TRAFFIC_SOURCES = ["organic", "paid_search", "social", "email", "direct", "referral"]
SEGMENTS = ["power_buyer", "browser", "occasional", "new_user"]

# Identifier formats.
EVENT_ID = r"\AEVT_[A-F0-9]{16}\z"
USER_ID = r"\AUSER_[A-F0-9]{12}\z"
SESSION_ID = r"\ASES_[A-F0-9]{16}\z"
PRODUCT_ID = r"\APROD_[A-F0-9]{8}\z"

# Limits.
MAX_SESSION_HOURS = 24
SESSION_TIMEOUT_MINUTES = 30
MAX_REVENUE = 100000.0
MAX_PRICE = 100000.0
MIN_VALIDITY_RATE = 95.0
MAX_NULL_RATE = 0.1
MAX_REVENUE_Z = 3.0
MAX_SESSION_EVENTS = 1000
CALENDAR_START = "2023-01-01"
CALENDAR_DAYS_AHEAD = 30
