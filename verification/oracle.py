"""DuckDB SQL with the same results as the registered queries.

Every statement is a chain of named sub-queries; ``_chain`` adds the ones a
statement needs. Dates and moments are compared as text, money and rates as
doubles rounded to six places, like on the Spark side.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
MID_MONTH = "TIMESTAMP '2024-01-15 00:00:00'"


def _when(position: str, values: list[str]) -> str:
    branches = " ".join(f"WHEN {i} THEN '{value}'" for i, value in enumerate(values))
    return f"CASE {position} {branches} END"


def _key(prefix: str, number: str, length: int) -> str:
    return f"'{prefix}' || printf('%0{length}X', ({number})::BIGINT)"


def _digest_key(prefix: str, text: str, length: int) -> str:
    return f"'{prefix}' || upper(substr(md5({text}), 1, {length}))"


def _rate(numerator: str, denominator: str) -> str:
    return f"CASE WHEN {denominator} > 0 THEN ({numerator})::DOUBLE / ({denominator})::DOUBLE ELSE 0 END"


def _growth(current: str, previous: str) -> str:
    return _rate(f"{current} - {previous}", previous)


def _types(columns: dict[str, str], column: str = "event_type") -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE {column} = '{value}') AS {name}" for name, value in columns.items()
    )


def _sums(columns: dict[str, str], column: str, amount: str) -> str:
    return ", ".join(
        f"coalesce(sum({amount}) FILTER (WHERE {column} = '{value}'), 0) AS {name}"
        for name, value in columns.items()
    )


DEVICES = ["mobile", "desktop", "tablet"]
SOURCES = ["organic", "paid_search", "social", "email", "direct", "referral"]
COUNTRIES = ["US", "UK", "DE", "FR"]
SOURCE_NAMES = {
    "organic": "organic",
    "paid": "paid_search",
    "social": "social",
    "email": "email",
    "direct": "direct",
}
FLAT_TYPES = {
    "page_views": "page_view",
    "product_views": "product_view",
    "add_to_carts": "add_to_cart",
    "purchases": "purchase",
}
EVENT_COLUMNS = (
    "event_id, event_type, user_id, session_id, timestamp, properties, device, country, "
    "traffic_source, product_id, category, revenue"
)
# Whitespace that validation strips.
SPACE = r"[\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _strip(column: str) -> str:
    return f"regexp_replace({column}, '^{SPACE}|{SPACE}$', '', 'g')"


def _stg_events(source: str, now: str) -> str:
    return f"""
SELECT event_id, event_type, user_id, session_id, timestamp AS event_timestamp,
       timestamp::DATE AS event_date, hour(timestamp) AS event_hour,
       dayofweek(timestamp) AS day_of_week, dayofweek(timestamp) IN (0, 6) AS is_weekend,
       ifnull(device, 'unknown') AS device_type, ifnull(country, 'XX') AS country_code,
       ifnull(traffic_source, 'direct') AS traffic_source, product_id,
       category AS product_category, ifnull(revenue, 0)::DECIMAL(18,2) AS revenue_amount,
       ifnull(event_type = 'purchase' AND revenue > 0, false) AS is_revenue_event,
       properties AS event_properties
FROM {source}
WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND timestamp <= {now}"""


def _sessions(source: str) -> str:
    return f"""
SELECT *,
       CASE WHEN session_duration_seconds < 30 THEN 'Bounce'
            WHEN session_duration_seconds < 120 THEN 'Quick'
            WHEN session_duration_seconds < 600 THEN 'Engaged'
            WHEN session_duration_seconds < 1800 THEN 'Deep' ELSE 'Extended' END AS duration_category,
       purchases > 0 AS is_converted, add_to_cart_events > 0 AS has_cart_activity,
       checkout_starts > 0 AS started_checkout,
       (page_views + 2 * product_views + 1.5 * searches + 5 * add_to_cart_events
        + 10 * checkout_starts + 20 * purchases)::DOUBLE AS engagement_score,
       CASE WHEN purchases > 0 THEN 'High Value' WHEN checkout_starts > 0 THEN 'High Intent'
            WHEN add_to_cart_events > 0 THEN 'Engaged' WHEN product_views > 2 THEN 'Browsing'
            ELSE 'Low Engagement' END AS session_quality
FROM (
  SELECT session_id, user_id, min(event_timestamp) AS session_start,
         max(event_timestamp) AS session_end, min(event_date) AS session_date,
         min(device_type) AS device_type, min(country_code) AS country_code,
         min(traffic_source) AS traffic_source, count(*) AS total_events,
         {_types({"page_views": "page_view", "product_views": "product_view", "searches": "search",
                  "add_to_cart_events": "add_to_cart", "remove_from_cart_events": "remove_from_cart",
                  "checkout_starts": "begin_checkout", "purchases": "purchase"})},
         sum(revenue_amount) AS session_revenue, max(revenue_amount) AS max_order_value,
         count(DISTINCT event_type) AS unique_event_types,
         count(DISTINCT product_id) AS unique_products_viewed,
         count(DISTINCT product_category) AS unique_categories_viewed,
         datediff('second', min(event_timestamp), max(event_timestamp)) AS session_duration_seconds
  FROM {source} GROUP BY session_id, user_id)
WHERE session_duration_seconds <= 86400"""


def _category_revenue(source: str) -> str:
    return f"""
SELECT event_date, ifnull(product_category, 'Unknown') AS category,
       sum(revenue_amount) AS gross_revenue,
       sum(revenue_amount)::DOUBLE / count(*) AS avg_transaction_value,
       min(revenue_amount) AS min_transaction_value, max(revenue_amount) AS max_transaction_value,
       {_sums({f"{d}_revenue": d for d in DEVICES}, "device_type", "revenue_amount")},
       {_sums({f"{n}_revenue": s for n, s in SOURCE_NAMES.items()}, "traffic_source", "revenue_amount")},
       count(DISTINCT event_id) AS transaction_count, count(DISTINCT user_id) AS purchasing_users,
       count(DISTINCT session_id) AS purchasing_sessions,
       count(DISTINCT product_id) AS unique_products_sold
FROM {source} WHERE event_type = 'purchase' AND revenue_amount > 0 GROUP BY ALL"""


_STAGES = {
    "page_view": ("first_page_view", "page_view_count", "reached_site"),
    "product_view": ("first_product_view", "product_view_count", "reached_product"),
    "add_to_cart": ("first_add_to_cart", "add_to_cart_count", "reached_cart"),
    "begin_checkout": ("first_checkout", "checkout_count", "reached_checkout"),
    "purchase": ("first_purchase", "purchase_count", "reached_purchase"),
}
_FUNNEL = ["site", "product", "cart", "checkout", "purchase"]
_DROPS = {
    "bounced_users": "landing_bounce",
    "product_exit_users": "product_exit",
    "cart_abandoned_users": "cart_abandoned",
    "checkout_abandoned_users": "checkout_abandoned",
    "converted_users": "converted",
}
_STAGE_TIMES = [
    "time_to_product_view",
    "time_to_cart",
    "time_to_checkout",
    "time_to_purchase",
    "total_time_to_purchase",
]


def _distinct(entity: str, condition: str, name: str) -> str:
    return f"count(DISTINCT {entity}) FILTER (WHERE {condition}) AS {name}"


def _damage(column: str, cases: dict[int, str]) -> str:
    branches = " ".join(f"WHEN {code} THEN {value}" for code, value in cases.items())
    return f"CASE number % 256 {branches} ELSE {column} END AS {column}"


# What is declared about every table; ranges name what breaks them.
DECLARED = {
    "raw.events": """
event_id unique
event_id not_null
event_type not_null
user_id not_null
timestamp not_null""",
    "seeds.products": """
product_id unique
product_id not_null""",
    "seeds.users": """
user_id unique
user_id not_null""",
    "stg_events": """
event_id unique
event_id not_null
event_type not_null
user_id not_null
session_id not_null
event_timestamp not_null
event_date not_null
event_type accepted_values page_view|product_view|add_to_cart|remove_from_cart|begin_checkout|purchase|search|signup|login
device_type accepted_values mobile|desktop|tablet|unknown
traffic_source accepted_values organic|paid_search|social|email|direct|referral
revenue_amount accepted_range < 0""",
    "stg_products": """
product_id unique
product_id not_null
product_name not_null
category not_null
price not_null
price accepted_range <= 0
price_tier accepted_values Budget|Mid-Range|Premium|Luxury
rating accepted_range < 0|> 5""",
    "stg_users": """
user_id unique
user_id not_null
user_segment not_null
user_segment accepted_values power_buyer|browser|occasional|new_user|unknown
tenure_tier accepted_values New|Developing|Established|Veteran""",
    "int_sessions": """
session_id unique
session_id not_null
user_id not_null
session_start not_null
session_end not_null
session_duration_seconds not_null
is_converted not_null
session_duration_seconds accepted_range < 0
session_quality accepted_values High Value|High Intent|Engaged|Browsing|Low Engagement""",
    "int_user_journey": """
user_id not_null
session_id not_null
deepest_stage accepted_values none|page_view|product_view|cart|checkout|purchase
funnel_depth accepted_range < 0|> 5
drop_off_stage accepted_values converted|checkout_abandoned|cart_abandoned|product_exit|landing_bounce|no_engagement""",
    "int_product_performance": """
product_id unique
product_id not_null
total_views not_null
total_views accepted_range < 0
view_to_cart_rate accepted_range < 0|> 1
overall_conversion_rate accepted_range < 0|> 1""",
    "dim_users": """
user_id unique
user_id not_null
user_segment not_null
lifetime_revenue accepted_range < 0
customer_value_tier accepted_values VIP|High Value|Medium Value|Low Value|No Purchase
activity_status accepted_values Active|Recent|Lapsing|Churned|Never Active
buyer_status accepted_values Repeat Buyer|One-Time Buyer|Non-Buyer""",
    "dim_products": """
product_id unique
product_id not_null
product_name not_null
category not_null
price not_null
price accepted_range <= 0
overall_conversion_rate accepted_range < 0|> 1""",
    "dim_date": """
date_key unique
date_key not_null
year not_null
month not_null
month accepted_range < 1|> 12
day_of_week accepted_range < 0|> 6""",
    "fct_daily_engagement": """
event_date unique
event_date not_null
daily_active_users not_null
total_sessions not_null
daily_active_users accepted_range < 0
total_revenue accepted_range < 0
conversion_rate accepted_range < 0|> 1""",
    "fct_funnel": """
event_date unique
event_date not_null
users_at_site not_null
users_at_purchase not_null
overall_conversion_rate accepted_range < 0|> 1
cart_abandonment_rate accepted_range < 0|> 1""",
    "fct_revenue": """
event_date not_null
category not_null
gross_revenue accepted_range < 0
transaction_count accepted_range < 0""",
}


def _violated(column: str, test: str, given: str) -> str:
    if test == "not_null":
        return f"{column} IS NULL"
    if test == "accepted_values":
        listed = ", ".join(f"'{value}'" for value in given.split("|"))
        return f"{column} NOT IN ({listed})"
    return " OR ".join(f"{column} {bound}" for bound in given.split("|"))


def _assertions(table: str, source: str) -> str:
    rows = []
    for line in DECLARED[table].strip().split("\n"):
        column, test, given = [*line.split(" ", 2), ""][:3]
        if test == "unique":
            number = (
                f"(SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
                f"GROUP BY {column} HAVING count(*) > 1))"
            )
        else:
            number = f"(SELECT count(*) FROM {source} WHERE {_violated(column, test, given)})"
        rows.append(f"('{table}', '{column}', '{test}', {number})")
    return "VALUES " + ", ".join(rows)


SUB: dict[str, str] = {
    "ev_numbered": f"""
SELECT {_key("EVT_", "number", 16)} AS event_id, event_type,
       {_key("USER_", "u", 12)} AS user_id,
       {_key("SES_", "u", 10)} || printf('%06X', ts::DATE - DATE '1970-01-01') AS session_id,
       ts AS timestamp, props AS properties, {_when("k % 4", DEVICES)} AS device,
       {_when("u % 5", COUNTRIES)} AS country, {_when("k % 7", SOURCES)} AS traffic_source,
       {_key("PROD_", "p", 8)} AS product_id,
       CASE WHEN event_type <> 'remove_from_cart' THEN p_type END AS category,
       (CASE WHEN event_type = 'purchase' THEN value ELSE 0 END)::DECIMAL(18,2) AS revenue,
       number
FROM (
  SELECT *, CASE WHEN event_type IN ('product_view', 'add_to_cart', 'remove_from_cart',
                                     'begin_checkout', 'purchase')
                 THEN (number * 7 + k) % (SELECT count(*) FROM part) END AS p
  FROM (
    SELECT number, u, ts, value, props, k,
           CASE kind WHEN 'view' THEN if(k < 50, 'page_view', 'product_view')
                     WHEN 'click' THEN {_when("k % 3", ["add_to_cart", "begin_checkout", "remove_from_cart"])}
                     WHEN 'error' THEN if(k % 2 = 0, 'search', 'login') ELSE kind END AS event_type
    FROM (SELECT event_id AS number, user_id AS u, ts, value, props, event_type AS kind,
                 (props ->> '$.k')::INTEGER AS k FROM events)))
LEFT JOIN part ON p_partkey = p""",
    "ev": f"SELECT {EVENT_COLUMNS} FROM ev_numbered",
    "ev_damaged": f"""
SELECT {_damage("event_id", {0: "lower(event_id)", 3: "chr(32) || chr(9) || event_id || chr(10)"})},
       {_damage("event_type", {7: "'invalid_type'"})},
       {_damage("user_id", {13: "NULL", 16: "'USER_F' || substr(event_id, 10, 11)"})},
       {_damage("session_id", {6: "NULL"})}, timestamp,
       {_damage("properties", {4: "'[1]'", 8: "'{\"k\": '", 14: "'\"text\"'"})},
       {_damage("device", {2: "' mobile '"})},
       {_damage("country", {5: "'USA'", 11: "' US '"})},
       {_damage("traffic_source", {12: "'radio'"})},
       {_damage("product_id", {9: "'PROD_1'"})}, category,
       {_damage("revenue", {1: "-1.00", 10: "100000.01", 15: "NULL"})}
FROM ev_numbered""",
    "prod": f"""
SELECT {_key("PROD_", "p_partkey", 8)} AS product_id, p_name AS product_name,
       p_type AS category, NULL::VARCHAR AS subcategory, p_retailprice * p_size / 50.0 AS price,
       p_brand AS brand, p_size / 10.0::DOUBLE AS rating, p_partkey % 5000 AS review_count,
       p_partkey % 10 <> 0 AS in_stock
FROM part""",
    "usr": f"""
SELECT {_key("USER_", "c_custkey", 12)} AS user_id,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'power_buyer' WHEN 'AUTOMOBILE' THEN 'browser'
            WHEN 'MACHINERY' THEN 'occasional' WHEN 'HOUSEHOLD' THEN 'new_user' END AS segment,
       {_when("c_custkey % 4", DEVICES)} AS primary_device,
       {_when("c_custkey % 7", SOURCES)} AS traffic_source,
       {_when("c_nationkey % 5", COUNTRIES)} AS country, n_name AS city,
       {AS_OF} - to_days((c_custkey * 7 % 730)::INTEGER) AS created_at,
       c_custkey % 5 < 2 AS is_subscribed, 0.0::DOUBLE AS lifetime_value
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "se": _stg_events("ev", AS_OF),
    "se_mid": _stg_events("ev", MID_MONTH),
    "se_damaged": _stg_events("ev_damaged", AS_OF),
    "sp": """
SELECT product_id, product_name, ifnull(category, 'Uncategorized') AS category,
       ifnull(subcategory, 'Other') AS subcategory, ifnull(brand, 'Unknown Brand') AS brand,
       price::DECIMAL(10,2) AS price,
       CASE WHEN price < 25 THEN 'Budget' WHEN price < 100 THEN 'Mid-Range'
            WHEN price < 500 THEN 'Premium' ELSE 'Luxury' END AS price_tier,
       ifnull(rating::DECIMAL(2,1), 0) AS rating,
       CASE WHEN rating >= 4.5 THEN 'Excellent' WHEN rating >= 4 THEN 'Good'
            WHEN rating >= 3 THEN 'Average' ELSE 'Below Average' END AS rating_tier,
       ifnull(review_count, 0) AS review_count, ifnull(in_stock, true) AS is_in_stock
FROM prod WHERE product_id IS NOT NULL""",
    "su": f"""
SELECT user_id, ifnull(segment, 'unknown') AS user_segment,
       ifnull(primary_device, 'unknown') AS preferred_device,
       ifnull(traffic_source, 'direct') AS acquisition_source,
       ifnull(country, 'XX') AS country_code, city, created_at AS account_created_at,
       created_at::DATE AS account_created_date, age AS account_age_days,
       CASE WHEN age <= 30 THEN 'New' WHEN age <= 90 THEN 'Developing'
            WHEN age <= 365 THEN 'Established' ELSE 'Veteran' END AS tenure_tier,
       ifnull(is_subscribed, false) AS is_email_subscribed,
       ifnull(lifetime_value, 0) AS historical_ltv
FROM (SELECT *, datediff('day', created_at, {AS_OF}) AS age FROM usr) WHERE user_id IS NOT NULL""",
    "ses": _sessions("se"),
    "ses_damaged": _sessions("se_damaged"),
    "jour": f"""
SELECT *,
       CASE funnel_depth WHEN 5 THEN 'converted' WHEN 4 THEN 'checkout_abandoned'
            WHEN 3 THEN 'cart_abandoned' WHEN 2 THEN 'product_exit' WHEN 1 THEN 'landing_bounce'
            ELSE 'no_engagement' END AS drop_off_stage,
       CASE funnel_depth WHEN 5 THEN 'purchase' WHEN 4 THEN 'checkout' WHEN 3 THEN 'cart'
            WHEN 2 THEN 'product_view' WHEN 1 THEN 'page_view' ELSE 'none' END AS deepest_stage,
       datediff('second', first_page_view, first_product_view) AS time_to_product_view,
       datediff('second', first_product_view, first_add_to_cart) AS time_to_cart,
       datediff('second', first_add_to_cart, first_checkout) AS time_to_checkout,
       datediff('second', first_checkout, first_purchase) AS time_to_purchase,
       datediff('second', first_page_view, first_purchase) AS total_time_to_purchase
FROM (
  SELECT *, {", ".join(f"{first} IS NOT NULL AS {flag}" for first, _, flag in _STAGES.values())},
         coalesce({", ".join(
             f"if({first} IS NULL, NULL, {5 - i})"
             for i, (first, _, _) in enumerate(reversed(list(_STAGES.values())))
         )}, 0) AS funnel_depth
  FROM (
    SELECT user_id, session_id, event_date,
           {", ".join(
               f"min(event_timestamp) FILTER (WHERE event_type = '{event}') AS {first}, "
               f"count(*) FILTER (WHERE event_type = '{event}') AS {number}"
               for event, (first, number, _) in _STAGES.items()
           )},
           sum(revenue_amount) AS total_revenue
    FROM se GROUP BY ALL))""",
    "pm": f"""
SELECT *, {_rate("cart_adds", "total_views")} AS view_to_cart_rate,
       {_rate("purchases", "cart_adds")} AS cart_to_purchase_rate,
       {_rate("purchases", "total_views")} AS overall_conversion_rate,
       {_rate("total_revenue", "purchases")} AS avg_order_value,
       {_rate("cart_adds - purchases", "cart_adds")} AS cart_abandonment_rate
FROM (
  SELECT product_id,
         coalesce(sum(revenue_amount) FILTER (WHERE event_type = 'purchase'), 0) AS total_revenue,
         min(event_date) AS first_interaction_date, max(event_date) AS last_interaction_date,
         {_distinct("event_id", "event_type = 'product_view'", "total_views")},
         {_distinct("user_id", "event_type = 'product_view'", "unique_viewers")},
         {_distinct("session_id", "event_type = 'product_view'", "view_sessions")},
         {_distinct("event_id", "event_type = 'add_to_cart'", "cart_adds")},
         {_distinct("user_id", "event_type = 'add_to_cart'", "users_added_to_cart")},
         {_distinct("event_id", "event_type = 'remove_from_cart'", "cart_removes")},
         {_distinct("event_id", "event_type = 'purchase'", "purchases")},
         {_distinct("user_id", "event_type = 'purchase'", "purchasing_users")},
         count(DISTINCT event_date) AS active_days
  FROM se WHERE product_id IS NOT NULL GROUP BY product_id)""",
    "perf": """
SELECT pm.*, product_name, category, subcategory, brand, price, price_tier, rating, rating_tier,
       is_in_stock,
       CASE WHEN total_revenue::DOUBLE >= p90 THEN 'Top Performer'
            WHEN total_revenue::DOUBLE >= p50 THEN 'Above Average'
            WHEN total_revenue > 0 THEN 'Below Average' ELSE 'No Sales' END AS revenue_tier,
       CASE WHEN overall_conversion_rate >= 0.1 THEN 'High Converting'
            WHEN overall_conversion_rate >= 0.05 THEN 'Average Converting'
            WHEN overall_conversion_rate >= 0.01 THEN 'Low Converting'
            ELSE 'Very Low' END AS conversion_tier
FROM pm LEFT JOIN sp USING (product_id),
     (SELECT quantile_cont(total_revenue::DOUBLE, 0.9) AS p90,
             quantile_cont(total_revenue::DOUBLE, 0.5) AS p50 FROM pm)""",
    "act": f"""
SELECT *, CASE WHEN recency_days <= 7 THEN 5 WHEN recency_days <= 14 THEN 4
               WHEN recency_days <= 30 THEN 3 WHEN recency_days <= 60 THEN 2 ELSE 1 END AS recency_score,
       ntile(5) OVER (ORDER BY total_sessions, user_id) AS frequency_score,
       ntile(5) OVER (ORDER BY total_revenue, user_id) AS monetary_score
FROM (
  SELECT user_id, count(DISTINCT session_id) AS total_sessions,
         count(DISTINCT session_date) AS active_days, min(session_date) AS first_activity_date,
         max(session_date) AS last_activity_date, sum(total_events)::BIGINT AS total_events,
         sum(page_views)::BIGINT AS total_page_views,
         sum(product_views)::BIGINT AS total_product_views,
         sum(purchases)::BIGINT AS total_purchases, sum(session_revenue) AS total_revenue,
         avg(session_duration_seconds) AS avg_session_duration,
         avg(engagement_score) AS avg_engagement_score,
         datediff('day', max(session_date), {AS_OF}::DATE) AS recency_days
  FROM ses GROUP BY user_id)""",
    "du": """
SELECT user_id, user_segment, preferred_device, acquisition_source, country_code, city,
       account_created_at, account_created_date, account_age_days, tenure_tier, is_email_subscribed,
       ifnull(total_sessions, 0) AS lifetime_sessions, ifnull(active_days, 0) AS lifetime_active_days,
       first_activity_date, last_activity_date, ifnull(total_events, 0) AS lifetime_events,
       ifnull(total_page_views, 0) AS lifetime_page_views,
       ifnull(total_product_views, 0) AS lifetime_product_views,
       ifnull(total_purchases, 0) AS lifetime_purchases,
       ifnull(total_revenue, 0) AS lifetime_revenue,
       ifnull(avg_session_duration, 0) AS avg_session_duration_seconds,
       ifnull(avg_engagement_score, 0) AS avg_engagement_score,
       ifnull(recency_days, 999) AS recency_days, ifnull(recency_score, 1) AS recency_score,
       ifnull(frequency_score, 1) AS frequency_score, ifnull(monetary_score, 1) AS monetary_score,
       ifnull(recency_score, 1) + ifnull(frequency_score, 1) + ifnull(monetary_score, 1)
         AS rfm_total_score,
       CASE WHEN total_revenue >= 1000 THEN 'VIP' WHEN total_revenue >= 500 THEN 'High Value'
            WHEN total_revenue >= 100 THEN 'Medium Value' WHEN total_revenue > 0 THEN 'Low Value'
            ELSE 'No Purchase' END AS customer_value_tier,
       CASE WHEN recency_days IS NULL THEN 'Never Active' WHEN recency_days <= 7 THEN 'Active'
            WHEN recency_days <= 30 THEN 'Recent' WHEN recency_days <= 90 THEN 'Lapsing'
            ELSE 'Churned' END AS activity_status,
       CASE WHEN total_purchases > 1 THEN 'Repeat Buyer' WHEN total_purchases = 1
            THEN 'One-Time Buyer' ELSE 'Non-Buyer' END AS buyer_status
FROM su LEFT JOIN act USING (user_id)""",
    "dp": """
SELECT *, CASE WHEN total_revenue > 0 AND overall_conversion_rate > 0.05 THEN 'Star'
               WHEN total_views > 100 AND overall_conversion_rate <= 0.02 THEN 'Underperformer'
               WHEN total_views < 10 THEN 'Low Visibility' ELSE 'Standard' END AS product_health
FROM (
  SELECT sp.*, ifnull(total_views, 0) AS total_views, ifnull(unique_viewers, 0) AS unique_viewers,
         ifnull(cart_adds, 0) AS total_cart_adds, ifnull(purchases, 0) AS total_purchases,
         ifnull(total_revenue, 0) AS total_revenue,
         ifnull(view_to_cart_rate, 0) AS view_to_cart_rate,
         ifnull(cart_to_purchase_rate, 0) AS cart_to_purchase_rate,
         ifnull(overall_conversion_rate, 0) AS overall_conversion_rate,
         ifnull(cart_abandonment_rate, 0) AS cart_abandonment_rate,
         ifnull(avg_order_value, 0) AS avg_order_value, first_interaction_date,
         last_interaction_date, ifnull(active_days, 0) AS active_days,
         ifnull(revenue_tier, 'No Sales') AS revenue_tier,
         ifnull(conversion_tier, 'Very Low') AS conversion_tier
  FROM sp LEFT JOIN (SELECT product_id, total_views, unique_viewers, cart_adds, purchases,
                            total_revenue, view_to_cart_rate, cart_to_purchase_rate,
                            overall_conversion_rate, cart_abandonment_rate, avg_order_value,
                            first_interaction_date, last_interaction_date, active_days,
                            revenue_tier, conversion_tier FROM perf) USING (product_id))""",
    "dd": f"""
SELECT d AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
       week(d) AS week_of_year, dayofyear(d) AS day_of_year, day(d) AS day_of_month,
       dayofweek(d) AS day_of_week, monthname(d) AS month_name, monthname(d)[:3] AS month_short,
       dayname(d) AS day_name, dayname(d)[:3] AS day_short, strftime(d, '%Y-%m-%d') AS date_iso,
       strftime(d, '%Y%m%d') AS date_int, strftime(d, '%m/%d/%Y') AS date_us,
       strftime(d, '%d.%m.%Y') AS date_eu, year(d) AS fiscal_year, quarter(d) AS fiscal_quarter,
       date_trunc('week', d)::DATE AS week_start, (date_trunc('week', d) + to_days(6))::DATE AS week_end,
       date_trunc('month', d)::DATE AS month_start, last_day(d) AS month_end,
       date_trunc('quarter', d)::DATE AS quarter_start,
       last_day(date_trunc('quarter', d) + to_months(2)) AS quarter_end,
       make_date(year(d), 1, 1) AS year_start, make_date(year(d), 12, 31) AS year_end,
       dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) BETWEEN 1 AND 5 AS is_weekday,
       day(d) = 1 AS is_month_start, d = last_day(d) AS is_month_end,
       dayofyear(d) = 1 AS is_year_start, month(d) = 12 AND day(d) = 31 AS is_year_end,
       ago = 0 AS is_today, ago = 1 AS is_yesterday, ago BETWEEN 1 AND 7 AS is_last_7_days,
       ago BETWEEN 1 AND 30 AS is_last_30_days, ago BETWEEN 1 AND 90 AS is_last_90_days,
       (d - to_days(7))::DATE AS same_day_last_week, (d - to_months(1))::DATE AS same_day_last_month,
       (d - to_years(1))::DATE AS same_day_last_year
FROM (SELECT d, datediff('day', d, {AS_OF}::DATE) AS ago
      FROM (SELECT unnest(generate_series(min(ts)::DATE, max(ts)::DATE + 30, INTERVAL 1 DAY))::DATE AS d
            FROM events))""",
    "order_days": """
SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE
       AS date
FROM orders""",
    "de": f"""
SELECT event_date, count(DISTINCT user_id) AS daily_active_users,
       count(DISTINCT session_id) AS total_sessions, count(*) AS total_events,
       {_types({"page_views": "page_view", "product_views": "product_view", "searches": "search",
                "add_to_cart_events": "add_to_cart", "checkout_starts": "begin_checkout",
                "purchases": "purchase", "signups": "signup", "logins": "login"})},
       sum(revenue_amount) AS total_revenue, count(DISTINCT product_id) AS unique_products_viewed,
       count(DISTINCT product_category) AS unique_categories_viewed,
       {_types({f"{d}_events": d for d in DEVICES}, "device_type")},
       {_types({f"{n}_events": s for n, s in SOURCE_NAMES.items()}, "traffic_source")}
FROM se GROUP BY event_date""",
    "fde": f"""
SELECT *, {_growth("daily_active_users", "prev_day_dau")} AS dau_dod_change,
       {_growth("total_revenue", "prev_day_revenue")} AS revenue_dod_change,
       {_growth("daily_active_users", "prev_week_dau")} AS dau_wow_change,
       {_growth("total_revenue", "prev_week_revenue")} AS revenue_wow_change
FROM (
  SELECT de.*, converted_sessions, avg_session_duration, avg_events_per_session,
         avg_engagement_score, {_rate("converted_sessions", "total_sessions")} AS conversion_rate,
         {_rate("total_revenue", "purchases")} AS avg_order_value,
         {_rate("total_events", "daily_active_users")} AS events_per_user,
         {_rate("total_revenue", "daily_active_users")} AS revenue_per_user,
         avg(daily_active_users) OVER week AS dau_7d_avg,
         avg(total_revenue::DOUBLE) OVER week AS revenue_7d_avg,
         (sum(daily_active_users) OVER week)::BIGINT AS wau_approximation,
         lag(daily_active_users) OVER days AS prev_day_dau,
         lag(total_revenue) OVER days AS prev_day_revenue,
         lag(purchases) OVER days AS prev_day_purchases,
         lag(daily_active_users, 7) OVER days AS prev_week_dau,
         lag(total_revenue, 7) OVER days AS prev_week_revenue
  FROM de LEFT JOIN (
    SELECT session_date, count(DISTINCT session_id) FILTER (WHERE is_converted) AS converted_sessions,
           avg(session_duration_seconds) AS avg_session_duration,
           avg(total_events) AS avg_events_per_session, avg(engagement_score) AS avg_engagement_score
    FROM ses GROUP BY session_date) ON event_date = session_date
  WINDOW days AS (ORDER BY event_date),
         week AS (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""",
    "fun": f"""
SELECT *, avg(overall_conversion_rate) OVER week AS conversion_rate_7d_avg,
       avg(cart_abandonment_rate) OVER week AS cart_abandonment_7d_avg,
       lag(overall_conversion_rate, 7) OVER (ORDER BY event_date) AS prev_week_conversion_rate,
       lag(cart_abandonment_rate, 7) OVER (ORDER BY event_date) AS prev_week_cart_abandonment
FROM (
  SELECT *, {_rate("users_at_product", "users_at_site")} AS site_to_product_rate,
         {_rate("users_at_cart", "users_at_product")} AS product_to_cart_rate,
         {_rate("users_at_checkout", "users_at_cart")} AS cart_to_checkout_rate,
         {_rate("users_at_purchase", "users_at_checkout")} AS checkout_to_purchase_rate,
         {_rate("users_at_purchase", "users_at_site")} AS overall_conversion_rate,
         {_rate("bounced_users", "users_at_site")} AS bounce_rate,
         {_rate("cart_abandoned_users", "users_at_cart")} AS cart_abandonment_rate,
         {_rate("checkout_abandoned_users", "users_at_checkout")} AS checkout_abandonment_rate,
         {_rate("total_revenue", "users_at_purchase")} AS avg_order_value,
         {_rate("total_revenue", "users_at_site")} AS revenue_per_visitor
  FROM (
    SELECT event_date, sum(total_revenue) AS total_revenue,
           {", ".join(_distinct("user_id", f"reached_{s}", f"users_at_{s}") for s in _FUNNEL)},
           {", ".join(_distinct("session_id", f"reached_{s}", f"sessions_at_{s}") for s in _FUNNEL)},
           {", ".join(_distinct("user_id", f"drop_off_stage = '{d}'", n) for n, d in _DROPS.items())},
           {", ".join(f"avg({t}) AS avg_{t}" for t in _STAGE_TIMES)}
    FROM jour GROUP BY event_date))
WINDOW week AS (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "catrev": _category_revenue("se"),
    "catrev_mid": _category_revenue("se_mid"),
    "frev": f"""
SELECT *, {_growth("gross_revenue", "prev_day_revenue")} AS revenue_dod_growth,
       {_growth("gross_revenue", "prev_week_revenue")} AS revenue_wow_growth
FROM (
  SELECT catrev.*, category_avg_price,
         sum(gross_revenue) OVER (PARTITION BY event_date) AS daily_total_revenue,
         gross_revenue::DOUBLE
           / nullif((sum(gross_revenue) OVER (PARTITION BY event_date))::DOUBLE, 0)
           AS category_revenue_share,
         sum(gross_revenue) OVER week AS revenue_7d_rolling,
         avg(gross_revenue::DOUBLE) OVER week AS revenue_7d_avg,
         sum(gross_revenue) OVER (days ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
           AS revenue_30d_rolling,
         lag(gross_revenue) OVER days AS prev_day_revenue,
         lag(gross_revenue, 7) OVER days AS prev_week_revenue,
         sum(gross_revenue) OVER (days ROWS UNBOUNDED PRECEDING) AS cumulative_revenue
  FROM catrev LEFT JOIN (SELECT category, avg(price::DOUBLE) AS category_avg_price
                         FROM sp GROUP BY category) USING (category)
  WINDOW days AS (PARTITION BY category ORDER BY event_date),
         week AS (PARTITION BY category ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""",
    "fe": """
SELECT *, timestamp::DATE AS event_date, hour(timestamp) AS event_hour,
       isodow(timestamp) - 1 AS day_of_week, isodow(timestamp) >= 6 AS is_weekend
FROM ev""",
    "fs": f"""
SELECT session_id, user_id, min(timestamp) AS session_start, max(timestamp) AS session_end,
       count(event_id) AS event_count, {_types(FLAT_TYPES)}, sum(revenue) AS total_revenue,
       count(DISTINCT product_id) AS unique_products,
       first(country ORDER BY timestamp, event_id) FILTER (WHERE country IS NOT NULL) AS countries,
       first(device ORDER BY timestamp, event_id) FILTER (WHERE device IS NOT NULL) AS devices,
       (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6::DOUBLE
         AS session_duration_seconds,
       count(*) FILTER (WHERE event_type = 'purchase') > 0 AS is_converted
FROM ev WHERE session_id IS NOT NULL AND user_id IS NOT NULL GROUP BY session_id, user_id""",
    "valid": f"""
SELECT * FROM (
  SELECT {_strip("event_id")} AS event_id, event_type, {_strip("user_id")} AS user_id,
         {_strip("session_id")} AS session_id, timestamp, properties, device,
         {_strip("country")} AS country, traffic_source, {_strip("product_id")} AS product_id,
         {_strip("category")} AS category, revenue
  FROM ev_damaged)""",
    "broken": """
SELECT event_id, unnest(list_filter([
         if(ifnull(regexp_full_match(event_id, 'EVT_[A-F0-9]{16}'), false), NULL, 'event_id'),
         if(ifnull(event_type IN ('page_view', 'product_view', 'add_to_cart', 'remove_from_cart',
              'begin_checkout', 'purchase', 'search', 'signup', 'login'), false), NULL, 'event_type'),
         if(ifnull(regexp_full_match(user_id, 'USER_[A-F0-9]{12}'), false), NULL, 'user_id'),
         if(ifnull(regexp_full_match(session_id, 'SES_[A-F0-9]{16}'), false), NULL, 'session_id'),
         if(timestamp IS NULL, 'timestamp', NULL),
         if(ifnull(json_valid(properties) AND left(trim(properties), 1) IN ('{', '"'), false),
            NULL, 'properties'),
         if(device NOT IN ('mobile', 'desktop', 'tablet'), 'device', NULL),
         if(length(country) <> 2, 'country', NULL),
         if(traffic_source NOT IN ('organic', 'paid_search', 'social', 'email', 'direct', 'referral'),
            'traffic_source', NULL),
         if(NOT regexp_full_match(product_id, 'PROD_[A-F0-9]{8}'), 'product_id', NULL),
         if(ifnull(revenue BETWEEN 0 AND 100000, false), NULL, 'revenue')
       ], lambda code: code IS NOT NULL)) AS rule
FROM valid""",
    "good": "SELECT * FROM valid WHERE event_id NOT IN (SELECT event_id FROM broken)",
    # late rows lack their revenue and are refused; early ones have no device that could be wrong
    "good_mixed": f"""
SELECT * FROM valid WHERE timestamp < {MID_MONTH}
  AND event_id NOT IN (SELECT event_id FROM broken WHERE rule <> 'device')""",
    "copies": "SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE event_type = 'purchase'",
    "copies_damaged": (
        "SELECT * FROM ev_damaged UNION ALL SELECT * FROM ev_damaged WHERE event_type = 'purchase'"
    ),
    "se_copies": _stg_events("copies_damaged", AS_OF),
}


def _daily(source: str) -> str:
    return f"""
SELECT timestamp::DATE AS event_date, count(event_id) AS total_events, {_types(FLAT_TYPES)},
       sum(revenue) AS total_revenue, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT session_id) AS unique_sessions,
       count(*) FILTER (WHERE event_type = 'purchase')::DOUBLE / count(DISTINCT session_id)
         AS conversion_rate,
       sum(revenue)::DOUBLE / count(DISTINCT user_id) AS avg_revenue_per_user
FROM {source} GROUP BY 1"""


def _issues(source: str, now: str, crowd: int) -> str:
    """The issues of all checks with their measured values."""
    columns = [c.strip() for c in EVENT_COLUMNS.split(",")]
    rates = ", ".join(
        f"('{c}', (SELECT count(*) FILTER (WHERE {c} IS NULL)::DOUBLE / count(*) FROM {source}))"
        for c in columns
    )
    return f"""
SELECT 'duplicates' AS "check", 'high' AS severity, NULL::VARCHAR AS "column", n AS "count",
       NULL::DOUBLE AS null_rate, NULL::DOUBLE AS max_value,
       format('Found {{}} duplicate event IDs', n) AS message
FROM (SELECT sum(c)::BIGINT AS n
      FROM (SELECT count(*) AS c FROM {source} GROUP BY event_id HAVING count(*) > 1))
WHERE n > 0
UNION ALL
SELECT 'null_rate', 'medium', name, NULL, rate, NULL,
       printf('Column ''%s'' has %.1f%% null values', name, rate * 100)
FROM (VALUES {rates}) AS rates(name, rate) WHERE rate > 0.1
UNION ALL
SELECT 'revenue_outliers', 'low', NULL, n, NULL, top, format('Found {{}} revenue outliers', n)
FROM (SELECT count(*) AS n, max(revenue)::DOUBLE AS top
      FROM {source}, (SELECT avg(revenue::DOUBLE) AS mean, stddev_samp(revenue::DOUBLE) AS dev
                      FROM {source} WHERE revenue > 0)
      WHERE revenue > 0 AND dev > 0 AND abs(revenue::DOUBLE - mean) / dev > 3)
WHERE n > 0
UNION ALL
SELECT 'future_timestamps', 'high', NULL, n, NULL, NULL,
       format('Found {{}} events with future timestamps', n)
FROM (SELECT count(*) AS n FROM {source} WHERE timestamp > {now}) WHERE n > 0
UNION ALL
SELECT 'session_integrity', 'medium', NULL, n, NULL, NULL,
       format('Found {{}} sessions with >{crowd} events', n)
FROM (SELECT count(*) AS n FROM (SELECT session_id FROM {source} WHERE session_id IS NOT NULL
                                 GROUP BY session_id HAVING count(*) > {crowd}))
WHERE n > 0"""


SUB["fdm"] = _daily("ev")
SUB["fpp"] = """
SELECT *, cart_adds::DOUBLE / greatest(view_count, 1) AS cart_rate,
       purchases::DOUBLE / greatest(view_count, 1) AS purchase_rate
FROM (SELECT product_id, category,
             count(*) FILTER (WHERE event_type = 'product_view') AS view_count,
             count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds,
             count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
             sum(revenue) AS total_revenue, count(DISTINCT user_id) AS unique_viewers
      FROM ev WHERE product_id IS NOT NULL AND category IS NOT NULL GROUP BY product_id, category)"""
SUB["gap_events"] = """
SELECT *, max(opened) OVER (PARTITION BY user_id ORDER BY timestamp
                            RANGE UNBOUNDED PRECEDING) AS session_start
FROM (SELECT event_id, user_id, timestamp,
             if(ifnull(epoch_us(timestamp) - epoch_us(lag(timestamp) OVER mine) >= 1800000000, true),
                timestamp, NULL) AS opened
      FROM ev WINDOW mine AS (PARTITION BY user_id ORDER BY timestamp))"""
SUB["gap_named"] = f"""
SELECT *, {_digest_key("SES_", "user_id || '@' || strftime(session_start, '%Y-%m-%d %H:%M:%S.%f')", 16)}
         AS session_id
FROM gap_events"""
SUB["issues"] = _issues("copies", MID_MONTH, 1000)
SUB["issues_clean"] = _issues("ev", MID_MONTH, 4)


def _chain(body: str) -> str:
    """``body`` with the sub-queries it names, directly or not, in front."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in SUB:
            if name not in needed and re.search(rf"(?<![\w.'])\b{name}\b(?!\()", sql):
                needed.add(name)
                visit(SUB[name])

    visit(body)
    order: list[str] = []

    def place(name: str) -> None:
        if name in order:
            return
        for other in SUB:
            if other != name and re.search(rf"(?<![\w.'])\b{other}\b(?!\()", SUB[name]):
                place(other)
        order.append(name)

    for name in SUB:
        if name in needed:
            place(name)
    parts = ", ".join(f"{name} AS ({SUB[name]})" for name in order)
    return f"WITH {parts} {body}" if parts else body


def _out(source: str, dates: str = "", moments: str = "", reals: str = "") -> str:
    """All columns of ``source`` with dates, moments and reals in comparable form."""
    changes = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates.split()]
    changes += [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in moments.split()]
    changes += [f"round({c}::DOUBLE, 6) AS {c}" for c in reals.split()]
    replaced = f" REPLACE ({', '.join(changes)})" if changes else ""
    return _chain(f"SELECT *{replaced} FROM {source}")


_STG_EVENT_FORMS = ("event_date", "event_timestamp", "revenue_amount")
_SESSION_FORMS = (
    "session_date",
    "session_start session_end",
    "session_revenue max_order_value engagement_score",
)
_DAILY_FORMS = ("event_date", "", "total_revenue conversion_rate avg_revenue_per_user")
_RATES = (
    "view_to_cart_rate cart_to_purchase_rate overall_conversion_rate avg_order_value "
    "cart_abandonment_rate"
)
_EVENT_FORMS = ("", "timestamp", "revenue")

# An event as one line of JSON.
_ROW_TEXT = " || ',' || ".join(
    f"""'"{c.strip()}":' || """
    + {
        "timestamp": "'\"' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%g') || '\"'",
        "revenue": "ifnull(revenue::DECIMAL(18,2)::VARCHAR, 'null')",
    }.get(c.strip(), f"ifnull(to_json({c.strip()})::VARCHAR, 'null')")
    for c in EVENT_COLUMNS.split(",")
)
_ROW_TEXT = "'{' || " + _ROW_TEXT + " || '}'"

ORACLE: dict[str, str] = {
    "stg_events": _out("se", *_STG_EVENT_FORMS),
    "stg_events_mid_month": _out("se_mid", *_STG_EVENT_FORMS),
    "stg_products": _out("sp", reals="price rating"),
    "stg_users": _out("su", "account_created_date", "account_created_at", "historical_ltv"),
    "int_sessions": _out("ses", *_SESSION_FORMS),
    "int_user_journey": _out(
        "jour", "event_date", " ".join(first for first, _, _ in _STAGES.values()), "total_revenue"
    ),
    "int_product_performance": _out(
        "perf",
        "first_interaction_date last_interaction_date",
        "",
        f"total_revenue price rating {_RATES}",
    ),
    "dim_users": _out(
        "du",
        "account_created_date first_activity_date last_activity_date",
        "account_created_at",
        "lifetime_revenue avg_session_duration_seconds avg_engagement_score",
    ),
    "dim_products": _out(
        "dp",
        "first_interaction_date last_interaction_date",
        "",
        f"price rating total_revenue {_RATES}",
    ),
    "dim_date": _out(
        "dd",
        "date_key week_start week_end month_start month_end quarter_start quarter_end year_start "
        "year_end same_day_last_week same_day_last_month same_day_last_year",
    ),
    "fct_daily_engagement": _out(
        "fde",
        "event_date",
        "",
        "total_revenue avg_session_duration avg_events_per_session avg_engagement_score "
        "conversion_rate avg_order_value events_per_user revenue_per_user dau_7d_avg "
        "revenue_7d_avg prev_day_revenue prev_week_revenue dau_dod_change revenue_dod_change "
        "dau_wow_change revenue_wow_change",
    ),
    "fct_funnel": _out(
        "fun",
        "event_date",
        "",
        "total_revenue site_to_product_rate product_to_cart_rate cart_to_checkout_rate "
        "checkout_to_purchase_rate overall_conversion_rate bounce_rate cart_abandonment_rate "
        "checkout_abandonment_rate avg_order_value revenue_per_visitor conversion_rate_7d_avg "
        "cart_abandonment_7d_avg prev_week_conversion_rate prev_week_cart_abandonment "
        + " ".join(f"avg_{t}" for t in _STAGE_TIMES),
    ),
    "fct_revenue": _out(
        "frev",
        "event_date",
        "",
        "gross_revenue avg_transaction_value min_transaction_value max_transaction_value "
        "category_avg_price daily_total_revenue category_revenue_share revenue_7d_rolling "
        "revenue_7d_avg revenue_30d_rolling prev_day_revenue prev_week_revenue "
        "cumulative_revenue revenue_dod_growth revenue_wow_growth "
        + " ".join(f"{name}_revenue" for name in [*DEVICES, *SOURCE_NAMES]),
    ),
    "flat_events": _out("fe", "event_date", "timestamp", "revenue"),
    "flat_sessions": _out(
        "fs", "", "session_start session_end", "total_revenue session_duration_seconds"
    ),
    "flat_daily_metrics": _out("fdm", *_DAILY_FORMS),
    "flat_product_performance": _out("fpp", reals="total_revenue cart_rate purchase_rate"),
    "metric_summary": _chain(f"""
SELECT t.*, round({_rate("carts", "views")}, 6) AS view_to_cart_rate,
       round({_rate("purchases", "carts")}, 6) AS cart_to_purchase_rate,
       round({_rate("purchases", "views")}, 6) AS overall_conversion_rate, event_type, events
FROM (SELECT count(*) AS total_events, round(sum(revenue)::DOUBLE, 6) AS total_revenue,
             round(ifnull(avg(revenue::DOUBLE) FILTER (WHERE revenue > 0), 0), 6) AS avg_order_value,
             count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS unique_sessions
      FROM ev) AS t,
     (SELECT {_types({"views": "product_view", "carts": "add_to_cart", "purchases": "purchase"})}
      FROM ev),
     (SELECT event_type, count(*) AS events FROM ev GROUP BY event_type)"""),
    "event_profile": _chain("""
SELECT event_type, number AS "count", total_events,
       strftime(first_event, '%Y-%m-%d %H:%M:%S.%f') AS first_event,
       strftime(last_event, '%Y-%m-%d %H:%M:%S.%f') AS last_event,
       round(total_revenue::DOUBLE, 6) AS total_revenue, unique_users, unique_sessions,
       round(100.0::DOUBLE * number / total_events, 6) AS percent
FROM (SELECT event_type, count(*) AS number FROM ev GROUP BY event_type),
     (SELECT count(*) AS total_events, min(timestamp) AS first_event,
             max(timestamp) AS last_event, sum(revenue) AS total_revenue,
             count(DISTINCT user_id) AS unique_users,
             count(DISTINCT session_id) AS unique_sessions FROM ev)"""),
    "sessionize_gap": _chain("""
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY session_start) AS session_number,
       strftime(session_start, '%Y-%m-%d %H:%M:%S.%f') AS session_start,
       strftime(session_end, '%Y-%m-%d %H:%M:%S.%f') AS session_end, event_count, session_id
FROM (SELECT user_id, session_id, session_start, max(timestamp) AS session_end,
             count(*) AS event_count
      FROM gap_named GROUP BY user_id, session_id, session_start)"""),
    "sessionize_events": _chain("""
SELECT event_id, user_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, session_id
FROM gap_named"""),
    "calendar_iso": _chain("""
SELECT strftime(date, '%Y-%m-%d') AS date, strftime(date, '%Y%m%d')::INTEGER AS date_key,
       year(date) AS year, quarter(date) AS quarter, month(date) AS month,
       monthname(date) AS month_name, week(date) AS week, day(date) AS day_of_month,
       isodow(date) - 1 AS day_of_week, dayname(date) AS day_name,
       isodow(date) > 5 AS is_weekend, day(date) = 1 AS is_month_start,
       date = last_day(date) AS is_month_end
FROM order_days"""),
    "date_range": _chain("""
SELECT kind, strftime(date, '%Y-%m-%d') AS date
FROM order_days, (VALUES ('end'), ('days'), ('as_of')) AS kinds(kind)"""),
    "validate_events": _out("good", *_EVENT_FORMS),
    "validate_events_errors": _chain("""
SELECT 'ValidationError' AS error_class, rule, count(*) AS errors FROM broken GROUP BY rule
UNION ALL
SELECT 'ValidationError', 'any', count(DISTINCT coalesce(event_id, '')) FROM broken
HAVING count(*) > 0"""),
    "validate_events_samples": _chain("""
SELECT rule, position, event_id
FROM (SELECT rule, event_id,
             row_number() OVER (PARTITION BY rule ORDER BY event_id) AS position FROM broken)
WHERE position <= 5"""),
    "validate_files_samples": _chain(f"""
SELECT rule, position, row, 'ValidationError: ' || codes AS message, left(text, 200) AS data
FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY row) AS position
      FROM (SELECT row_number() OVER (ORDER BY timestamp >= {MID_MONTH}, event_id) - 1 AS row,
                   {_strip("event_id")} AS known, {_ROW_TEXT} AS text FROM ev_damaged)
      JOIN (SELECT event_id AS known, rule, string_agg(rule, ',') OVER (
              PARTITION BY event_id ORDER BY list_position([{", ".join(f"'{c.strip()}'" for c in EVENT_COLUMNS.split(","))}], rule)
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS codes FROM broken) USING (known))
WHERE position <= 5"""),
    "validate_products": _chain("""
SELECT product_id, product_name, category, subcategory, round(price, 6) AS price, brand,
       round(rating, 6) AS rating, review_count, in_stock
FROM prod
WHERE product_id[-1] NOT IN ('0', '1', '2', '3', '4') AND length(product_name) BETWEEN 1 AND 200
  AND length(category) BETWEEN 1 AND 100 AND price > 0 AND price <= 100000
  AND rating BETWEEN 0 AND 5 AND review_count >= 0"""),
    "validate_users": _chain("""
SELECT user_id, segment, primary_device, traffic_source,
       if(user_id[-1] = '2', 'UK', country) AS country, city,
       strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at, is_subscribed,
       round(lifetime_value, 6) AS lifetime_value
FROM usr
WHERE user_id[-1] NOT IN ('0', '1') AND segment IS NOT NULL AND primary_device IS NOT NULL
  AND traffic_source IS NOT NULL AND (country IS NOT NULL OR user_id[-1] = '2')"""),
    "validity_rate": _chain("""
SELECT total AS total_records, fine AS valid_records, total - fine AS invalid_records,
       round(fine::DOUBLE / total * 100, 6) AS validity_rate
FROM (SELECT (SELECT count(*) FROM ev_damaged) AS total, (SELECT count(*) FROM good) AS fine)"""),
    "dq_duplicates": _chain("SELECT * FROM issues WHERE \"check\" = 'duplicates'"),
    "dq_null_rates": _chain(
        "SELECT * REPLACE (round(null_rate, 6) AS null_rate) FROM issues_clean "
        "WHERE \"check\" = 'null_rate'"
    ),
    "dq_revenue_outliers": _chain("SELECT * FROM issues_clean WHERE \"check\" = 'revenue_outliers'"),
    "dq_future_timestamps": _chain("SELECT * FROM issues_clean WHERE \"check\" = 'future_timestamps'"),
    "dq_session_integrity": _chain("SELECT * FROM issues_clean WHERE \"check\" = 'session_integrity'"),
    "dq_issues": _chain("SELECT * REPLACE (round(null_rate, 6) AS null_rate) FROM issues"),
    "dq_high_severity": _chain(
        "SELECT * REPLACE (round(null_rate, 6) AS null_rate) FROM issues WHERE severity = 'high'"
    ),
    "dq_report": _chain("""
SELECT 0::BIGINT AS rank, 'all' AS severity, 'totals' AS "check",
       format('Total records: {:,}, issues found: {}', (SELECT count(*) FROM copies),
              (SELECT count(*) FROM issues)) AS message
UNION ALL
SELECT list_position(['high', 'medium', 'low'], severity)::BIGINT, severity, "check", message
FROM issues"""),
    "assert_columns": _chain(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            _assertions(table, source)
            for table, source in {
                "raw.events": "ev",
                "seeds.products": "prod",
                "seeds.users": "usr",
                "stg_events": "se",
                "stg_products": "sp",
                "stg_users": "su",
                "int_sessions": "ses",
                "int_user_journey": "jour",
                "int_product_performance": "perf",
                "dim_users": "du",
                "dim_products": "dp",
                "dim_date": "dd",
                "fct_daily_engagement": "fde",
                "fct_funnel": "fun",
                "fct_revenue": "frev",
            }.items()
        )
        + ") AS found(table_name, column_name, test, violations)"
    ),
    "assert_columns_damaged": _chain(
        f"SELECT * FROM ({_assertions('raw.events', 'copies_damaged')} "
        f"UNION ALL {_assertions('stg_events', 'se_copies')}) "
        "AS found(table_name, column_name, test, violations)"
    ),
    "assert_funnel_order": _chain("""
SELECT strftime(event_date, '%Y-%m-%d') AS event_date, users_at_site, users_at_product,
       users_at_cart, users_at_checkout, users_at_purchase,
       CASE WHEN users_at_product > users_at_site THEN 'FAIL: product > site'
            WHEN users_at_cart > users_at_product THEN 'FAIL: cart > product'
            WHEN users_at_checkout > users_at_cart THEN 'FAIL: checkout > cart'
            ELSE 'FAIL: purchase > checkout' END AS funnel_check_result
FROM fun
WHERE NOT (users_at_site >= users_at_product AND users_at_product >= users_at_cart
           AND users_at_cart >= users_at_checkout AND users_at_checkout >= users_at_purchase)"""),
    "assert_revenue_consistency": _chain("""
SELECT strftime(event_date, '%Y-%m-%d') AS event_date,
       round(total_revenue::DOUBLE, 6) AS engagement_revenue,
       round(found::DOUBLE, 6) AS category_revenue,
       round(abs(total_revenue - ifnull(found, 0))::DOUBLE, 6) AS difference
FROM de LEFT JOIN (SELECT event_date, sum(gross_revenue) AS found FROM catrev_mid GROUP BY 1)
  USING (event_date)
WHERE abs(total_revenue - ifnull(found, 0)) > 0.01"""),
    "assert_orphan_sessions": _chain(
        "SELECT DISTINCT user_id FROM ses_damaged WHERE user_id NOT IN (SELECT user_id FROM su)"
    ),
    "kpi_latest": _chain("""
SELECT strftime(event_date, '%Y-%m-%d') AS event_date, unique_users,
       if(p_users > 0, round((unique_users - p_users)::DOUBLE / p_users, 6), NULL)
         AS unique_users_change,
       unique_sessions,
       if(p_sessions > 0, round((unique_sessions - p_sessions)::DOUBLE / p_sessions, 6), NULL)
         AS unique_sessions_change,
       round(total_revenue::DOUBLE, 6) AS total_revenue,
       if(p_revenue > 0, round((total_revenue - p_revenue)::DOUBLE / p_revenue::DOUBLE, 6), NULL)
         AS total_revenue_change,
       round(if(unique_sessions > 0, purchases::DOUBLE / unique_sessions, 0), 6) AS conversion_rate
FROM (SELECT *, lag(unique_users) OVER days AS p_users, lag(unique_sessions) OVER days AS p_sessions,
             lag(total_revenue) OVER days AS p_revenue
      FROM fdm WINDOW days AS (ORDER BY event_date))
ORDER BY event_date DESC LIMIT 1"""),
    "trend_window": _chain("""
SELECT strftime(event_date, '%Y-%m-%d') AS event_date, unique_users, unique_sessions,
       round(total_revenue::DOUBLE, 6) AS total_revenue,
       round(purchases::DOUBLE / greatest(unique_sessions, 1), 6) AS conversion_rate
FROM fdm WHERE event_date >= (SELECT max(event_date) FROM fdm) - 7"""),
    "trend_conversion": _chain("""
SELECT strftime(event_date, '%Y-%m-%d') AS event_date,
       round(purchases::DOUBLE / greatest(unique_sessions, 1), 6) AS conversion_rate
FROM fdm"""),
    "funnel_overall": _chain("""
SELECT position, stage, number AS "count", round(number::DOUBLE / first_number, 6) AS conversion_rate,
       round(number::DOUBLE / lag(number) OVER (ORDER BY position), 6) AS step_rate
FROM (SELECT *, first_value(number) OVER (ORDER BY position) AS first_number
      FROM (VALUES (1, 'Page Views', (SELECT sum(page_views)::BIGINT FROM fdm)),
                   (2, 'Product Views', (SELECT sum(product_views)::BIGINT FROM fdm)),
                   (3, 'Add to Cart', (SELECT sum(add_to_carts)::BIGINT FROM fdm)),
                   (4, 'Checkout', (SELECT sum(purchases)::BIGINT FROM fdm)),
                   (5, 'Purchase', (SELECT sum(purchases)::BIGINT FROM fdm)))
           AS stages(position, stage, number))"""),
    "top_products": _chain("""
SELECT product_id, category, round(total_revenue::DOUBLE, 6) AS total_revenue, purchases
FROM (SELECT * FROM fpp ORDER BY fpp.total_revenue DESC, product_id, category LIMIT 10)"""),
    "category_conversion": _chain("""
SELECT category, sum(view_count)::BIGINT AS view_count, sum(purchases)::BIGINT AS purchases,
       round(sum(purchases)::DOUBLE / greatest(sum(view_count), 1)::DOUBLE, 6) AS conversion_rate
FROM fpp GROUP BY category ORDER BY conversion_rate DESC, category LIMIT 10"""),
    "duration_histogram": _chain("""
SELECT floor(session_duration_seconds / 72)::BIGINT AS bin,
       floor(session_duration_seconds / 72) * 72.0::DOUBLE AS bin_start, count(*) AS sessions
FROM fs WHERE session_duration_seconds < 3600 GROUP BY 1, 2"""),
    "sessions_by_device": _chain(
        'SELECT devices, count(*) AS "count" FROM fs WHERE devices IS NOT NULL GROUP BY devices'
    ),
    "sessions_by_quality": _chain(
        'SELECT session_quality, count(*) AS "count" FROM ses GROUP BY session_quality'
    ),
    "events_by_source": _chain(
        'SELECT traffic_source, count(*) AS "count" FROM ev WHERE traffic_source IS NOT NULL '
        "GROUP BY traffic_source"
    ),
    "revenue_by_source": _chain(
        "SELECT traffic_source, round(sum(revenue)::DOUBLE, 6) AS revenue FROM ev "
        "WHERE traffic_source IS NOT NULL GROUP BY traffic_source"
    ),
    "macro_rates": """
SELECT l_partkey, round(r::DOUBLE / n, 6) AS return_rate,
       round(if(a > 0, r::DOUBLE / a, 0), 6) AS returned_per_accepted,
       round(if(a > 0, (r - a)::DOUBLE / a, 0), 6) AS growth_over_accepted,
       round(if(a = 0, -1, r::DOUBLE / a), 6) AS safe_quotient,
       round(r::DOUBLE / greatest(a, 1), 6) AS at_least_one
FROM (SELECT l_partkey, count(*) FILTER (WHERE l_returnflag = 'R') AS r,
             count(*) FILTER (WHERE l_returnflag = 'A') AS a, count(*) AS n
      FROM lineitem GROUP BY l_partkey)""",
    "revenue_by_condition": _chain("""
SELECT strftime(event_date, '%Y-%m-%d') AS event_date,
       round(ifnull(sum(revenue_amount) FILTER (WHERE device_type = 'mobile'), 0)::DOUBLE, 6)
         AS mobile_revenue,
       round(ifnull(sum(revenue_amount) FILTER (WHERE country_code = 'US'), 0)::DOUBLE, 6)
         AS us_revenue,
       count(*) FILTER (WHERE event_type = 'search') AS searches
FROM se GROUP BY se.event_date"""),
    "quintile_bucket": """
SELECT c_custkey, round(c_acctbal, 6) AS c_acctbal,
       ntile(5) OVER (ORDER BY customer.c_acctbal, c_custkey) AS quintile
FROM customer""",
    "hash_key": """
SELECT c_custkey, upper(left(md5(c_name), 8)) AS short_key, upper(left(md5(c_name), 16)) AS long_key
FROM customer""",
    "safe_json": _chain("""
SELECT event_id, try_cast(TRY(properties ->> '$.k') AS INTEGER) AS k,
       ifnull(TRY(json_type(properties)), 'OBJECT') = 'OBJECT' AS is_object
FROM ev_damaged"""),
    "flatten_struct": """
SELECT o_orderkey AS order_key, o_orderstatus AS order_state_status,
       o_orderpriority AS order_state_priority, round(o_totalprice, 6) AS total_price,
       o_custkey AS customer
FROM orders""",
    "batch_job_daily_metrics": "",
    "batch_job_mixed_files": "",
    "batch_job_resumed": "",
    "batch_job_metrics": _chain("""
SELECT extracted AS records_extracted, validated AS records_validated,
       round(100.0::DOUBLE * validated / extracted, 6) AS validity_rate, 0::BIGINT AS errors_count
FROM (SELECT (SELECT count(*) FROM valid) AS extracted, (SELECT count(*) FROM good) AS validated)"""),
}
WEEKS = [f"TIMESTAMP '2024-01-{day:02d} 00:00:00'" for day in (8, 15, 22)]
SUB["streamed"] = f"""
SELECT user_id, session_start, max(timestamp) AS session_end, count(*) AS event_count
FROM gap_events GROUP BY user_id, session_start
HAVING max(timestamp) + INTERVAL 30 MINUTE
       <= (SELECT date_trunc('milliseconds', max(timestamp)) FROM ev) - INTERVAL 1 HOUR"""
SUB["snapshots"] = f"""
SELECT user_id, segment, city, {WEEKS[0]} AS taken FROM usr WHERE user_id[-1] <> '1'
UNION ALL
SELECT user_id, segment, if(user_id[-1] = '3', 'MOVED', city), {WEEKS[1]} FROM usr WHERE user_id[-1] <> '2'
UNION ALL
SELECT user_id, if(user_id[-1] = '3', NULL, segment), if(user_id[-1] = '3', 'MOVED', city), {WEEKS[2]}
FROM usr WHERE user_id[-1] <> '4'"""
SUB["history"] = f"""
SELECT user_id, segment, city, row_number() OVER mine AS version, taken AS valid_from,
       nullif(coalesce(least(lead(taken) OVER mine, gone), TIMESTAMP '9999-01-01'), TIMESTAMP '9999-01-01') AS valid_to
FROM (SELECT *, lag(user_id) OVER times IS NULL OR lag(taken) OVER times < taken - INTERVAL 7 DAY
                OR lag(segment) OVER times IS DISTINCT FROM segment
                OR lag(city) OVER times IS DISTINCT FROM city AS opens,
             -- the first time after this one at which the user is absent
             CASE WHEN user_id[-1] = '2' AND taken < {WEEKS[1]} THEN {WEEKS[1]}
                  WHEN user_id[-1] = '4' THEN {WEEKS[2]} END AS gone
      FROM snapshots WINDOW times AS (PARTITION BY user_id ORDER BY taken))
WHERE opens WINDOW mine AS (PARTITION BY user_id ORDER BY taken)"""
ORACLE["streamed_sessions"] = _out("streamed", "", "session_start session_end")
ORACLE["user_history"] = _chain("""
SELECT user_id, segment, city, version::INTEGER AS version,
       strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
       strftime(valid_to, '%Y-%m-%d %H:%M:%S.%f') AS valid_to
FROM history""")
ORACLE["revenue_by_segment_at_purchase"] = _chain("""
SELECT h.segment, h.city, h.version::INTEGER AS version, count(*) AS purchases,
       round(sum(revenue_amount)::DOUBLE, 6) AS revenue
FROM se LEFT JOIN history h ON h.user_id = se.user_id AND event_timestamp >= valid_from
  AND (valid_to IS NULL OR event_timestamp < valid_to)
WHERE is_revenue_event GROUP BY h.segment, h.city, h.version""")
ORACLE["incremental_engagement"] = ORACLE["fct_daily_engagement"]
ORACLE["incremental_funnel"] = ORACLE["fct_funnel"]
ORACLE["incremental_revenue"] = ORACLE["fct_revenue"]
ORACLE["trailing_active_users"] = _chain("""
SELECT strftime(day, '%Y-%m-%d') AS event_date,
       count(DISTINCT user_id) FILTER (WHERE event_date > day - 7) AS active_users_7d,
       count(DISTINCT user_id) FILTER (WHERE event_date > day - 30) AS active_users_30d
FROM (SELECT DISTINCT event_date AS day FROM se) JOIN se ON event_date BETWEEN day - 29 AND day
GROUP BY day""")
ORACLE["validate_events_moments"] = _chain("""
SELECT event_id, strftime(CASE digit
         WHEN 0 THEN date_trunc('second', timestamp) WHEN 1 THEN timestamp
         WHEN 2 THEN date_trunc('second', timestamp)
         WHEN 3 THEN date_trunc('second', timestamp) - INTERVAL 2 HOUR
         WHEN 4 THEN date_trunc('day', timestamp) WHEN 8 THEN date_trunc('second', timestamp)
         WHEN 9 THEN date_trunc('second', timestamp) + INTERVAL 7 MILLISECOND
         WHEN 10 THEN TIMESTAMP '1970-01-01 00:00:00' END, '%Y-%m-%d %H:%M:%S.%f') AS timestamp
FROM (SELECT event_id, timestamp, ('0x' || event_id[-1])::INTEGER AS digit FROM ev)
WHERE digit IN (0, 1, 2, 3, 4, 8, 9, 10)""")
SUB["issues_good"] = _issues("good", AS_OF, 1000)
ORACLE["batch_job_record"] = _chain("""
SELECT extracted AS records_extracted, validated AS records_validated,
       validated + sessions + dates + products AS records_loaded,
       round(100.0::DOUBLE * validated / extracted, 6) AS validity_rate, issues AS quality_issues_count,
       0::BIGINT AS errors_count
FROM (SELECT (SELECT count(*) FROM valid) AS extracted, (SELECT count(*) FROM good) AS validated,
             (SELECT count(*) FROM (SELECT DISTINCT session_id, user_id FROM good)) AS sessions,
             (SELECT count(DISTINCT timestamp::DATE) FROM good) AS dates,
             (SELECT count(*) FROM (SELECT DISTINCT product_id, category FROM good
                                    WHERE product_id IS NOT NULL AND category IS NOT NULL)) AS products,
             (SELECT count(*) FROM issues_good) AS issues)""")
SUB["fdm_good"] = _daily("good")
SUB["fdm_mixed"] = _daily("good_mixed")
ORACLE["batch_job_daily_metrics"] = _out("fdm_good", *_DAILY_FORMS)
ORACLE["batch_job_resumed"] = ORACLE["batch_job_daily_metrics"]
ORACLE["batch_job_mixed_files"] = _out("fdm_mixed", *_DAILY_FORMS)
ORACLE["catalog_round_trip"] = ORACLE["export_products"] = ORACLE["stg_products"]
ORACLE["export_users"] = ORACLE["stg_users"]
