"""Derive the eight logical marketing sources from the driver's test tables.

The test parquet has no marketing tables, so each source is a projection of
``customer`` or ``events`` (FIXTURES.md §3): clicks become web touches, views
pixel touches, signups calls, errors helpdesk mails and purchases orders.
Costs are counts times a fixed unit price, so they are exact. Every derivation
is a narrow projection or a per-day aggregate, so it scales with the input;
each is one SQL projection (filters reach the parquet scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchcredit.sources.readers import RawSources, conform
from touchcredit.sources.schemas import SOURCE_SCHEMAS

# Fixed values of the fixture contract (they must equal the oracle's derivation):
# every customer and every event is kept. Users with id % 10 = 3 are visitors
# whose ids, phones and mails no customer has, and their purchases belong to
# customers nobody knows; purchases of users with id % 10 = 5 are guest orders
# without a customer. One customer in forty shares
# the phone of the customer before. MACHINERY/BUILDING segments are b2b, a click
# costs 4,510,000 micros, a view 3.75 in spend, 220 impressions and 3 clicks.
_USER = "concat(CASE WHEN user_id % 10 = 3 THEN 'visitor_' ELSE 'user_' END, CAST(user_id AS STRING))"
_PHONE_OF = "(CASE WHEN c_custkey % 40 = 7 THEN c_custkey - 1 ELSE c_custkey END)"
_CUSTOMERS = [
    "concat('user_', CAST(c_custkey AS STRING)) AS customer_id",
    "CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'b2b' ELSE 'b2c' END AS customer_type",
    "date_add(DATE '2024-01-01', CAST(c_custkey % 9 AS INT)) AS first_seen_date",
    f"concat('+1-555-', CAST(100 + {_PHONE_OF} % 800 AS STRING), '-', "
    f"CAST(1000 + ({_PHONE_OF} * 7) % 9000 AS STRING)) AS phone_number",
    "concat('Customer', CAST(c_custkey AS STRING), '@Example.com') AS email",
]
_GA4 = [
    "event_id",
    f"{_USER} AS ga_user_id",
    "CASE event_id % 3 WHEN 0 THEN 'paid_search' WHEN 1 THEN 'email' ELSE 'organic' END AS traffic_source",
    "concat('campaign_', CAST(event_id % 3 AS STRING)) AS campaign_name",
    "ts AS event_timestamp",
]
_PIXEL = [
    "event_id AS pixel_event_id",
    f"{_USER} AS fb_external_id",
    "concat('social_', CAST(event_id % 3 AS STRING)) AS campaign_name",
    "ts AS event_time",
]
_CALLS = [
    "event_id AS call_id",
    "'+1-800-555-0199' AS tracking_phone_number",
    "concat('1 (', CASE WHEN user_id % 10 = 3 THEN '556' ELSE '555' END, ') ', CAST(100 + user_id % 800 AS STRING), ' ', "
    "CAST(1000 + (user_id * 7) % 9000 AS STRING)) AS caller_phone_number",
    "ts AS call_datetime",
    "CAST(30 + event_id % 571 AS INT) AS duration_seconds",
    "'inbound' AS direction",
    "concat('line_', CAST(event_id % 3 AS STRING)) AS source_campaign",
]
_HELPDESK = [
    "event_id AS ticket_id",
    "concat(CASE WHEN user_id % 10 = 3 THEN 'VISITOR' ELSE 'CUSTOMER' END, CAST(user_id AS STRING), '@example.com', "
    "CASE WHEN event_id % 50 = 0 THEN ' ' ELSE '' END) AS from_email",
    "ts AS received_at",
    "concat('topic_', CAST(event_id % 3 AS STRING)) AS subject_category",
]
_ORDERS = [
    "event_id AS order_id",
    "CASE WHEN user_id % 10 = 5 THEN NULL WHEN user_id % 10 = 3 THEN concat('stranger_', CAST(user_id AS STRING)) "
    "ELSE concat('user_', CAST(user_id AS STRING)) END AS customer_id",
    "ts AS created_at",
    "value AS total_price",
]


def customers_from(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(*_CUSTOMERS)


def _events_of(events: DataFrame, event_type: str) -> DataFrame:
    return events.where(f"event_type = '{event_type}'")


def ga4_from(events: DataFrame) -> DataFrame:
    return _events_of(events, "click").selectExpr(*_GA4)


def meta_pixel_from(events: DataFrame) -> DataFrame:
    return _events_of(events, "view").selectExpr(*_PIXEL)


def calls_from(events: DataFrame) -> DataFrame:
    return _events_of(events, "signup").selectExpr(*_CALLS)


def helpdesk_from(events: DataFrame) -> DataFrame:
    return _events_of(events, "error").selectExpr(*_HELPDESK)


def orders_from(events: DataFrame) -> DataFrame:
    return _events_of(events, "purchase").selectExpr(*_ORDERS)


def google_costs_from(events: DataFrame) -> DataFrame:
    return (_events_of(events, "click").selectExpr("CAST(ts AS DATE) AS date")
            .groupBy("date").count()
            .selectExpr("date", "'paid_search' AS channel_name",
                        "CAST(count * 4510000 AS BIGINT) AS cost_micros_equivalent"))


def meta_costs_from(events: DataFrame) -> DataFrame:
    return (_events_of(events, "view").selectExpr("CAST(ts AS DATE) AS date_start")
            .groupBy("date_start").count()
            .selectExpr("date_start", "'social_all' AS campaign_group",
                        "CAST(count * 3.75 AS DOUBLE) AS spend",
                        "CAST(count * 220 AS BIGINT) AS impressions",
                        "CAST(count * 3 AS BIGINT) AS clicks"))


def derive_sources(customer: DataFrame, events: DataFrame) -> RawSources:
    built = {
        "customers": customers_from(customer),
        "orders": orders_from(events),
        "ga4_events": ga4_from(events),
        "meta_pixel_events": meta_pixel_from(events),
        "calls": calls_from(events),
        "helpdesk_emails": helpdesk_from(events),
        "google_costs": google_costs_from(events),
        "meta_costs": meta_costs_from(events),
    }
    return RawSources(**{n: conform(df, SOURCE_SCHEMAS[n]) for n, df in built.items()})


def load_fixture_sources(spark: SparkSession, sf_dir: str) -> RawSources:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return derive_sources(customer, events)
