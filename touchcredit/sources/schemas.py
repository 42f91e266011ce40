"""Schemas of the eight raw marketing sources (the engine's input contract).

Timestamps are zone-less (``timestamp_ntz``) end to end: the feeds carry wall
clock times and converting them through a session zone would move values
inside DST gaps.
"""

from pyspark.sql import types as T

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_TS, _DATE = T.TimestampNTZType(), T.DateType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CUSTOMERS = _struct(("customer_id", _S), ("customer_type", _S), ("first_seen_date", _DATE),
                    ("phone_number", _S), ("email", _S))
ORDERS = _struct(("order_id", _L), ("customer_id", _S), ("created_at", _TS), ("total_price", _D))
GA4_EVENTS = _struct(("event_id", _L), ("ga_user_id", _S), ("traffic_source", _S),
                     ("campaign_name", _S), ("event_timestamp", _TS))
META_PIXEL_EVENTS = _struct(("pixel_event_id", _L), ("fb_external_id", _S), ("campaign_name", _S),
                            ("event_time", _TS))
CALLS = _struct(("call_id", _L), ("tracking_phone_number", _S), ("caller_phone_number", _S),
                ("call_datetime", _TS), ("duration_seconds", _I), ("direction", _S),
                ("source_campaign", _S))
HELPDESK_EMAILS = _struct(("ticket_id", _L), ("from_email", _S), ("received_at", _TS),
                          ("subject_category", _S))
GOOGLE_COSTS = _struct(("date", _DATE), ("channel_name", _S), ("cost_micros_equivalent", _L))
META_COSTS = _struct(("date_start", _DATE), ("campaign_group", _S), ("spend", _D),
                     ("impressions", _L), ("clicks", _L))

SOURCE_SCHEMAS = {
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "ga4_events": GA4_EVENTS,
    "meta_pixel_events": META_PIXEL_EVENTS,
    "calls": CALLS,
    "helpdesk_emails": HELPDESK_EMAILS,
    "google_costs": GOOGLE_COSTS,
    "meta_costs": META_COSTS,
}
