"""Fixed values of the attribution data contract.

These literals appear in model outputs and must equal the reference project's
values for results to match, so they are stated here once, in natural order.
"""

# Raw source-system labels.
SYS_CUSTOMERS = "raw_shopify.customers"
SYS_GA4 = "raw_ga4.ga4events"
SYS_META_PIXEL = "raw_meta_pixel.meta_pixel_events"
SYS_CALLS = "raw_callrail.calls"
SYS_HELPDESK = "raw_helpdesk.inbound_helpdesk_emails"
SYS_ORDERS = "raw_shopify.shopify_orders"
SYS_GOOGLE_COSTS = "raw_google_ads.google_campaign_costs"
SYS_META_COSTS = "raw_meta_ads.meta_ad_insights"

# Identity match methods and merge reasons.
MATCH_CUSTOMER_TABLE = "customer_table"
MATCH_CUSTOMER_ID = "customer_id_match"
MATCH_PHONE = "phone_match"
MATCH_EMAIL = "email_match"
MATCH_UNKNOWN = "unknown"
MERGE_KNOWN = "known_customer"

# Platform id prefixes of the four touch feeds.
PREFIX_GA4 = "ga4|"
PREFIX_META_PIXEL = "meta_pixel|"
PREFIX_CALLS = "callrail|"
PREFIX_HELPDESK = "helpdesk|"

# Channels.
CHANNEL_PAID_SOCIAL = "paid_social"
CHANNEL_PHONE = "phone"
CHANNEL_EMAIL_INBOUND = "email_inbound"
CHANNELS = ["paid_search", "paid_social", "organic", "email", "phone", "email_inbound"]
COST_CHANNELS = ["paid_search", "paid_social"]
#: Channels of the cost feeds by the channel of the touches they pay for.
CHANNEL_OF_COST = {"paid_search": "paid_search", "paid_social": "paid_social"}
MATCH_METHODS = ["customer_id_match", "phone_match", "email_match", "unknown", "customer_table"]
CUSTOMER_TYPES = ["b2b", "b2c"]

# Journey id suffix of non-converting paths; attribution method tags.
NO_CONVERSION_SUFFIX = "_no_conversion"
METHOD_FIRST_TOUCH = "first_touch"
METHOD_LAST_TOUCH = "last_touch"
METHOD_LINEAR = "linear"
METHOD_TIME_DECAY = "time_decay"
DEFAULT_HALF_LIFE_DAYS = 7.0
MICROS_PER_UNIT = 1000000

# Output column contracts (exact order).
PROFILE_COLUMNS = [
    "customer_profile_id", "known_customer_id", "normalized_email", "normalized_phone",
    "customer_type", "source_system", "source_id", "source_timestamp", "match_method",
    "is_known_customer", "merge_reason",
]
TOUCH_COLUMNS = [
    "platform_id", "resolved_known_customer_id", "resolved_customer_profile_id", "match_method",
    "channel", "campaign", "event_timestamp", "raw_source", "raw_identifier",
]
# Touch columns plus the resolved profile's attributes, carried from the lookup.
ENRICHED_TOUCH_COLUMNS = TOUCH_COLUMNS + ["customer_type", "profile_source_system"]
CONVERSION_COLUMNS = [
    "order_id", "user_id", "conversion_timestamp", "revenue", "customer_email", "customer_phone",
    "customer_profile_id", "match_method", "raw_source", "is_repeat_purchase",
]
COST_COLUMNS = ["cost_date", "channel", "campaign", "cost", "impressions", "clicks", "raw_source"]
JOURNEY_BASE_COLUMNS = [
    "journey_id", "shopify_customer_id", "journey_end_date", "platform_id",
    "resolved_known_customer_id", "resolved_customer_profile_id", "touchpoint_match_method",
    "customer_type", "profile_source_system", "channel", "campaign", "event_timestamp",
    "raw_source", "raw_identifier", "converted", "order_value", "is_repeat_purchase",
]
JOURNEY_COLUMNS = JOURNEY_BASE_COLUMNS + [
    "touchpoint_sequence", "previous_touch_timestamp", "next_touch_timestamp",
    "days_to_conversion", "total_touches_in_journey", "seconds_since_previous_touch",
    "is_first_touch", "is_last_touch", "is_single_touch_journey",
]
MART_COLUMNS = ["channel", "attribution_method", "attributed_conversions", "attributed_revenue"]
