"""M2 -- unified touchpoints with resolved identity.

Web and pixel touches resolve through the surviving profile of *their own*
source system with the same source id (one profile per source id: the smallest
profile id, a deterministic stand-in for an unordered ``LIMIT 1``); calls and
inbound mails resolve through every surviving profile with the same normalised
phone / lower-cased sender (fan-out kept). Each lookup is one left join, and the
resolved profile's ``customer_type`` / ``source_system`` ride along so journeys
need no second profile join.

Kept on purpose (parity): survivorship means a known customer's web touches
resolve only when the surviving row came from the web feed, and mail senders
are looked up lower-cased but untrimmed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchcredit.functions.normalize import (concat_skip_nulls, email_lower, lower_trim,
                                             phone_digits, typed_null)
from touchcredit.operators.chunks import Keep
from touchcredit.operators.joins import Heavy, Lookup, left_lookup, measure_heavy
from touchcredit.operators.topk import top1
from touchcredit.plans import constants as K
from touchcredit.sources.readers import RawSources

def _resolved() -> list:
    """Resolved identity columns, in touch-contract order, plus the profile attributes."""
    return [
        F.col("known_customer_id").alias("resolved_known_customer_id"),
        F.col("customer_profile_id").alias("resolved_customer_profile_id"),
        "match_method", "customer_type",
        F.col("source_system").alias("profile_source_system"),
    ]


_LOOKUP_COLS = ["known_customer_id", "customer_profile_id", "match_method", "customer_type",
                "source_system"]


def source_id_lookup(profiles: DataFrame, system: str) -> DataFrame:
    """One surviving profile per ``source_id`` of ``system`` (smallest profile id)."""
    own = profiles.where((F.col("source_system") == system) & F.col("source_id").isNotNull())
    return top1(own, ["source_id"], [F.col("customer_profile_id")], _LOOKUP_COLS)


def _touch_select(platform_id: Column, channel: Column, campaign: str, ts: str, raw_source: str,
                  raw_identifier: Column) -> list:
    resolved = _resolved()
    return [platform_id.alias("platform_id"), *resolved[:3], channel.alias("channel"),
            F.col(campaign).alias("campaign"), F.col(ts).alias("event_timestamp"),
            F.lit(raw_source).alias("raw_source"), raw_identifier.alias("raw_identifier"),
            *resolved[3:]]


def _ga4_key() -> Column:
    return lower_trim(F.col("ga_user_id").cast("string"))


def _pixel_key() -> Column:
    return lower_trim(F.col("fb_external_id").cast("string"))


def ga4_touches(ga4_events: DataFrame, profiles: DataFrame, lookup: DataFrame | None = None, heavy: Heavy | None = None) -> DataFrame:
    """``lookup``: the written table of ``source_id_lookup``, if there is one; ``heavy``: measured heavy visitors."""
    lookup = source_id_lookup(profiles, K.SYS_GA4) if lookup is None else lookup
    joined = left_lookup(ga4_events, lookup, _ga4_key(), "source_id", ["event_id"], heavy)
    return joined.select(*_touch_select(
        concat_skip_nulls(F.lit(K.PREFIX_GA4), F.col("event_id").cast("string")),
        F.col("traffic_source"), "campaign_name", "event_timestamp", K.SYS_GA4,
        F.col("ga_user_id")))


def meta_pixel_touches(pixel_events: DataFrame, profiles: DataFrame, lookup: DataFrame | None = None, heavy: Heavy | None = None) -> DataFrame:
    """``lookup``, ``heavy``: as for ``ga4_touches``."""
    lookup = source_id_lookup(profiles, K.SYS_META_PIXEL) if lookup is None else lookup
    joined = left_lookup(pixel_events, lookup, _pixel_key(), "source_id", ["pixel_event_id"], heavy)
    return joined.select(*_touch_select(
        concat_skip_nulls(F.lit(K.PREFIX_META_PIXEL), F.col("pixel_event_id").cast("string")),
        F.lit(K.CHANNEL_PAID_SOCIAL), "campaign_name", "event_time", K.SYS_META_PIXEL,
        typed_null("string")))


def _contact_lookup(profiles: DataFrame, key_col: str) -> DataFrame:
    return profiles.where(F.col(key_col).isNotNull()).select(key_col, *_LOOKUP_COLS)


def call_touches(calls: DataFrame, profiles: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    joined = left_lookup(calls, _contact_lookup(profiles, "normalized_phone"),
                         phone_digits("caller_phone_number"), "normalized_phone", ["call_id"], heavy)
    return joined.select(*_touch_select(
        concat_skip_nulls(F.lit(K.PREFIX_CALLS), F.col("call_id").cast("string")),
        F.lit(K.CHANNEL_PHONE), "source_campaign", "call_datetime", K.SYS_CALLS,
        F.col("caller_phone_number")))


def helpdesk_touches(emails: DataFrame, profiles: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    joined = left_lookup(emails, _contact_lookup(profiles, "normalized_email"),
                         email_lower("from_email"), "normalized_email", ["ticket_id"], heavy)
    return joined.select(*_touch_select(
        concat_skip_nulls(F.lit(K.PREFIX_HELPDESK), F.col("ticket_id").cast("string")),
        F.lit(K.CHANNEL_EMAIL_INBOUND), "subject_category", "received_at", K.SYS_HELPDESK,
        email_lower("from_email")))


def heavy_contacts(src: RawSources, profiles: DataFrame, ga4_lookup: DataFrame, pixel_lookup: DataFrame, keep: Keep | None,
                   limit: int | None = None) -> dict[str, Heavy]:
    """The heavy keys of the four feeds' lookups, from one count over all of them."""
    return measure_heavy({
        "ga4": Lookup(src.ga4_events, _ga4_key(), [(ga4_lookup, "source_id")]),
        "pixel": Lookup(src.meta_pixel_events, _pixel_key(), [(pixel_lookup, "source_id")]),
        "calls": Lookup(src.calls, phone_digits("caller_phone_number"), [(profiles, "normalized_phone")]),
        "helpdesk": Lookup(src.helpdesk_emails, email_lower("from_email"), [(profiles, "normalized_email")]),
    }, keep, limit)


def enriched_touchpoints(src: RawSources, profiles: DataFrame, ga4_lookup: DataFrame | None = None,
                         pixel_lookup: DataFrame | None = None, keep: Keep | None = None, heavy_rows: int | None = None) -> DataFrame:
    """All touches with ``TOUCH_COLUMNS`` plus ``customer_type, profile_source_system``.

    ``keep`` writes the table of heavy keys (more than ``heavy_rows`` rows); without it they are not measured."""
    heavy = {} if ga4_lookup is None else heavy_contacts(src, profiles, ga4_lookup, pixel_lookup, keep, heavy_rows)
    parts = [
        ga4_touches(src.ga4_events, profiles, ga4_lookup, heavy.get("ga4")),
        meta_pixel_touches(src.meta_pixel_events, profiles, pixel_lookup, heavy.get("pixel")),
        call_touches(src.calls, profiles, heavy.get("calls")),
        helpdesk_touches(src.helpdesk_emails, profiles, heavy.get("helpdesk")),
    ]
    return reduce(DataFrame.unionByName, parts)


def public_touchpoints(enriched: DataFrame) -> DataFrame:
    return enriched.select(*K.TOUCH_COLUMNS)


def build_touchpoints(src: RawSources, profiles: DataFrame) -> DataFrame:
    return public_touchpoints(enriched_touchpoints(src, profiles))
