"""M1 -- customer identity unification.

Five identity sets (known customers, web visitors, pixel visitors, callers,
mail senders) are unioned; each profile keeps one surviving row, preferring a
known customer, then the earliest ``source_timestamp`` (ties: source system,
source id).

Scale notes. Event feeds are reduced to one row per identifier (partial
aggregation, so a hot identifier costs one row per map task) *before* they meet
the customer table; the reference joins first and groups after, which is the
same result because the customer match depends only on the identifier. The
survivor is a ``min(struct)`` aggregate, not a whole-group window.

Kept on purpose (parity): web/pixel identities keep the raw visitor id as
``known_customer_id`` and profile id even when no customer matches; use
``is_known_customer`` as the reliable flag.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchcredit.functions.normalize import (concat_skip_nulls, email_key, lower_trim,
                                             phone_digits, typed_null)
from touchcredit.operators.topk import top1
from touchcredit.plans import constants as K
from touchcredit.sources.readers import RawSources


def _flags(hit: Column, method: str) -> list[Column]:
    m = F.when(hit, F.lit(method)).otherwise(F.lit(K.MATCH_UNKNOWN))
    return [m.alias("match_method"), hit.alias("is_known_customer"), m.alias("merge_reason")]


def _with_profile_key(df: DataFrame) -> DataFrame:
    """Profile id: the customer id, else ``'<source_system>|<source_id>'``."""
    pid = F.coalesce(F.col("customer_id"),
                     concat_skip_nulls(F.col("source_system"), F.lit("|"), F.col("source_id")))
    return df.select(pid.alias("customer_profile_id"),
                     F.col("customer_id").alias("known_customer_id"), *K.PROFILE_COLUMNS[2:])


def known_identities(customers: DataFrame) -> DataFrame:
    rows = customers.select(
        "customer_id",
        email_key("email").alias("normalized_email"),
        phone_digits("phone_number").alias("normalized_phone"),
        "customer_type",
        F.col("first_seen_date").cast("timestamp_ntz").alias("source_timestamp"),
        F.lit(K.SYS_CUSTOMERS).alias("source_system"),
        F.col("customer_id").cast("string").alias("source_id"),
        F.lit(K.MATCH_CUSTOMER_TABLE).alias("match_method"),
        F.lit(True).alias("is_known_customer"),
        F.lit(K.MERGE_KNOWN).alias("merge_reason"))
    return _with_profile_key(rows)


def known_customer_ids(customers: DataFrame) -> DataFrame:
    """Distinct non-NULL customer ids, flagged; shared by the web and pixel branches."""
    return (customers.where(F.col("customer_id").isNotNull())
            .select(F.col("customer_id").alias("__vid")).distinct()
            .withColumn("__hit", F.lit(True)))


def _visitor_identities(customers: DataFrame, events: DataFrame, id_col: str, ts_col: str,
                        system: str, known: DataFrame | None = None) -> DataFrame:
    """Visitors keyed by a platform id that is compared to ``customer_id`` verbatim."""
    first_seen = events.groupBy(F.col(id_col).alias("__vid")).agg(
        F.min(ts_col).alias("source_timestamp"))
    if known is None:
        known = known_customer_ids(customers)
    hit = F.col("__hit").isNotNull()
    rows = first_seen.join(known, "__vid", "left").select(
        F.col("__vid").alias("customer_id"),
        typed_null("string").alias("normalized_email"),
        typed_null("string").alias("normalized_phone"),
        typed_null("string").alias("customer_type"),
        "source_timestamp",
        F.lit(system).alias("source_system"),
        lower_trim("__vid").alias("source_id"),
        *_flags(hit, K.MATCH_CUSTOMER_ID))
    return _with_profile_key(rows)


def ga4_identities(customers: DataFrame, ga4_events: DataFrame,
                   known: DataFrame | None = None) -> DataFrame:
    return _visitor_identities(customers, ga4_events, "ga_user_id", "event_timestamp", K.SYS_GA4,
                               known)


def meta_pixel_identities(customers: DataFrame, pixel_events: DataFrame,
                          known: DataFrame | None = None) -> DataFrame:
    return _visitor_identities(customers, pixel_events, "fb_external_id", "event_time",
                               K.SYS_META_PIXEL, known)


def _contact_identities(customers: DataFrame, feed: DataFrame, feed_key: Column, ts_col: str,
                        customer_key: Column, system: str, method: str, key_is_email: bool) -> DataFrame:
    """Contacts (phone / mail) matched to every customer sharing the normalised key."""
    first_seen = feed.groupBy(feed_key.alias("__key")).agg(F.min(ts_col).alias("source_timestamp"))
    owners = (customers.select(F.col("customer_id").alias("__cid"), customer_key.alias("__key"))
              .where(F.col("__key").isNotNull()).distinct())
    hit = F.col("__cid").isNotNull()
    key = F.col("__key")
    rows = first_seen.join(owners, "__key", "left").select(
        F.col("__cid").alias("customer_id"),
        (key if key_is_email else typed_null("string")).alias("normalized_email"),
        (typed_null("string") if key_is_email else key).alias("normalized_phone"),
        typed_null("string").alias("customer_type"),
        "source_timestamp",
        F.lit(system).alias("source_system"),
        key.alias("source_id"),
        *_flags(hit, method))
    return _with_profile_key(rows)


def call_identities(customers: DataFrame, calls: DataFrame) -> DataFrame:
    return _contact_identities(customers, calls, phone_digits("caller_phone_number"), "call_datetime",
                               phone_digits("phone_number"), K.SYS_CALLS, K.MATCH_PHONE, False)


def helpdesk_identities(customers: DataFrame, emails: DataFrame) -> DataFrame:
    return _contact_identities(customers, emails, email_key("from_email"), "received_at",
                               email_key("email"), K.SYS_HELPDESK, K.MATCH_EMAIL, True)


def identity_candidates(src: RawSources) -> DataFrame:
    known = known_customer_ids(src.customers)   # one plan, so its shuffle is reused
    parts = [
        known_identities(src.customers),
        ga4_identities(src.customers, src.ga4_events, known),
        meta_pixel_identities(src.customers, src.meta_pixel_events, known),
        call_identities(src.customers, src.calls),
        helpdesk_identities(src.customers, src.helpdesk_emails),
    ]
    return reduce(DataFrame.unionByName, parts)


def survivors(candidates: DataFrame) -> DataFrame:
    """One row per profile: known first, then earliest, then source system / id."""
    order = [~F.col("is_known_customer"), F.col("source_timestamp"), F.col("source_system"),
             F.col("source_id")]
    picked = top1(candidates, ["customer_profile_id"], order, K.PROFILE_COLUMNS[1:])
    return picked.select(*K.PROFILE_COLUMNS)


def unify_identities(src: RawSources) -> DataFrame:
    return survivors(identity_candidates(src))
