"""M5 -- customer journeys: touches stitched to the orders they precede.

Converting journeys: a touch of a known customer belongs to that customer's
first order at or after it (by ``(conversion_timestamp, order_id)``), i.e. to
the order whose interval ``(previous order, this order]`` contains it. This is
a forward as-of join (``operators.asof``), which never materialises the
order x touch pairs of a customer. Touches after a customer's last order, and
orders without touches, produce no journey rows.

Non-converting journeys: touches whose profile never converted (SQL ``NOT IN``
semantics, so NULL profiles appear only when nothing converted), one journey
per profile, ``journey_end_date`` = the touch's own time (as in the reference,
whose ``max`` is grouped by the timestamp itself), duplicates removed.

Profiles that share a phone or a mail share its touches, so the rows of these
journeys grow with touches x profiles. They are therefore built, deduplicated and
numbered once per class of profiles with exactly the same contacts, and copied to
the profiles of a class at the very end (``journey_members``, ``of_each_profile``).
For the same reason converting journeys start from the touches of customers who
have ordered at all.

Positions (sequence, previous/next touch, journey size) come from
``operators.positions``; a journey is never collected into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit.functions.normalize import concat_skip_nulls, day_diff, email_lower, phone_digits, second_diff, typed_null
from touchcredit.operators.asof import DAY_SECONDS, asof_forward
from touchcredit.operators.chunks import Keep
from touchcredit.operators.joins import Lookup, left_lookup, measure_heavy, not_in
from touchcredit.operators.positions import ordered_positions
from touchcredit.plans import constants as K
from touchcredit.sources.readers import RawSources


def _touch_part() -> list:
    """Touch columns as they appear in journey rows."""
    return [
        "platform_id", "resolved_known_customer_id", "resolved_customer_profile_id",
        F.col("match_method").alias("touchpoint_match_method"), "customer_type",
        "profile_source_system", "channel", "campaign", "event_timestamp", "raw_source",
        "raw_identifier",
    ]


def order_intervals(conversions: DataFrame, chunk_seconds: int = DAY_SECONDS, keep: Keep | None = None) -> DataFrame:
    """Conversions with ``previous_order_timestamp`` (the customer's preceding order)."""
    return ordered_positions(
        conversions, "user_id", "conversion_timestamp", "order_id",
        position="__seq", prev_ts="previous_order_timestamp", next_ts="__next",
        group_size="__size", chunk_seconds=chunk_seconds, keep=keep, name="order_ranges").drop("__seq", "__next", "__size")


def converting_journeys(touches: DataFrame, conversions: DataFrame,
                        chunk_seconds: int = DAY_SECONDS, keep: Keep | None = None) -> DataFrame:
    """``touches`` are enriched touchpoints (``constants.ENRICHED_TOUCH_COLUMNS``)."""
    orders = conversions.select(
        F.col("user_id").alias("__user"), F.col("conversion_timestamp").alias("__end"),
        F.col("order_id").alias("__oid"), F.col("revenue").alias("__rev"),
        F.col("is_repeat_purchase").alias("__rep"))
    matched = asof_forward(touches, orders, "resolved_known_customer_id", "event_timestamp",
                           "__user", "__end", "__oid", ["__user", "__end", "__oid", "__rev", "__rep"],
                           chunk_seconds=chunk_seconds, keep=keep)
    return matched.select(
        F.col("__oid").alias("journey_id"), F.col("__user").alias("shopify_customer_id"),
        F.col("__end").alias("journey_end_date"), *_touch_part(),
        F.lit(1).alias("converted"), F.col("__rev").alias("order_value"),
        F.col("__rep").alias("is_repeat_purchase"))


def attribution_rows(touches: DataFrame, conversions: DataFrame,
                     chunk_seconds: int = DAY_SECONDS, keep: Keep | None = None) -> DataFrame:
    """Converting touch rows with only the columns the marts read.

    Same matching as ``converting_journeys``, but the touches are projected
    first: the as-of join carries its left rows through a shuffle and a window,
    where Catalyst cannot prune unused fields, so a narrow input halves the
    bytes moved when only attribution is wanted.
    """
    narrow = touches.select("platform_id", "resolved_known_customer_id", "channel",
                            "event_timestamp")
    orders = conversions.select(
        F.col("user_id").alias("__user"), F.col("conversion_timestamp").alias("__end"),
        F.col("order_id").alias("__oid"), F.col("revenue").alias("__rev"))
    matched = asof_forward(narrow, orders, "resolved_known_customer_id", "event_timestamp",
                           "__user", "__end", "__oid", ["__end", "__oid", "__rev"],
                           chunk_seconds=chunk_seconds, keep=keep, name="attribution_ranges")
    return matched.select(
        F.col("__oid").alias("journey_id"), "channel", "event_timestamp", "platform_id",
        F.col("__rev").alias("order_value"), F.col("__end").alias("journey_end_date"))


def converted_profiles(converting: DataFrame) -> DataFrame:
    return converting.select("resolved_customer_profile_id").distinct()


def non_converting_journeys(touches: DataFrame, converting: DataFrame,
                            converted: DataFrame | None = None) -> DataFrame:
    """``converted``: the written table of ``converted_profiles(converting)``, if there is one."""
    rest = not_in(touches, "resolved_customer_profile_id", converting,
                  "resolved_customer_profile_id", salt=["platform_id"], distinct_keys=converted)
    return non_converting_rows(rest)


def non_converting_rows(touches: DataFrame) -> DataFrame:
    """One journey per profile from touches of profiles (or classes of profiles) without a conversion."""
    rest = touches.select(*_touch_part()).dropDuplicates()
    return rest.select(
        concat_skip_nulls(F.col("resolved_customer_profile_id"),
                          F.lit(K.NO_CONVERSION_SUFFIX)).alias("journey_id"),
        typed_null("string").alias("shopify_customer_id"),
        F.col("event_timestamp").alias("journey_end_date"),
        *K.JOURNEY_BASE_COLUMNS[3:14],
        F.lit(0).alias("converted"), typed_null("decimal(12,2)").alias("order_value"),
        typed_null("boolean").alias("is_repeat_purchase"))


def having_ordered(profiles: DataFrame, src: RawSources) -> DataFrame:
    """Rows (profiles, or lookups of them) of customers with an order."""
    buyers = src.orders.select(F.col("customer_id").cast("string").alias("__buyer")).where(F.col("__buyer").isNotNull()).distinct()
    return profiles.join(buyers, F.col("known_customer_id") == F.col("__buyer"), "left_semi")


_MEMBER_COLUMNS = {"resolved_known_customer_id": "known_customer_id", "resolved_customer_profile_id": "customer_profile_id",
                   "touchpoint_match_method": "match_method", "customer_type": "customer_type", "profile_source_system": "source_system"}


def journey_members(src: RawSources, profiles: DataFrame, converting: DataFrame, converted: DataFrame | None = None,
                    keep: Keep | None = None, heavy_rows: int | None = None) -> DataFrame:
    """Profiles without a conversion and their class: the phone and the mail they are reached by, as far as a call
    or mail has it. A profile that comes from a visitor is a class of its own."""
    rest = not_in(profiles, "customer_profile_id", converting, "resolved_customer_profile_id",
                  salt=["customer_profile_id"], distinct_keys=converted)
    phones = src.calls.select(phone_digits("caller_phone_number").alias("key")).where("key IS NOT NULL").distinct()
    mails = src.helpdesk_emails.select(email_lower("from_email").alias("key")).where("key IS NOT NULL").distinct()
    for feed, keys, column in (("phones", phones, "normalized_phone"), ("mails", mails, "normalized_email")):
        heavy = measure_heavy({feed: Lookup(profiles, F.col(column), [(keys, "key")])}, keep, heavy_rows)
        rest = left_lookup(rest, keys.withColumn(f"__{feed}", F.lit(True)), F.col(column), "key", ["customer_profile_id"], heavy.get(feed))
    contacts = [F.when(F.col("__phones"), F.col("normalized_phone")).alias("phone"),
                F.when(F.col("__mails"), F.col("normalized_email")).alias("mail"),
                F.when(F.col("source_system").isin(K.SYS_GA4, K.SYS_META_PIXEL), F.col("customer_profile_id")).alias("own")]
    return (rest.select(*_MEMBER_COLUMNS.values(), *contacts).where("phone IS NOT NULL OR mail IS NOT NULL OR own IS NOT NULL")
            .withColumn("class", F.to_json(F.struct("phone", "mail", "own"))))


def class_profiles(members: DataFrame) -> DataFrame:
    """One stand-in profile per class of ``members``; its profile id is the class."""
    return (members.where("phone IS NOT NULL OR mail IS NOT NULL").select("class", "phone", "mail").distinct()
            .select(F.col("class").alias("customer_profile_id"), F.col("phone").alias("normalized_phone"),
                    F.col("mail").alias("normalized_email"), *_no_profile("known_customer_id", "match_method", "customer_type", "source_system")))


def class_lookup(lookup: DataFrame, members: DataFrame) -> DataFrame:
    """A feed's lookup by source id, with classes for profiles; profiles that are no member are left out."""
    own = members.where("own IS NOT NULL").select("customer_profile_id", "class")
    return lookup.select("source_id", "customer_profile_id").join(own, "customer_profile_id").select(
        "source_id", F.col("class").alias("customer_profile_id"), *_no_profile("known_customer_id", "match_method", "customer_type", "source_system"))


def _no_profile(*names: str) -> list:
    return [typed_null("string").alias(n) for n in names]


def of_each_profile(rows: DataFrame, members: DataFrame, keep: Keep | None = None, heavy_rows: int | None = None) -> DataFrame:
    """Journey rows of classes as journey rows of each of their profiles."""
    who = members.select("class", *[F.col(c).alias(f"__{c}") for c in _MEMBER_COLUMNS.values()])
    key = F.col("resolved_customer_profile_id")
    heavy = measure_heavy({"members": Lookup(rows, key, [(who, "class")])}, keep, heavy_rows)
    joined = left_lookup(rows, who, key, "class", ["platform_id", "event_timestamp"], heavy.get("members"))
    of = {c: F.col(f"__{p}") for c, p in _MEMBER_COLUMNS.items()}
    of["journey_id"] = concat_skip_nulls("__customer_profile_id", F.lit(K.NO_CONVERSION_SUFFIX))
    return (joined.where(F.col("__customer_profile_id").isNotNull())
            .select(*[of.get(c, F.col(c)).alias(c) for c in rows.columns]))


def with_positions(journey_rows: DataFrame, chunk_seconds: int = DAY_SECONDS, keep: Keep | None = None,
                   name: str = "journey_ranges") -> DataFrame:
    pos = ordered_positions(
        journey_rows, "journey_id", "event_timestamp", "platform_id",
        position="touchpoint_sequence", prev_ts="previous_touch_timestamp",
        next_ts="next_touch_timestamp", group_size="total_touches_in_journey",
        chunk_seconds=chunk_seconds, keep=keep, name=name)
    seq, total = F.col("touchpoint_sequence"), F.col("total_touches_in_journey")
    return (pos.withColumn("days_to_conversion", day_diff("event_timestamp", "journey_end_date"))
               .withColumn("seconds_since_previous_touch",
                           second_diff("previous_touch_timestamp", "event_timestamp"))
               .withColumn("is_first_touch", F.coalesce(seq == 1, F.lit(False)))
               .withColumn("is_last_touch", F.coalesce(seq == total, F.lit(False)))
               .withColumn("is_single_touch_journey", F.coalesce(total == 1, F.lit(False)))
               .select(*K.JOURNEY_COLUMNS))

