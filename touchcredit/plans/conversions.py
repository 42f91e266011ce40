"""M3 -- orders as conversions, with the linked profile and a repeat flag.

Orders meet their profile and contact in two lookups on one shared key column.
``is_repeat_purchase`` numbers the joined rows of a customer by ``(created_at,
order_id)``, NULLs last, with ties broken by the customer's mail, phone and
profile: the first is false, all others true, so a second copy (a duplicate
customer or order) counts as a repeat. Orders without a customer id are one
group. The numbers come from ``operators.positions``, so a customer with a huge
history -- or all guest orders -- is never one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit.functions.normalize import money
from touchcredit.operators.asof import DAY_SECONDS
from touchcredit.operators.chunks import Keep
from touchcredit.operators.joins import Lookup, left_lookups, measure_heavy
from touchcredit.operators.positions import ordered_positions
from touchcredit.plans import constants as K
from touchcredit.sources.readers import RawSources


def joined_orders(src: RawSources, profiles: DataFrame, keep: Keep | None = None, heavy_rows: int | None = None) -> DataFrame:
    """Every order with its profile and contact; an order repeats with a customer's duplicates.

    ``keep`` writes the table of heavy customers, those with more than ``heavy_rows`` orders."""
    base = src.orders.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("user_id"),
        F.col("created_at").alias("conversion_timestamp"),
        money("total_price").alias("revenue"))
    known = profiles.where(F.col("known_customer_id").isNotNull()).select(
        "known_customer_id", "customer_profile_id", "match_method")
    contacts = src.customers.select("customer_id", F.col("email").alias("customer_email"),
                                    F.col("phone_number").alias("customer_phone"))
    tables = [(known, "known_customer_id"), (contacts, "customer_id")]
    heavy = measure_heavy({"orders": Lookup(base, F.col("user_id"), tables)}, keep, heavy_rows)
    return left_lookups(base, tables, F.col("user_id"), ["order_id"], heavy.get("orders"))


def build_conversions(src: RawSources, profiles: DataFrame, chunk_seconds: int = DAY_SECONDS, keep: Keep | None = None,
                      heavy_rows: int | None = None) -> DataFrame:
    """``keep``: writes the joined orders once, as the numbering reads them twice."""
    joined = joined_orders(src, profiles, keep, heavy_rows)
    if keep is not None:
        joined = keep(joined, "joined_orders")
    numbered = ordered_positions(
        joined, "user_id", "conversion_timestamp", ["order_id", "customer_email", "customer_phone", "customer_profile_id"],
        position="__seq", prev_ts="__prev", next_ts="__next", group_size="__size", chunk_seconds=chunk_seconds, keep=keep,
        name="conversion_ranges")
    return numbered.select(
        "order_id", "user_id", "conversion_timestamp", "revenue", "customer_email",
        "customer_phone", "customer_profile_id", "match_method",
        F.lit(K.SYS_ORDERS).alias("raw_source"), (F.col("__seq") > 1).alias("is_repeat_purchase"))
