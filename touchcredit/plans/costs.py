"""M4 -- daily ad spend from the Google and Meta cost feeds (narrow projections)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit.functions.normalize import money, typed_null
from touchcredit.plans import constants as K
from touchcredit.sources.readers import RawSources


def google_costs(google: DataFrame) -> DataFrame:
    """Micros to currency, divided as a double. The amount is held exactly at any size
    (decimal(12,2) would fail a day of 10,000 currency and more); every value that
    fits there gives the same result."""
    cost = money("cost_micros_equivalent", "decimal(38,2)").cast("double") / F.lit(float(K.MICROS_PER_UNIT))
    return google.select(
        F.col("date").alias("cost_date"), F.col("channel_name").alias("channel"),
        typed_null("string").alias("campaign"), cost.alias("cost"),
        typed_null("bigint").alias("impressions"), typed_null("bigint").alias("clicks"),
        F.lit(K.SYS_GOOGLE_COSTS).alias("raw_source"))


def meta_costs(meta: DataFrame) -> DataFrame:
    return meta.select(
        F.col("date_start").alias("cost_date"), F.lit(K.CHANNEL_PAID_SOCIAL).alias("channel"),
        F.col("campaign_group").alias("campaign"),
        money("spend").cast("double").alias("cost"),
        F.col("impressions").cast("bigint").alias("impressions"),
        F.col("clicks").cast("bigint").alias("clicks"),
        F.lit(K.SYS_META_COSTS).alias("raw_source"))


def build_costs(src: RawSources) -> DataFrame:
    return google_costs(src.google_costs).unionByName(meta_costs(src.meta_costs))
