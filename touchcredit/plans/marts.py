"""M6-M9 -- channel attribution marts, and all four in one pass (summary).

Each mart accepts journey rows -- the full ``user_journeys`` table or just the
converting rows from ``journeys.converting_journeys`` -- and needs only
``journey_id, channel, event_timestamp, platform_id, order_value,
journey_end_date``. Positions are derived inside the mart by aggregation:

* first / last touch: the journey's ``min`` / ``max`` of
  ``(event_timestamp, platform_id)`` -- one partial+final aggregate;
* linear: touch counts per ``(journey, channel)``, then a per-journey total
  over at most one row per channel, then ``groupBy(channel)``;
* time decay: touch counts per ``(journey, channel, days)``, weighted relative
  to the journey's nearest touch: 0.5^((days - min days) / half life) gives the
  same shares as 0.5^(days / half life), but the nearest touch always weighs 1,
  so a journey of old touches cannot underflow to a zero total;
* all four (``all_marts``, ``summary``): one aggregate per ``(journey, channel, days)`` carries the touch
  count and the first and last touch, one per-journey step turns it into four
  credits, and one aggregate by channel adds them up: one scan, three exchanges.

No step ever needs all touches of one journey in one task. (A journey has at
most channels x distinct days such rows.)
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchcredit.functions.normalize import day_diff
from touchcredit.operators.topk import top1
from touchcredit.plans import constants as K


def _converting(journeys: DataFrame) -> DataFrame:
    return journeys.where(F.col("converted") == 1) if "converted" in journeys.columns else journeys


def _positional(journeys: DataFrame, method: str, last: bool) -> DataFrame:
    picked = top1(_converting(journeys), ["journey_id"],
                  [F.col("event_timestamp"), F.col("platform_id")], ["channel", "order_value"],
                  last=last)
    return picked.groupBy("channel").agg(
        F.lit(method).alias("attribution_method"),
        F.count("journey_id").alias("attributed_conversions"),
        F.sum("order_value").cast("decimal(38,2)").alias("attributed_revenue"))


def first_touch(journeys: DataFrame) -> DataFrame:
    return _positional(journeys, K.METHOD_FIRST_TOUCH, last=False)


def last_touch(journeys: DataFrame) -> DataFrame:
    return _positional(journeys, K.METHOD_LAST_TOUCH, last=True)


def _check_half_life(half_life_days: float) -> float:
    if not half_life_days > 0:
        raise ValueError(f"half_life_days must be positive, not {half_life_days}")
    return float(half_life_days)


def _fractional(journeys: DataFrame, method: str, keys: list, weight) -> DataFrame:
    """``weight``: a column over one row per ``keys`` with the touch count ``__n``."""
    per = _converting(journeys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.max("order_value").alias("__v"))
    per = per.withColumn("__w", F.col("__n") * weight)
    credit = F.col("__w") / F.sum("__w").over(Window.partitionBy("journey_id"))
    return (per.withColumn("__credit", credit)
               .groupBy("channel").agg(
                   F.lit(method).alias("attribution_method"),
                   F.sum("__credit").alias("attributed_conversions"),
                   F.sum(F.col("__v").cast("double") * F.col("__credit")).alias("attributed_revenue")))


def linear(journeys: DataFrame) -> DataFrame:
    """Each of a journey's n touches earns 1/n."""
    return _fractional(journeys, K.METHOD_LINEAR, ["journey_id", "channel"], F.lit(1.0))


def _days() -> Column:
    return day_diff("event_timestamp", "journey_end_date").alias("__days")


def _decay(half_life_days: float) -> Column:
    """Weight of a touch relative to its journey's nearest one; needs ``__days``."""
    nearest = F.min("__days").over(Window.partitionBy("journey_id"))
    return F.pow(F.lit(0.5), (F.col("__days") - nearest) / F.lit(_check_half_life(half_life_days)))


def time_decay(journeys: DataFrame, half_life_days: float = K.DEFAULT_HALF_LIFE_DAYS) -> DataFrame:
    """A touch d days before the order earns 0.5^(d / half_life), normalised per journey."""
    return _fractional(journeys, K.METHOD_TIME_DECAY, ["journey_id", "channel", _days()], _decay(half_life_days))


METHODS = [K.METHOD_FIRST_TOUCH, K.METHOD_LAST_TOUCH, K.METHOD_LINEAR, K.METHOD_TIME_DECAY]


def all_marts(journeys: DataFrame, half_life_days: float = K.DEFAULT_HALF_LIFE_DAYS) -> DataFrame:
    """One row per channel with the conversions and revenue of every method (``<method>_n``, ``<method>_v``),
    in the types of the single marts, from one pass over the converting rows."""
    touch = F.struct(F.col("event_timestamp").isNull().alias("n"), F.col("event_timestamp").alias("t"),
                     F.col("platform_id").isNull().alias("m"), F.col("platform_id").alias("p"),
                     F.col("channel").alias("c"))
    per = _converting(journeys).groupBy("journey_id", "channel", _days()).agg(
        F.count(F.lit(1)).alias("__n"), F.max("order_value").alias("__v"), F.min(touch).alias("__lo"), F.max(touch).alias("__hi"))
    journey = Window.partitionBy("journey_id")
    weight = F.col("__n") * _decay(half_life_days)
    per = per.withColumns({
        K.METHOD_FIRST_TOUCH: F.col("__lo").eqNullSafe(F.min("__lo").over(journey)),
        K.METHOD_LAST_TOUCH: F.col("__hi").eqNullSafe(F.max("__hi").over(journey)),
        K.METHOD_LINEAR: F.col("__n") / F.sum("__n").over(journey),
        K.METHOD_TIME_DECAY: weight / F.sum(weight).over(journey)})
    sums = []
    for m in METHODS:
        if m in (K.METHOD_FIRST_TOUCH, K.METHOD_LAST_TOUCH):
            sums += [F.count(F.when(F.col(m), F.col("journey_id"))).alias(f"{m}_n"),
                     F.sum(F.when(F.col(m), F.col("__v"))).cast("decimal(38,2)").alias(f"{m}_v"), F.count_if(F.col(m)).alias(f"{m}_rows")]
        else:
            sums += [F.sum(m).alias(f"{m}_n"), F.sum(F.col("__v").cast("double") * F.col(m)).alias(f"{m}_v"), F.count(F.lit(1)).alias(f"{m}_rows")]
    return per.groupBy("channel").agg(*sums)


def mart_of(marts: DataFrame, method: str) -> DataFrame:
    """One method's mart out of ``all_marts``: a channel appears under first / last touch only if it got such a touch."""
    return marts.where(F.col(f"{method}_rows") > 0).select(
        "channel", F.lit(method).alias("attribution_method"), F.col(f"{method}_n").alias("attributed_conversions"),
        F.col(f"{method}_v").alias("attributed_revenue"))


def summary(journeys: DataFrame, half_life_days: float = K.DEFAULT_HALF_LIFE_DAYS) -> DataFrame:
    """The four marts in one table from one pass; both measures as double."""
    rows = F.array(*[F.struct(F.lit(m).alias("attribution_method"), F.col(f"{m}_n").cast("double").alias("attributed_conversions"),
                              F.col(f"{m}_v").cast("double").alias("attributed_revenue"), (F.col(f"{m}_rows") > 0).alias("any"))
                     for m in METHODS])
    return (all_marts(journeys, half_life_days).select("channel", F.explode(rows).alias("r")).where("r.any")
            .select("channel", "r.attribution_method", "r.attributed_conversions", "r.attributed_revenue"))


def summary_with_costs(summary: DataFrame, costs: DataFrame, channel_of: Mapping[str, str] = K.CHANNEL_OF_COST) -> DataFrame:
    """The summary beside what its channels cost: cost, cost per conversion and return on spend.

    ``channel_of`` maps channels of the cost feeds to channels of the touches; others keep their name. Channels on
    one side only stay: without touches their method and measures are null, without spend their cost is. A ratio to
    nothing (no conversions, no cost) is null.
    """
    named = F.create_map(*[F.lit(x) for pair in channel_of.items() for x in pair]) if channel_of else F.create_map().cast("map<string,string>")
    spent = costs.groupBy(F.coalesce(F.try_element_at(named, F.col("channel")), F.col("channel")).alias("__channel")).agg(F.sum("cost").alias("cost"))
    both = summary.join(spent, F.col("channel").eqNullSafe(F.col("__channel")), "full_outer")
    per = lambda a, b: F.try_divide(F.col(a), F.nullif(F.col(b), F.lit(0.0)))
    return both.select(F.coalesce("channel", "__channel").alias("channel"), "attribution_method", "attributed_conversions", "attributed_revenue",
                       "cost", per("cost", "attributed_conversions").alias("cost_per_conversion"),
                       per("attributed_revenue", "cost").alias("return_on_spend"))
