"""Heavy keys and hot groups: measured, dealt over parts, and nothing else moved."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from touchcredit.functions.normalize import phone_digits
from touchcredit.operators import chunks
from touchcredit.operators.joins import Lookup, left_lookup, left_lookups, measure_heavy
from touchcredit.operators.positions import ordered_positions
from touchcredit.plans import conversions as conv
from touchcredit.plans import touchpoints as touch


@pytest.fixture
def keep(spark, tmp_path):
    written = {}

    def write(df, name):
        path = str(tmp_path / f"{name}-{len(written)}")
        df.write.parquet(path)
        written[name] = spark.read.schema(df.schema).parquet(path)
        return written[name]

    write.written = written
    return write


@pytest.fixture
def plain_joins(spark):
    """No broadcast, no skew splitting, no coalescing: only the operators' own dealing balances tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def largest_share(df) -> float:
    """Rows of the fullest task over all rows."""
    largest, total = df.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    return largest / total


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def calls_and_profiles(spark, n=6000):
    """A third of the calls from one number, a tenth without a digit; many profiles without a digit too."""
    rng = random.Random(2)
    calls = [(i, "555-0001" if i % 3 == 0 else rng.choice(["", "n/a", None]) if i % 10 == 1 else f"555-{1000 + i % 2500}") for i in range(n)]
    profiles = ([("5550001", "hot")] + [(f"555{1000 + i}", f"p{i}") for i in range(0, 2500, 2)] + [("", f"blank{i}") for i in range(300)]
                + [("5550001", "hot2"), (None, "nobody"), ("999", "never")])
    return (spark.createDataFrame(calls, "call_id long, caller string").repartition(6),
            spark.createDataFrame(profiles, "phone string, profile string").repartition(3))


def test_heavy_phone_and_empty_digits(spark, keep, plain_joins):
    calls, profiles = calls_and_profiles(spark)
    key = phone_digits("caller")
    heavy = measure_heavy({"calls": Lookup(calls, key, [(profiles, "phone")])}, keep, limit=100)["calls"]
    assert heavy.wide == (True,)
    parts = {r["__hk"]: (r["__l"], r["__r0"]) for r in heavy.keys.collect()}
    assert parts == {"5550001": (20, 1), "": (3, 3)}
    plain, dealt = left_lookup(calls, profiles, key, "phone", ["call_id"]), left_lookup(calls, profiles, key, "phone", ["call_id"], heavy)
    assert dealt.columns == plain.columns and bag(dealt) == bag(plain)
    assert largest_share(plain) > 0.8 and largest_share(dealt) < 0.3
    assert "Cartesian" not in dealt._jdf.queryExecution().executedPlan().toString()


def test_chain_shares_the_dealing(spark, keep, plain_joins):
    orders = spark.createDataFrame([(i, "c1" if i % 3 == 0 else None if i % 7 == 0 else f"c{i % 400}") for i in range(4000)],
                                   "order_id long, customer string")
    known = spark.createDataFrame([(f"c{i}", i) for i in range(0, 400, 3)] + [("c1", 1)], "known string, profile long")
    mails = spark.createDataFrame([(f"c{i}", f"m{i}") for i in range(0, 400, 2)] + [("c1", f"x{i}") for i in range(3)], "customer_id string, mail string")
    tables = [(known, "known"), (mails, "customer_id")]
    heavy = measure_heavy({"orders": Lookup(orders, F.col("customer"), tables)}, keep, limit=200)["orders"]
    assert heavy.wide == (False, False)
    plain = left_lookups(orders, tables, F.col("customer"), ["order_id"])
    dealt = left_lookups(orders, tables, F.col("customer"), ["order_id"], heavy)
    assert dealt.columns == plain.columns and bag(dealt) == bag(plain)
    assert largest_share(plain) > 0.5 and largest_share(dealt) < 0.3
    # a lookup's own heavy key, and one that no left row has
    both = measure_heavy({"orders": Lookup(orders, F.col("customer"), tables)}, keep, limit=2)["orders"]
    assert both.wide == (False, True)
    assert bag(left_lookups(orders, tables, F.col("customer"), ["order_id"], both)) == bag(plain)


def test_nothing_heavy_changes_nothing(spark, keep):
    calls, profiles = calls_and_profiles(spark)
    lookup = {"calls": Lookup(calls, phone_digits("caller"), [(profiles, "phone")])}
    assert measure_heavy(lookup, keep, limit=100_000) == {} and not keep.written
    assert measure_heavy(lookup, None, limit=1) == {}


def test_models_with_heavy_keys(spark, keep):
    """Touches and conversions of the fixture, every key heavy, against the plain joins."""
    from touchcredit.plans.pipeline import AttributionPipeline
    from touchcredit.sources.fixtures import load_fixture_sources

    pipe = AttributionPipeline(load_fixture_sources(spark, "/root/testdata/sf0.001"), materialize=True)
    try:
        src, profiles = pipe.sources, pipe.profiles
        heavy = touch.heavy_contacts(src, profiles, pipe.ga4_lookup, pipe.pixel_lookup, keep, limit=1)
        assert set(heavy) == {"ga4", "pixel", "calls", "helpdesk"}
        plain = touch.enriched_touchpoints(src, profiles)
        assert bag(touch.enriched_touchpoints(src, profiles, pipe.ga4_lookup, pipe.pixel_lookup, keep, 1)) == bag(plain)
        assert bag(conv.joined_orders(src, profiles, keep, 1)) == bag(conv.joined_orders(src, profiles))
    finally:
        pipe.drop_tables()


def events(spark, n=6000):
    """A third of the rows in one (group, day), half of them at one instant; some groups and times are null."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((None, "2024-01-05 12:00:00" if i % 2 else f"2024-01-05 {i % 24:02d}:{i % 60:02d}:00", i))
        else:
            rows.append((f"g{rng.randint(0, 400)}", None if i % 97 == 0 else f"2024-01-{1 + i % 28:02d} {i % 24:02d}:00:00", i))
    df = spark.createDataFrame(rows, "g string, t string, id long").repartition(5)
    return df.select("g", F.to_timestamp_ntz("t").alias("t"), "id")


def test_only_hot_groups_are_ranged(spark, keep, plain_joins):
    df = events(spark)
    args = dict(group="g", ts="t", tiebreak="id")
    plain = bag(ordered_positions(df, **args))
    got = ordered_positions(df, **args, keep=keep, max_chunk_rows=150, name="ranges")
    assert bag(got) == plain
    hot = keep.written["ranges"]
    # the hot (group, day) alone was moved and written; every other row stays by its day
    assert hot.count() == 2000 and hot.select("g").distinct().collect() == [(None,)]
    largest = hot.groupBy("__pc").count().agg(F.max("count")).first()[0]
    assert largest <= 150
    assert keep.written["ranges_hot"].count() == 1


def test_ranges_are_bounded_by_the_cluster(spark, keep, plain_joins):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    df = events(spark)
    out = chunks.chunked(df, [F.col("g")], [F.col("t"), F.col("id")], F.col("t"), 86400, "c", keep, 10, "few")
    assert keep.written["few"].select("c").distinct().count() <= chunks.RANGES_PER_PARTITION * 3
    assert out.count() == df.count()
    # numbers rise with time inside a group, across ranges and days
    span = out.where("t is not null").groupBy("g", "c").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy("g", "c").collect()
    for a, b in zip(span, span[1:]):
        assert a["g"] != b["g"] or a["hi"] <= b["lo"]
    last = out.where("t is null").agg(F.min("c")).first()[0]
    assert last > out.where("t is not null").agg(F.max("c")).first()[0]


def test_no_hot_group_adds_no_step(spark, keep):
    df = events(spark)
    out = chunks.chunked(df, [F.col("g")], [F.col("t")], F.col("t"), 86400, "c", keep, 10_000)
    assert not keep.written and "Join" not in out._jdf.queryExecution().executedPlan().toString()
