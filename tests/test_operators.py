"""Skew-tolerant operators against brute-force definitions on random data.

Chunks are made tiny (minutes) so that the cross-chunk carry paths are
exercised, and inputs include NULL keys, NULL times and exact ties.
"""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchcredit.operators import asof_forward, left_lookup, not_in, ordered_positions, top1

BASE = dt.datetime(2024, 1, 1)


def _ts(rng, span_minutes=600, null_rate=0.05):
    if rng.random() < null_rate:
        return None
    # coarse grid so that exact ties happen
    return BASE + dt.timedelta(minutes=rng.randrange(span_minutes // 5) * 5,
                               seconds=rng.choice([0, 0, 30]))


def _key(rng, n_keys=5, null_rate=0.05):
    return None if rng.random() < null_rate else f"u{rng.randrange(n_keys)}"


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("chunk", [60, 3600, 86400])
def test_asof_forward_equals_interval_join(spark, seed, chunk):
    rng = random.Random(seed)
    left = [(i, _key(rng), _ts(rng)) for i in range(300)]
    right = [(f"o{j:03d}", _key(rng), _ts(rng), float(j)) for j in range(60)]
    ldf = spark.createDataFrame(left, "tid long, user string, t timestamp_ntz")
    rdf = spark.createDataFrame(right, "oid string, ruser string, rts timestamp_ntz, val double")
    got = asof_forward(ldf, rdf, "user", "t", "ruser", "rts", "oid", ["oid", "val"],
                       chunk_seconds=chunk)
    got = sorted((r.tid, r.oid, r.val) for r in got.collect())

    # brute force: per key, orders sorted by (ts, oid); interval (prev, cur]
    expected = []
    by_key: dict = {}
    for oid, k, ts, val in right:
        if k is not None and ts is not None:
            by_key.setdefault(k, []).append((ts, oid, val))
    for k in by_key:
        by_key[k].sort()
    for tid, k, t in left:
        if k is None or t is None or k not in by_key:
            continue
        prev = None
        for ts, oid, val in by_key[k]:
            if t <= ts and (prev is None or t > prev):
                expected.append((tid, oid, val))
            prev = ts
    assert got == sorted(expected)


@pytest.mark.parametrize("seed", [4, 5])
@pytest.mark.parametrize("chunk", [60, 86400])
def test_ordered_positions_equals_window(spark, seed, chunk):
    rng = random.Random(seed)
    rows = [(f"p{i:04d}", _key(rng, 4, 0.1), _ts(rng, 300, 0.1)) for i in range(250)]
    df = spark.createDataFrame(rows, "pid string, g string, t timestamp_ntz")
    got = ordered_positions(df, "g", "t", "pid", chunk_seconds=chunk)
    got = {r.pid: (r.position, r.prev_ts, r.next_ts, r.group_size) for r in got.collect()}

    groups: dict = {}
    for pid, g, t in rows:
        groups.setdefault(g, []).append((t is None, t or BASE, pid, t))
    expected = {}
    for g, items in groups.items():
        items.sort()
        for i, (_, _, pid, t) in enumerate(items):
            prev = items[i - 1][3] if i > 0 else None
            nxt = items[i + 1][3] if i + 1 < len(items) else None
            expected[pid] = (i + 1, prev, nxt, len(items))
    assert got == expected


def test_top1_matches_row_number(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([True, False]),
             rng.choice([None, 1, 2, 3]), f"id{i:03d}") for i in range(200)]
    df = spark.createDataFrame(rows, "k string, known boolean, ts int, sid string")
    got = top1(df, ["k"], [~F.col("known"), F.col("ts"), F.col("sid")], ["known", "ts", "sid"])
    got = {r.k: (r.known, r.ts, r.sid) for r in got.collect()}
    expected = {}
    for k, known, ts, sid in sorted(rows, key=lambda r: (not r[1], r[2] is None, r[2] or 0, r[3])):
        expected.setdefault(k, (known, ts, sid))
    assert got == expected


def test_top1_last(spark):
    df = spark.createDataFrame([("j", 1, "a"), ("j", 3, "b"), ("j", 2, "c"), ("j", None, "d")],
                               "k string, ts int, ch string")
    last = top1(df, ["k"], [F.col("ts")], ["ch"], last=True).collect()
    assert last[0].ch == "d"   # NULL times sort last


@pytest.mark.parametrize("subset,expected", [
    ([], {"a", "b", None}),               # empty set keeps everything, NULL too
    (["a"], {"b"}),                       # NULL key is unknown -> dropped
    (["a", None], set()),                 # NULL in the set -> nothing passes
])
def test_not_in_three_valued(spark, subset, expected):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, id long")
    sub = spark.createDataFrame([(s,) for s in subset],
                                T.StructType([T.StructField("k", T.StringType())]))
    got = {r.k for r in not_in(df, "k", sub, "k", salt=["id"]).collect()}
    assert got == expected


def test_left_lookup_keeps_unmatched_and_fans_out(spark):
    left = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id long, k string")
    lookup = spark.createDataFrame([("x", "p1"), ("x", "p2"), (None, "p3")], "k string, v string")
    got = sorted(((r.id, r.v) for r in left_lookup(left, lookup, F.col("k"), "k", ["id"]).collect()),
                 key=lambda t: (t[0], t[1] or ""))
    assert got == [(1, "p1"), (1, "p2"), (2, None), (3, None)]


def test_accepted_values_counts_distinct_offenders_per_column(spark):
    from touchcredit.plans.quality import accepted_values_many
    df = spark.createDataFrame([("a", 0), ("x", 1), ("x", 2), ("y", None), (None, 3)],
                               "ch string, n int")
    got = {r.column_name: r.failures for r in
           accepted_values_many(df, "m", [("ch", ("a", "b")), ("n", (0, 1))]).collect()}
    assert got == {"ch": 2, "n": 2}


def _interval_join(left, right):
    """Brute force: interval (previous right row, this right row] per key."""
    by_key: dict = {}
    for oid, k, ts in right:
        if k is not None and ts is not None:
            by_key.setdefault(k, []).append((ts, oid))
    out = []
    for tid, k, t in left:
        if k is None or t is None:
            continue
        prev = None
        for ts, oid in sorted(by_key.get(k, [])):
            if t <= ts and (prev is None or t > prev):
                out.append((tid, oid))
            prev = ts
    return sorted(out)


try:
    from hypothesis import given, settings
    from hypothesis import strategies as st
except ImportError:  # pragma: no cover
    given = None

if given is not None:
    _instant = st.one_of(st.none(), st.sampled_from(
        [BASE + dt.timedelta(seconds=s) for s in (0, 1, 59, 60, 3599, 3600, 86399, 86400, 90000)]))
    _k = st.one_of(st.none(), st.sampled_from(["a", "b"]))

    @settings(max_examples=25, deadline=None)
    @given(left=st.lists(st.tuples(_k, _instant), max_size=12),
           right=st.lists(st.tuples(_k, _instant), max_size=6),
           chunk=st.sampled_from([1, 60, 3600, 86400]))
    def test_asof_property(spark, left, right, chunk):
        lrows = [(i, k, t) for i, (k, t) in enumerate(left)]
        rrows = [(f"o{j}", k, t) for j, (k, t) in enumerate(right)]
        ldf = spark.createDataFrame(lrows, "tid long, user string, t timestamp_ntz")
        rdf = spark.createDataFrame(rrows, "oid string, ruser string, rts timestamp_ntz")
        got = asof_forward(ldf, rdf, "user", "t", "ruser", "rts", "oid", ["oid"], chunk_seconds=chunk)
        assert sorted((r.tid, r.oid) for r in got.collect()) == _interval_join(lrows, rrows)
