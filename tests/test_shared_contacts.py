"""Many profiles behind one phone or mail: journeys are written once per class of profiles, and equal the oracle."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest

from test_scenarios import META, ROWS, _duck, _sources, ts
from test_skew import _same
from touchcredit.oracle_sql import model_sql, sources_from_tables
from touchcredit.plans.pipeline import AttributionPipeline

SHARED = 40
CUSTOMERS = ([(f"s{i}", "b2c", dt.date(2024, 1, 1), "555-777-0001", f"s{i}@example.com") for i in range(SHARED)]
             + [(f"n{i}", "b2b", dt.date(2024, 1, 2), "no digits", "office@example.com") for i in range(5)])
CALLS = ([(100 + i, "+1", "(555) 777 0001", ts(3 + i % 20, 9, i), 30, "inbound", "line") for i in range(30)]
         + [(100, "+1", "(555) 777 0001", ts(3, 9, 0), 30, "inbound", "line"),        # a repeated row
            (900, "+1", "unknown", ts(5), 30, "inbound", "line"), (901, "+1", None, ts(5), 30, "inbound", "line")])
EMAILS = [(1, "S3@example.com", ts(4), "topic"), (2, "s3@example.com", ts(6), "topic"), (3, "office@example.com", ts(7), "topic"),
          (4, "office@example.com", None, None), (5, "nobody@example.com", ts(7), "topic")]
ORDERS = [(5000, "s0", ts(10), 10.0), (5001, "s0", ts(12), 20.0), (5002, None, ts(11), 1.0), (5003, "stranger", ts(11), 1.0)]
CONTACTS = dict(ROWS, customers=ROWS["customers"] + CUSTOMERS, calls=ROWS["calls"] + CALLS, orders=ROWS["orders"] + ORDERS,
                helpdesk_emails=ROWS["helpdesk_emails"] + EMAILS, meta_costs=META)


@pytest.mark.parametrize("heavy_rows", [None, 3])
def test_shared_contacts_match_oracle(spark, heavy_rows):
    pipe, con = AttributionPipeline(_sources(spark, CONTACTS), heavy_rows=heavy_rows), _duck(CONTACTS)
    try:
        for df, cte in ((pipe.converting, "journeys_converting"), (pipe.non_converting, "journeys_non_converting"),
                        (pipe.user_journeys, "user_journeys")):
            assert _same(df, con.sql(model_sql(cte, sources_from_tables("hm_")))), cte
    finally:
        pipe.drop_tables()


def test_shared_calls_are_not_written_for_each_profile(spark):
    pipe = AttributionPipeline(_sources(spark, CONTACTS))
    try:
        pairs = pipe.non_converting.where("channel = 'phone'").count()
        written = spark.read.parquet(f"{pipe.table_dir(spark)}/non_converting").where("channel = 'phone'").count()
        assert pairs > 30 * (SHARED - 1) and written <= 30 * 2 + 10           # classes: with and without a mail
        touches = spark.read.parquet(f"{pipe.table_dir(spark)}/enriched_touches")
        assert {r[0] for r in touches.select("resolved_known_customer_id").distinct().collect()} <= {c for _, c, *_ in CONTACTS["orders"]}
    finally:
        pipe.drop_tables()


@pytest.mark.parametrize("orders", [[], [("s1_no_conversion", "s0", ts(10), 10.0), (1, "s0", ts(12), 20.0)]])
def test_cases_that_classes_do_not_cover(spark, orders):
    """Nothing converted: rows without a profile count. An order named like a journey: both are one journey."""
    rows = dict(CONTACTS, orders=[])
    src, con = _sources(spark, rows), _duck(rows)
    if orders:
        src = replace(src, orders=spark.createDataFrame(orders, "order_id string, customer_id string, created_at timestamp_ntz, total_price double"))
        con.execute("ALTER TABLE hm_orders ALTER order_id TYPE VARCHAR")
        con.executemany("INSERT INTO hm_orders VALUES (?, ?, ?, ?)", orders)
    pipe = AttributionPipeline(src)
    try:
        assert not pipe._by_class
        want = con.sql(model_sql("user_journeys", sources_from_tables("hm_")))
        if not orders:
            assert _same(pipe.user_journeys, want)
        else:                       # touches of one call in one journey are in any order
            some = ["journey_id", "platform_id", "resolved_customer_profile_id", "converted", "total_touches_in_journey"]
            assert _same(pipe.user_journeys.select(*some), want.select(", ".join(some)))
    finally:
        pipe.drop_tables()
