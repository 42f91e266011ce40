"""Plan-shape guards for every registered query.

At 100 TB a plan must not pair rows within a group (cartesian / nested-loop
joins), must not gather a group into one row, and must stay JVM-side (no
Python UDF evaluation). Filters must reach the source scans.
"""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from touchcredit.plans import journeys, quality
from touchcredit.plans.pipeline import AttributionPipeline
from touchcredit.sources.fixtures import load_fixture_sources

QUERIES = E.core_queries()
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "collect_list", "collect_set", "FlatMapGroupsInPandas"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan_is_scale_safe(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key}: {bad} in plan"


def test_event_filters_are_pushed_to_the_scan(spark):
    plan = _plan(QUERIES["src_ga4_events"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def _touch_scans(df) -> list[str]:
    plan = _plan(df)
    scans = [line.split("FileScan parquet [")[1].split("]")[0] for line in plan.splitlines() if "FileScan parquet [" in line]
    return [cols for cols in scans if "resolved_known_customer_id" in cols]


def test_marts_shuffle_only_needed_touch_columns(spark):
    """The intermediate table behind the marts, and the marts' own plan."""
    p = E.pipeline(spark, SF_SMALL)
    p.prepare("enriched_touches", "conversions")
    touch_scans = _touch_scans(journeys.attribution_rows(p.enriched_touches, p.conversions))
    assert touch_scans
    for cols in touch_scans:
        assert "campaign" not in cols and "raw_identifier" not in cols, cols
    assert not _touch_scans(QUERIES["attribution_time_decay"](spark, SF_SMALL))


def test_written_tables_have_safe_plans(spark, monkeypatch):
    """The plans of the tables written on the way, which the last plan of a query does not show."""
    seen = {}
    keep = AttributionPipeline._keep
    monkeypatch.setattr(AttributionPipeline, "_keep", lambda self, df, name: (seen.update({name: _plan(df)}), keep(self, df, name))[1])
    p = AttributionPipeline(load_fixture_sources(spark, SF_SMALL))
    try:
        p.user_journeys, p.attribution
    finally:
        p.drop_tables()
    assert {"profiles", "ga4_lookup", "pixel_lookup", "enriched_touches", "joined_orders", "conversions", "converting", "converted",
            "non_converting", "user_journeys", "attribution"} <= set(seen)
    for name, plan in seen.items():
        for bad in FORBIDDEN:
            assert bad not in plan, f"{name}: {bad} in plan"


def test_summary_is_one_pass(spark):
    plan = _plan(QUERIES["attribution_summary"](spark, SF_SMALL))
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("FileScan parquet") == 1 and initial.count("Exchange hashpartitioning") <= 3


def _tables(p: AttributionPipeline, spark) -> set[str]:
    return {x.name for x in Path(p.table_dir(spark).removeprefix("file:")).iterdir()} if p.__dict__.get("_written") else set()


def test_only_what_is_asked_is_built(spark, tmp_path):
    p = AttributionPipeline(load_fixture_sources(spark, SF_SMALL))
    try:
        p.write_models(str(tmp_path / "out"), select=["stg_costs"])
        assert _tables(p, spark) == set()
        quality.run_checks(p.models(), quality.rules_of(quality.RELATIONSHIPS)).collect()
        assert _tables(p, spark) == {"profiles", "joined_orders", "conversions"}
        quality.run_checks(p.models(), quality.rules_of(quality.UNIQUE, expression=False)).collect()
        assert "user_journeys" not in _tables(p, spark)
    finally:
        p.drop_tables()
    with pytest.raises(ValueError):
        p.write_models(str(tmp_path / "x"), select=["no_such_model"])
