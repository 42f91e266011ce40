"""Catalog sinks, rules as data, the marts' one pass, exact cents and costs beside the summary."""

from __future__ import annotations

import json
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from touchcredit import AttributionPipeline
from touchcredit.__main__ import main
from touchcredit.functions.normalize import money
from touchcredit.plans import constants as K
from touchcredit.plans import marts, quality
from touchcredit.sources import catalog
from touchcredit.sources.fixtures import load_fixture_sources


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    catalog.create_database(spark, name, f"file:{tmp_path}/db")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@pytest.fixture(scope="module")
def pipe(spark):
    p = AttributionPipeline(load_fixture_sources(spark, SF_SMALL))
    yield p
    p.drop_tables()


def failing(df):
    """``df``, whose write fails after some rows are out."""
    return df.repartition(4).withColumn("id", F.when(F.col("id") == 90, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")))


def test_replace_is_all_or_nothing(spark, database):
    table = f"{database}.t"
    catalog.replace_table(spark.range(10).select("id", F.lit("a").alias("x")), table)
    reader = spark.table(table)
    with pytest.raises(Exception, match="killed"):
        catalog.replace_table(failing(spark.range(100).select("id", F.lit("b").alias("x"))), table)
    assert spark.table(table).count() == 10 and {r.x for r in reader.collect()} == {"a"}
    with pytest.raises(Exception, match="killed"):          # a table's first write
        catalog.replace_table(failing(spark.range(100)), f"{database}.fresh")
    assert not spark.catalog.tableExists(f"{database}.fresh")
    catalog.replace_table(spark.range(7).select("id", F.lit("c").alias("x")), table)
    assert {r.x for r in spark.table(table).collect()} == {"c"} and spark.table(table).count() == 7
    for n in (3, 4):
        catalog.replace_table(spark.range(n).select("id", F.lit("d").alias("x")), table)
    assert spark.table(table).count() == 4 and len(catalog.versions(spark, table)) == 2


def test_replace_a_table_from_itself(spark, database):
    table = f"{database}.self"
    catalog.replace_table(spark.range(5), table)
    for n in (10, 20):
        catalog.replace_table(spark.table(table).unionAll(spark.table(table)), table)
        assert spark.table(table).count() == n


def test_other_columns_and_recovery(spark, database):
    table = f"{database}.cols"
    catalog.replace_table(spark.range(5), table)
    catalog.replace_table(spark.range(6).select(F.col("id").cast("string").alias("name"), F.lit(1).alias("n")), table)
    assert spark.table(table).columns == ["name", "n"] and spark.table(table).count() == 6
    # cut off between dropping the old table and naming the new one
    spark.sql(f"ALTER TABLE {table} RENAME TO {database}.cols{catalog.NEXT}")
    catalog.recover(spark, table)
    assert spark.table(table).count() == 6
    empty = spark.range(0).select(F.col("id").alias("name"))
    catalog.replace_table(empty, table)
    assert spark.table(table).schema["name"].dataType == empty.schema["name"].dataType and spark.table(table).count() == 0


def test_models_by_name_in_a_second_session(spark, database, pipe):
    names = pipe.register_views(database=database)
    assert len(names) == 10
    other = spark.newSession()
    counts = {n: other.table(f"{database}.{n}").count() for n in names}
    assert all(counts.values()) and counts["stg_costs"] == 60
    assert other.sql(f"SHOW VIEWS IN {database}").count() == 10
    # the table behind a view is replaced under it, also by other columns
    catalog.publish(spark.range(3).select(F.col("id").alias("only")), f"{database}.stg_costs")
    assert spark.newSession().table(f"{database}.stg_costs").columns == ["only"]


def test_attach_in_another_catalog(spark, database, pipe, tmp_path):
    pipe.write_models(database=database, select=["stg_costs"])
    pipe.register_views(database=database, select=["fct_attribution_linear"])
    other = f"{database}_other"                             # a catalog that knows nothing of the first one's tables
    assert set(catalog.attach(spark, other, f"file:{tmp_path}/db")) == {
        "stg_costs", "fct_attribution_linear", f"fct_attribution_linear{catalog.ROWS}"}
    assert spark.table(f"{other}.stg_costs").count() == 60
    assert spark.table(f"{other}.fct_attribution_linear").columns == K.MART_COLUMNS
    assert catalog.attach(spark, other, f"file:{tmp_path}/db") == []
    spark.sql(f"DROP DATABASE {other} CASCADE")


def test_write_models_wants_one_place(pipe):
    with pytest.raises(ValueError):
        pipe.write_models()
    with pytest.raises(ValueError):
        pipe.write_models("/tmp/x", database="y")


RULES = {"models": [{"name": "m", "data_tests": [{"unique": {"column_name": "a || b"}}, {"expression_is_true": {"arguments": {"expression": "a <> b"}}}],
                     "columns": [{"name": "a", "data_tests": ["not_null", {"accepted_values": {"values": ["x", "y"]}}]},
                                 {"name": "n", "tests": [{"expression_is_true": {"expression": "> 1"}}, {"relationships": {"to": "ref('p')", "field": "k"}}]}]}]}


def test_rules_as_data(spark, tmp_path):
    df = spark.createDataFrame([("x", "1", 1), ("x", "1", 2), ("y", "y", 2), ("z", None, None), (None, "q", 9)], "a string, b string, n int")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    got = {(r.rule, r.column_name): r.failures for r in quality.run_checks({"m": df, "p": parent}, quality.load_rules(RULES)).collect()}
    assert got == {("unique", "a || b"): 1, ("expression_is_true", "a <> b"): 1, ("not_null", "a"): 1, ("accepted_values", "a"): 1,
                   ("expression_is_true", "n > 1"): 1, ("relationships", "n"): 1}
    for name, text in (("r.json", json.dumps(RULES)), ("r.yml", json.dumps(RULES))):        # JSON is YAML too
        (tmp_path / name).write_text(text)
        assert quality.load_rules(tmp_path / name) == quality.load_rules(RULES)
    with pytest.raises(ValueError):
        quality.load_rules({"models": [{"name": "m", "tests": ["no_such_check"]}]})
    with pytest.raises(ValueError):
        quality.load_rules({"models": [{"name": "m", "tests": ["unique"]}]})


def test_rules_from_the_command_line(spark, tmp_path):
    path = tmp_path / "own.yml"
    path.write_text("models:\n  - name: stg_costs\n    columns:\n      - name: cost\n        data_tests:\n          - not_null\n"
                    "          - expression_is_true: {expression: '>= 0'}\n")
    assert main(["test", "--fixtures", SF_SMALL, "--rules", str(path)]) == 0
    path.write_text("models:\n  - name: stg_costs\n    tests:\n      - expression_is_true: {expression: 'cost < 0'}\n")
    assert main(["test", "--fixtures", SF_SMALL, "--rules", str(path)]) == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_one_scan_per_model(spark, pipe):
    models = dict(pipe.models())
    for rules in (quality.rules_of(quality.UNIQUE), quality.rules_of(quality.NOT_NULL), quality.RULES):
        checked = {r.model for r in rules} | {r.to_model for r in rules if r.to_model}
        inputs = sum(plan(models[m]).count("FileScan") for m in checked)
        text = plan(quality.run_checks(models, rules))
        assert text.count("FileScan") == inputs and text.count("Exchange hashpartitioning") - sum(
            plan(models[m]).count("Exchange hashpartitioning") for m in checked) <= 2
        assert "Exchange SinglePartition" not in text


def test_marts_from_one_pass(spark, pipe):
    assert plan(marts.all_marts(pipe.converting)).count("FileScan") == 1
    wide = pipe.all_marts
    for method, one in ((K.METHOD_FIRST_TOUCH, pipe.first_touch), (K.METHOD_LAST_TOUCH, pipe.last_touch), (K.METHOD_LINEAR, pipe.linear),
                        (K.METHOD_TIME_DECAY, pipe.time_decay)):
        got = marts.mart_of(wide, method)
        assert got.dtypes == one.dtypes
        a, b = ({r.channel: r for r in df.collect()} for df in (got, one))
        assert a.keys() == b.keys()
        for c in a:
            assert a[c].attribution_method == b[c].attribution_method
            assert float(a[c].attributed_conversions) == pytest.approx(float(b[c].attributed_conversions))
            assert float(a[c].attributed_revenue) == pytest.approx(float(b[c].attributed_revenue))


def test_cents_like_the_binary_value(spark):
    values = [1.005, -1.005, 0.125, -0.125, 2.675, 1.115, 0.015, 8.345, 123456789.125, 9999999999.985, -9999999999.994, 1e-9, 4.35, 1.255, 655.355, 0.0]
    values += [i * 0.005 for i in range(-400, 400)] + [i * 1234567.005 for i in range(1, 300)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(money("v")).collect()]
    want = [duckdb.execute("SELECT ?::DOUBLE::DECIMAL(12,2)", [v]).fetchone()[0] for v in values]
    assert got == want and str(got[0]) == "1.00"
    with pytest.raises(Exception, match="(?i)numeric|overflow|out_of_range"):
        spark.createDataFrame([(1e10,)], "v double").select(money("v")).collect()


def test_half_cents_of_large_order_keys(spark, tmp_path):
    """Amounts beyond ten digits before the point, which a revenue's decimal(12,2) does not hold."""
    keys = [1, 149_999, 810_045, 900_001, 9_000_000, 123_456_789, -900_001]
    spark.createDataFrame([(k, k % 7919, 1 + i % 3, 0.05, 1234.565) for i, k in enumerate(keys)],
                          "l_orderkey long, l_partkey long, l_linenumber int, l_discount double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r["l_linenumber"]: r["large"] for r in E.core_queries()["half_cent_amounts"](spark, str(tmp_path)).collect()}
    want = duckdb.execute("SELECT 1 + i % 3, sum((k * 12345.005::DOUBLE + 0.005::DOUBLE)::DECIMAL(28,2))::DECIMAL(38,2) "
                          "FROM (SELECT unnest(?::BIGINT[]) AS k, unnest(range(7)) AS i) GROUP BY 1", [keys]).fetchall()
    assert got == dict(want)


def test_costs_beside_the_summary(spark):
    summary = spark.createDataFrame([("search", "linear", 2.0, 100.0), ("search", "first_touch", 0.0, 0.0), ("organic", "linear", 1.0, 5.0),
                                     (None, "linear", 1.0, 1.0), ("free", "linear", 1.0, 7.0)],
                                    "channel string, attribution_method string, attributed_conversions double, attributed_revenue double")
    costs = spark.createDataFrame([("ads", 10.0), ("ads", 15.0), ("tv", 9.0), ("free", 0.0), (None, 2.0)], "channel string, cost double")
    got = sorted(map(tuple, marts.summary_with_costs(summary, costs, {"ads": "search"}).collect()), key=str)
    assert got == sorted([("search", "linear", 2.0, 100.0, 25.0, 12.5, 4.0), ("search", "first_touch", 0.0, 0.0, 25.0, None, 0.0),
                          ("organic", "linear", 1.0, 5.0, None, None, None), ("tv", None, None, None, 9.0, None, None),
                          ("free", "linear", 1.0, 7.0, 0.0, 0.0, None), (None, "linear", 1.0, 1.0, 2.0, 2.0, 0.5)], key=str)
    assert marts.summary_with_costs(summary, costs, {}).where("channel = 'ads'").first()["attribution_method"] is None
