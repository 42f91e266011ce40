"""M10 -- declarative data-quality checks.

A rule names a model, a check and a column or any SQL expression over the
model's columns. ``run_checks`` turns a rule list into one DataFrame of
``(model, rule, column_name, failures)``; a rule passes when ``failures == 0``.
Failure counts follow the usual column-test conventions:

* ``not_null``            rows whose value is NULL
* ``unique``              distinct non-NULL values occurring more than once
* ``accepted_values``     distinct non-NULL values outside the list
* ``relationships``       child rows whose non-NULL key has no parent row
* ``expression_is_true``  rows for which the expression is false (NULL passes)

Rules are data: ``load_rules`` reads them from a dict or a YAML / JSON file in
the usual model-properties layout.

All rules share one plan. Each model is scanned once, whatever its rules: a row
is expanded to the (rule, value) entries that matter -- every value of a unique
or relationship column, also of parents, but only the failing ones of the other
checks. The entries of all models are counted by (rule, value) in one aggregate
(partial sums first, so a hot value is one row per task), and one more adds up
each rule's failures. Nothing is collected.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchcredit.plans import constants as K

NOT_NULL, UNIQUE, ACCEPTED, RELATIONSHIPS = "not_null", "unique", "accepted_values", "relationships"
EXPRESSION = "expression_is_true"
JOURNEY_KEY_EXPR = "journey_id || '::' || platform_id"


@dataclass(frozen=True)
class Rule:
    model: str
    rule: str
    column: str
    values: tuple = ()
    to_model: str | None = None
    to_field: str | None = None


def _mart_rules(model: str) -> list[Rule]:
    return [Rule(model, NOT_NULL, c) for c in K.MART_COLUMNS] + [Rule(model, UNIQUE, "channel")]


# The column tests of the reference models (58 rules).
RULES: list[Rule] = [
    *[Rule("stg_customers_unification", NOT_NULL, c)
      for c in ("customer_profile_id", "source_system", "source_timestamp")],
    Rule("stg_customers_unification", UNIQUE, "customer_profile_id"),
    *[Rule("stg_touchpoints", NOT_NULL, c) for c in ("platform_id", "channel", "event_timestamp")],
    Rule("stg_touchpoints", UNIQUE, "platform_id"),
    *[Rule("stg_conversions", NOT_NULL, c) for c in
      ("order_id", "user_id", "conversion_timestamp", "revenue", "is_repeat_purchase")],
    Rule("stg_conversions", UNIQUE, "order_id"),
    Rule("stg_conversions", RELATIONSHIPS, "user_id", to_model="stg_customers_unification",
         to_field="known_customer_id"),
    *[Rule("stg_costs", NOT_NULL, c) for c in ("cost_date", "channel", "cost")],
    Rule("stg_costs", ACCEPTED, "channel", tuple(K.COST_CHANNELS)),
    Rule("int_user_journeys", UNIQUE, JOURNEY_KEY_EXPR),
    *[Rule("int_user_journeys", NOT_NULL, c) for c in (
        "journey_id", "journey_end_date", "platform_id", "resolved_customer_profile_id", "channel",
        "campaign", "event_timestamp", "converted", "touchpoint_sequence", "days_to_conversion",
        "total_touches_in_journey", "is_first_touch", "is_last_touch", "is_single_touch_journey")],
    Rule("int_user_journeys", ACCEPTED, "touchpoint_match_method", tuple(K.MATCH_METHODS)),
    Rule("int_user_journeys", ACCEPTED, "customer_type", tuple(K.CUSTOMER_TYPES)),
    Rule("int_user_journeys", ACCEPTED, "channel", tuple(K.CHANNELS)),
    Rule("int_user_journeys", ACCEPTED, "converted", (0, 1)),
    *_mart_rules("fct_attribution_first_touch"),
    *_mart_rules("fct_attribution_last_touch"),
    *_mart_rules("fct_attribution_linear"),
    *_mart_rules("fct_attribution_time_decay"),
]


def load_rules(spec: Mapping | str | Path) -> list[Rule]:
    """Rules from a dict, or from a YAML or JSON file, in the layout of model properties::

        models:
          - name: stg_costs
            data_tests:
              - unique: {column_name: "cost_date || channel"}
              - expression_is_true: {expression: "cost >= 0"}
            columns:
              - name: channel
                data_tests:
                  - not_null
                  - accepted_values: {values: [paid_search, paid_social]}
                  - relationships: {to: ref('other_model'), field: channel}

    ``tests`` is read like ``data_tests``; a column's name may be any SQL expression; parameters may stand under
    ``arguments``.
    """
    if not isinstance(spec, Mapping):
        text = Path(spec).read_text(encoding="utf-8")
        if str(spec).endswith(".json"):
            spec = json.loads(text)
        else:
            import yaml     # only YAML files need it

            spec = yaml.safe_load(text)
    rules = []
    for model in spec.get("models", ()):
        places = [(model, None), *((c, c["name"]) for c in model.get("columns", ()))]
        for place, column in places:
            for test in [*place.get("data_tests", ()), *place.get("tests", ())]:
                kind, args = (test, {}) if isinstance(test, str) else next(iter(test.items()))
                args = {**(args or {}), **(args or {}).get("arguments", {})}
                rules.append(_rule(model["name"], kind, column, args))
    return rules


def _rule(model: str, kind: str, column: str | None, args: Mapping) -> Rule:
    column = column or args.get("column_name") or args.get("expression")
    if kind not in (NOT_NULL, UNIQUE, ACCEPTED, RELATIONSHIPS, EXPRESSION):
        raise ValueError(f"unknown check {kind!r} on {model}")
    if not column:
        raise ValueError(f"{kind} on {model} names no column or expression")
    if kind == EXPRESSION and "expression" in args and column != args["expression"]:
        column = f"{column} {args['expression']}"        # on a column: the comparison that follows it
    to = re.sub(r"""^ref\(['"](.*)['"]\)$""", r"\1", str(args["to"])) if "to" in args else None
    return Rule(model, kind, column, tuple(args.get("values", ())), to, args.get("field"))


def rule_expr(column: str) -> Column:
    """A column name or any SQL expression over the model's columns."""
    return F.expr(column)


def _entry(i: int, value: Column | None, parent: bool = False) -> Column:
    return F.struct(F.lit(i).alias("rule"), (F.lit(None) if value is None else value).cast("string").alias("value"), F.lit(parent).alias("parent"))


def _entries(df: DataFrame, rules: list[tuple[int, Rule]], parents: list[tuple[int, str]]) -> DataFrame:
    """(rule, value, parent) of one scan of a model."""
    always, seldom, wrong = [], [], []
    for i, r in rules:
        e = rule_expr(r.column)
        if r.rule in (UNIQUE, RELATIONSHIPS):
            always.append(F.when(e.isNotNull(), _entry(i, e)))
            continue
        if r.rule == ACCEPTED:
            fails, value = F.coalesce(~e.isin(list(r.values)), F.lit(False)), e
        else:
            fails, value = (e.isNull() if r.rule == NOT_NULL else F.coalesce(~e, F.lit(False))), None
        wrong.append(fails)
        seldom.append(F.when(fails, _entry(i, value)))
    always += [F.when(F.col(c).isNotNull(), _entry(i, F.col(c), True)) for i, c in parents]
    kind = "array<struct<rule:int,value:string,parent:boolean>>"
    none = F.array().cast(kind)
    every = F.array(*always).cast(kind) if always else none
    if seldom:
        # the failing entries of a row are built only if it has any
        bad = reduce(lambda a, b: a | b, wrong)
        if not always:
            df, every = df.where(bad), F.array(*seldom).cast(kind)
        else:
            every = F.concat(every, F.when(bad, F.array(*seldom).cast(kind)).otherwise(none))
    return df.select(F.explode(every).alias("x")).where(F.col("x").isNotNull()).select("x.rule", "x.value", "x.parent")


def run_checks(models: Mapping[str, DataFrame], rules: Iterable[Rule] = RULES) -> DataFrame:
    rules = list(rules)
    by_model: dict[str, tuple[list, list]] = {}
    for i, r in enumerate(rules):
        by_model.setdefault(r.model, ([], []))[0].append((i, r))
        if r.rule == RELATIONSHIPS:
            by_model.setdefault(r.to_model, ([], []))[1].append((i, r.to_field))
    parts = [_entries(models[m], tested, parents) for m, (tested, parents) in by_model.items()]
    values = reduce(DataFrame.unionByName, parts).groupBy("rule", "value").agg(
        F.count_if(~F.col("parent")).alias("n"), F.max("parent").alias("parent"))
    found = values.groupBy("rule").agg(
        F.sum("n").alias("rows"), F.count_if(F.col("n") > 0).alias("kinds"), F.count_if(F.col("n") > 1).alias("repeated"),
        F.sum(F.when(~F.col("parent"), F.col("n"))).alias("orphans")).withColumnRenamed("rule", "of")
    listed = models[rules[0].model].sparkSession.createDataFrame(
        [(i, r.model, r.rule, r.column) for i, r in enumerate(rules)], "i int, model string, rule string, column_name string")
    kind = F.col("rule")
    failures = (F.when(kind == UNIQUE, F.col("repeated")).when(kind == ACCEPTED, F.col("kinds"))
                .when(kind == RELATIONSHIPS, F.col("orphans")).otherwise(F.col("rows")))
    # a rule without any entry has no failures
    # at most one row per rule
    return listed.join(F.broadcast(found), F.col("i") == F.col("of"), "left").select(
        "model", "rule", "column_name", F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"))


def accepted_values_many(df: DataFrame, model: str, checks: list[tuple[str, tuple]]) -> DataFrame:
    """Every ``(column, allowed values)`` check of one model in a single scan."""
    return run_checks({model: df}, [Rule(model, ACCEPTED, c, tuple(v)) for c, v in checks])


def rules_of(kind: str, expression: bool | None = None) -> list[Rule]:
    out = [r for r in RULES if r.rule == kind]
    if expression is not None:
        out = [r for r in out if (r.column == JOURNEY_KEY_EXPR) == expression]
    return out
