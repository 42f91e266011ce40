"""Command line: build the models or run the data-quality rules.

    python -m touchcredit run  --sources DIR --out DIR      # all models -> parquet tables
    python -m touchcredit run  --sources DIR --database DB  # all models -> catalog tables, replaced as a whole
    python -m touchcredit test --sources DIR                # 58 rules, non-zero exit on failure
    python -m touchcredit test --sources DIR --rules FILE   # own rules (YAML or JSON), see plans.quality.load_rules
    python -m touchcredit run  --fixtures SF_DIR --out DIR  # sources derived from the test tables

``--sources`` holds one parquet table per raw source (``customers``,
``orders``, ``ga4_events``, ...). ``--select`` limits ``run`` to some
models and what they need.
On a cluster, ``--executors N --input-gb G`` sizes shuffle partitions and scan
splits for the input (``session.scale_conf``).
"""

from __future__ import annotations

import argparse
import sys

from touchcredit.plans import quality
from touchcredit.plans.pipeline import AttributionPipeline
from touchcredit.session import get_session, scale_conf
from touchcredit.sources.catalog import create_database
from touchcredit.sources.fixtures import load_fixture_sources
from touchcredit.sources.readers import read_sources
from touchcredit.sources.schemas import SOURCE_SCHEMAS


def _pipeline(spark, args) -> AttributionPipeline:
    if args.fixtures:
        src = load_fixture_sources(spark, args.fixtures)
    else:
        src = read_sources(spark, {n: f"{args.sources}/{n}" for n in SOURCE_SCHEMAS}, args.format)
    return AttributionPipeline(src, materialize=True, half_life_days=args.half_life_days)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="touchcredit")
    ap.add_argument("command", choices=["run", "test"])
    where = ap.add_mutually_exclusive_group(required=True)
    where.add_argument("--sources")
    where.add_argument("--fixtures")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--out")
    ap.add_argument("--database")
    ap.add_argument("--rules")
    ap.add_argument("--select", nargs="*")
    ap.add_argument("--half-life-days", type=float, default=7.0)
    ap.add_argument("--master")
    ap.add_argument("--executors", type=int)
    ap.add_argument("--input-gb", type=float)
    args = ap.parse_args(argv)

    extra = None
    if args.executors and args.input_gb:
        extra = scale_conf(int(args.input_gb * (1 << 30)), args.executors)
    spark = get_session(args.master, extra=extra)
    pipe = _pipeline(spark, args)
    try:
        if args.command == "run":
            if bool(args.out) == bool(args.database):
                ap.error("run needs --out or --database")
            if args.database:
                create_database(spark, args.database)
            for name in pipe.write_models(args.out, select=args.select, database=args.database):
                print(f"built {name}")
            return 0
        rules = quality.load_rules(args.rules) if args.rules else quality.RULES
        failed = [r for r in quality.run_checks(pipe.models(), rules).collect() if r["failures"]]   # one row per rule
        for r in failed:
            print(f"{r['failures']} failures: {r['rule']} {r['model']}.{r['column_name']}")
        return 1 if failed else 0
    finally:
        pipe.drop_tables()


if __name__ == "__main__":
    sys.exit(main())
