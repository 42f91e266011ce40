"""The model DAG, wired once.

    sources -> profiles -> {touchpoints, conversions} -> journeys -> marts
    sources -> costs

Profiles feed six lookups and journeys feed four marts, so with
``materialize=True`` the fan-out points (profiles, enriched touches,
conversions, converting journeys) are written once as parquet tables under the
session's checkpoint directory (the shared ``spark.checkpoint.dir`` on a
cluster) and read back: later stages scan them with column pruning and filter
pushdown instead of recomputing, lineage is cut, and a lost executor costs a
re-read of shared files rather than a recompute. (An eager RDD checkpoint would
compute each plan twice and store rows without pruning.) This is the default;
with ``materialize=False`` every property is a lazy plan, which recomputes the
shared subtrees wherever they fan out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit.operators.asof import DAY_SECONDS
from touchcredit.plans import conversions as conv
from touchcredit.plans import costs as cost
from touchcredit.plans import identity, journeys, marts
from touchcredit.plans import touchpoints as touch
from touchcredit.plans import constants as K
from touchcredit.plans.constants import DEFAULT_HALF_LIFE_DAYS
from touchcredit.sources import catalog
from touchcredit.sources.readers import RawSources


class LazyModels(Mapping[str, DataFrame]):
    """Model name -> DataFrame; a model (and what it needs) is built when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class AttributionPipeline:
    def __init__(self, sources: RawSources, materialize: bool = True,
                 chunk_seconds: int = DAY_SECONDS, half_life_days: float = DEFAULT_HALF_LIFE_DAYS, heavy_rows: int | None = None):
        self.sources = sources
        self.materialize = materialize
        self.chunk_seconds = chunk_seconds
        if not half_life_days > 0:
            raise ValueError(f"half_life_days must be positive, not {half_life_days}")
        self.half_life_days = half_life_days
        self.heavy_rows = heavy_rows
        self._run_id = uuid.uuid4().hex

    def table_dir(self, spark) -> str:
        from touchcredit.session import ensure_checkpoint_dir
        return f"{ensure_checkpoint_dir(spark)}/touchcredit-{self._run_id}"

    def drop_tables(self) -> None:
        """Delete the tables this pipeline wrote (its own run folder only). The
        DataFrames returned so far must not be used afterwards."""
        if not self.materialize or not self.__dict__.get("_written"):
            return
        spark = self.sources.customers.sparkSession
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.table_dir(spark))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self._written = False

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        if not self.materialize:
            return df
        path = f"{self.table_dir(df.sparkSession)}/{name}"
        df.write.mode("overwrite").parquet(path)
        self._written = True
        return df.sparkSession.read.schema(df.schema).parquet(path)

    @property
    def _keeper(self):
        """What operators write measured intermediate tables with; None for lazy plans."""
        return self._keep if self.materialize else None

    def _keeper_for(self, part: str):
        """The same under names of their own, for an operator that is used more than once."""
        return (lambda df, name: self._keep(df, f"{part}_{name}")) if self.materialize else None

    def prepare(self, *names: str) -> None:
        """Materialise independent tables concurrently (one Spark job per thread;
        the scheduler runs their stages side by side). Their inputs must already
        exist, so shared upstream tables are built first, on this thread."""
        todo = [n for n in names if n not in self.__dict__]
        if not self.materialize or len(todo) < 2:
            for n in todo:
                getattr(self, n)
            return
        # threads inherit the caller's job group / scheduler pool, so cancellation still works
        spark = self.sources.customers.sparkSession
        build = inheritable_thread_target(spark)(lambda n: getattr(self, n))
        with ThreadPoolExecutor(max_workers=len(todo)) as pool:
            list(pool.map(build, todo))

    # -- staging ---------------------------------------------------------
    @cached_property
    def profiles(self) -> DataFrame:
        return self._keep(identity.unify_identities(self.sources), "profiles")

    # lookups are written: their keys are counted before they are joined
    @cached_property
    def ga4_lookup(self) -> DataFrame:
        return self._keep(touch.source_id_lookup(self.profiles, K.SYS_GA4), "ga4_lookup")

    @cached_property
    def pixel_lookup(self) -> DataFrame:
        return self._keep(touch.source_id_lookup(self.profiles, K.SYS_META_PIXEL), "pixel_lookup")

    @cached_property
    def enriched_touches(self) -> DataFrame:
        return self._keep(touch.enriched_touchpoints(self.sources, self.profiles, self.ga4_lookup, self.pixel_lookup,
                                                     self._keeper, self.heavy_rows), "all_touches")

    @cached_property
    def buyer_touches(self) -> DataFrame:
        """The touches that can belong to an order: those of customers who have any."""
        if not self.materialize:
            return self.enriched_touches
        buyers = self._keep(journeys.having_ordered(self.profiles, self.sources), "buyers")
        found = touch.enriched_touchpoints(
            self.sources, buyers, journeys.having_ordered(self.ga4_lookup, self.sources),
            journeys.having_ordered(self.pixel_lookup, self.sources), self._keeper_for("buyer"), self.heavy_rows)
        return self._keep(found.where("resolved_known_customer_id IS NOT NULL"), "enriched_touches")

    @property
    def touchpoints(self) -> DataFrame:
        return touch.public_touchpoints(self.enriched_touches)

    @cached_property
    def conversions(self) -> DataFrame:
        return self._keep(conv.build_conversions(self.sources, self.profiles, self.chunk_seconds, self._keeper, self.heavy_rows),
                          "conversions")

    @property
    def costs(self) -> DataFrame:
        return cost.build_costs(self.sources)

    def order_intervals(self) -> DataFrame:
        return journeys.order_intervals(self.conversions, self.chunk_seconds, self._keeper)

    # -- journeys ----------------------------------------------------------
    def _touches_and_orders(self) -> tuple[DataFrame, DataFrame]:
        self.profiles
        self.prepare("buyer_touches", "conversions")
        return self.buyer_touches, self.conversions

    @cached_property
    def converting(self) -> DataFrame:
        return self._keep(journeys.converting_journeys(*self._touches_and_orders(), self.chunk_seconds, self._keeper), "converting")

    @cached_property
    def attribution(self) -> DataFrame:
        """The narrow converting rows that the marts read, for when no journeys are wanted."""
        return self._keep(journeys.attribution_rows(*self._touches_and_orders(), self.chunk_seconds, self._keeper), "attribution")

    @cached_property
    def converted(self) -> DataFrame:
        return self._keep(journeys.converted_profiles(self.converting), "converted")

    @cached_property
    def _by_class(self) -> bool:
        """Whether the other journeys can be built by class. Not if nothing converted (rows without a profile then
        count) or a profile is unknown (nothing counts), nor if an order's id may be such a journey's id."""
        if not self.materialize:
            return False
        n, unknown, alike = self.converting.agg(
            F.count(F.lit(1)), F.count_if(F.col("resolved_customer_profile_id").isNull()),
            F.count_if(F.col("journey_id").endswith(K.NO_CONVERSION_SUFFIX))).first()
        return n > 0 and unknown == 0 and alike == 0

    @cached_property
    def journey_members(self) -> DataFrame:
        return self._keep(journeys.journey_members(self.sources, self.profiles, self.converting, self.converted,
                                                   self._keeper, self.heavy_rows), "journey_members")

    @cached_property
    def class_journeys(self) -> DataFrame:
        """Non-converting journey rows of every class of profiles with the same contacts."""
        members = self.journey_members
        classes = self._keep(journeys.class_profiles(members), "class_profiles")
        found = touch.enriched_touchpoints(
            self.sources, classes, journeys.class_lookup(self.ga4_lookup, members), journeys.class_lookup(self.pixel_lookup, members),
            self._keeper_for("class"), self.heavy_rows)
        # read twice by the position computation (rows and per-chunk summary)
        return self._keep(journeys.non_converting_rows(found.where("resolved_customer_profile_id IS NOT NULL")), "non_converting")

    @cached_property
    def non_converting(self) -> DataFrame:
        if self._by_class:
            return journeys.of_each_profile(self.class_journeys, self.journey_members, self._keeper, self.heavy_rows)
        return self._keep(journeys.non_converting_journeys(self.enriched_touches, self.converting, self.converted),
                          "non_converting")

    def journey_rows_with_positions(self) -> DataFrame:
        if not self._by_class:
            rows = self.converting.unionByName(self.non_converting)
            return journeys.with_positions(rows, self.chunk_seconds, self._keeper)
        converting = journeys.with_positions(self.converting, self.chunk_seconds, self._keeper)
        classes = journeys.with_positions(self.class_journeys, self.chunk_seconds, self._keeper, "class_journey_ranges")
        return converting.unionByName(journeys.of_each_profile(classes, self.journey_members, self._keeper_for("positions"), self.heavy_rows))

    @cached_property
    def user_journeys(self) -> DataFrame:
        # read by several quality rules and views: written once when materialising
        return self._keep(self.journey_rows_with_positions(), "user_journeys")

    # -- marts (computed from converting rows only) -------------------------
    @property
    def first_touch(self) -> DataFrame:
        return marts.first_touch(self.converting)

    @property
    def last_touch(self) -> DataFrame:
        return marts.last_touch(self.converting)

    @property
    def linear(self) -> DataFrame:
        return marts.linear(self.converting)

    @property
    def time_decay(self) -> DataFrame:
        return marts.time_decay(self.converting, self.half_life_days)

    @property
    def summary(self) -> DataFrame:
        return marts.summary(self.converting, self.half_life_days)

    @property
    def summary_with_costs(self) -> DataFrame:
        return marts.summary_with_costs(self.summary, self.costs)

    @cached_property
    def all_marts(self) -> DataFrame:
        """The four marts side by side, from one pass over the converting rows."""
        return self._keep(marts.all_marts(self.converting, self.half_life_days), "marts")

    def register_views(self, prefix: str = "", select: list[str] | None = None, database: str | None = None) -> list[str]:
        """Expose models (all, or those in ``select``) as views under their names, so they can be
        queried with ``spark.sql`` (the reference materialises all models as views). With
        ``database`` the views are stored in the catalog, over written tables, and outlive the
        session; without it they are temporary and lazy."""
        names = []
        for name, df in self._selected(select):
            if database:
                catalog.publish(df, f"{database}.{prefix}{name}")
            else:
                df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def write_models(self, root: str | None = None, mode: str = "overwrite", fmt: str = "parquet", select: list[str] | None = None,
                     database: str | None = None) -> list[str]:
        """Persist models (all, or those in ``select``): as tables of ``database``, each replaced only when its
        new rows are complete, or as plain folders ``root/<model name>``."""
        if (root is None) == (database is None):
            raise ValueError("give either root or database")
        names = []
        for name, df in self._selected(select):
            if database:
                catalog.replace_table(df, f"{database}.{name}", fmt)
            else:
                df.write.mode(mode).format(fmt).save(f"{root}/{name}")
            names.append(name)
        return names

    def _selected(self, select: list[str] | None) -> Iterator[tuple[str, DataFrame]]:
        models = self.models()
        known = [*models, "fct_attribution_summary"]
        if unknown := [n for n in select or () if n not in known]:
            raise ValueError(f"unknown models: {', '.join(unknown)}")
        for name in known:
            if not select or name in select:
                yield name, models[name] if name in models else self.summary

    def models(self) -> Mapping[str, DataFrame]:
        """Model name -> DataFrame, as addressed by the quality rules; built when asked for.

        The marts come from one written table of a few rows.
        """
        mart = lambda method: marts.mart_of(self.all_marts, method)
        return LazyModels({
            "stg_customers_unification": lambda: self.profiles,
            "stg_touchpoints": lambda: self.touchpoints,
            "stg_conversions": lambda: self.conversions,
            "stg_costs": lambda: self.costs,
            "int_user_journeys": lambda: self.user_journeys,
            "fct_attribution_first_touch": lambda: mart(K.METHOD_FIRST_TOUCH),
            "fct_attribution_last_touch": lambda: mart(K.METHOD_LAST_TOUCH),
            "fct_attribution_linear": lambda: mart(K.METHOD_LINEAR),
            "fct_attribution_time_decay": lambda: mart(K.METHOD_TIME_DECAY),
        })
