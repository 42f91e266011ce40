"""Join helpers that keep NULL-heavy keys from landing in one task.

A shuffle join hashes every NULL key to the same partition although a NULL can
never match. ``left_lookup`` and ``not_in`` join on ``(key, key_is_null)`` and
replace a NULL key by a deterministic per-row salt, so unmatched rows spread
evenly and are still never matched (the other side carries ``key_is_null =
false``). Hot non-NULL keys of lookups are measured (``measure_heavy``) and dealt
over salts, with the rows they match copied to each, so no session setting is
needed. The anti join leaves them to AQE's skew-join split, which needs both
inputs to come straight from a shuffle and nothing after the join to rely on
its partitioning: pass a key table that was written before (the pipeline does).
Whether a lookup side is broadcast is decided by AQE from its measured size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchcredit.operators.chunks import MAX_BROADCAST_KEYS, RANGES_PER_PARTITION, Keep

_K, _KN, _P, _Q, _HIT = "__jk", "__jk_null", "__part", "__lookup_part", "__hit"
#: Rows of one key on one side of a lookup above which the key is dealt over parts.
HEAVY_ROWS = 500_000


def _spread(df: DataFrame, key: Column, salt: Sequence[str]) -> DataFrame:
    """Join key as a string (keys compare by their string form); NULL -> row hash."""
    salted = F.xxhash64(*[F.col(s) for s in salt]).cast("string")
    return df.withColumns({_KN: key.isNull(),
                           _K: F.when(key.isNull(), salted).otherwise(key.cast("string"))})


class Heavy(NamedTuple):
    """Measured heavy keys of a chain of lookups: (key, l, r0, r1, ...) with the parts each side is dealt over."""
    keys: DataFrame
    wide: tuple[bool, ...]      # by lookup: whether any of its own keys is heavy


class Lookup(NamedTuple):
    """``left``'s rows meet each of ``tables`` (a table and its key column) on ``key``."""
    left: DataFrame
    key: Column
    tables: Sequence[tuple[DataFrame, str]]


def measure_heavy(lookups: Mapping[str, Lookup], keep: Keep | None, limit: int | None = None) -> dict[str, Heavy]:
    """The heavy keys of several lookups, from one count of the keys of all their sides.

    A key with more than ``limit`` rows on a side is dealt over ceil(rows / limit)
    parts of it, at most as many as a multiple of the shuffle partitions. Heavy keys
    are at most rows / limit; their table is written and broadcast only if it is short.
    """
    if keep is None:
        return {}
    limit = limit or HEAVY_ROWS
    sides = []
    for name, (left, key, tables) in lookups.items():
        sides.append(left.select(F.lit(name).alias("lookup"), F.lit(-1).alias("side"), key.cast("string").alias("key")))
        sides += [t.select(F.lit(name).alias("lookup"), F.lit(i).alias("side"), F.col(k).cast("string").alias("key")) for i, (t, k) in enumerate(tables)]
    counts = (reduce(DataFrame.unionByName, sides).where(F.col("key").isNotNull())
              .groupBy("lookup", "side", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit))
    found = {(r["lookup"], r["side"]): r["keys"] for r in counts.groupBy("lookup", "side").agg(F.count(F.lit(1)).alias("keys")).collect()}
    if not found:
        return {}
    counts = keep(counts, f"heavy_keys_{'_'.join(lookups)}")
    most = RANGES_PER_PARTITION * int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = F.least(F.ceil(F.col("n") / limit), F.lit(most)).cast("int")
    out = {}
    for name in {x for x, _ in found}:
        tables = lookups[name].tables
        side = lambda i, into: F.coalesce(F.max(F.when(F.col("side") == i, parts)), F.lit(1)).alias(into)
        keys = counts.where(F.col("lookup") == name).groupBy(F.col("key").alias("__hk")).agg(
            side(-1, "__l"), *[side(i, f"__r{i}") for i in range(len(tables))])
        if sum(n for (x, _), n in found.items() if x == name) <= MAX_BROADCAST_KEYS:
            keys = F.broadcast(keys)
        out[name] = Heavy(keys, tuple((name, i) in found for i in range(len(tables))))
    return out


def left_lookup(left: DataFrame, lookup: DataFrame, left_key: Column, lookup_key: str,
                salt: Sequence[str], heavy: Heavy | None = None) -> DataFrame:
    """``left LEFT JOIN lookup ON left_key = lookup.lookup_key`` (the lookup key
    column itself is not returned). ``salt`` names left columns that vary across
    rows, used to spread NULL keys and to deal heavy ones."""
    return left_lookups(left, [(lookup, lookup_key)], left_key, salt, heavy)


def left_lookups(left: DataFrame, lookups: Sequence[tuple[DataFrame, str]], left_key: Column,
                 salt: Sequence[str], heavy: Heavy | None = None) -> DataFrame:
    """Several left lookups on the same left key. The key is computed once, so
    after the first shuffle join the left rows stay partitioned on it and the
    following joins move only their lookup side.

    ``heavy`` keys are dealt over parts: a left row goes to one of the key's ``l``
    parts and meets a copy of the key's lookup rows there. Where the lookup's own
    rows of a key are many, they are dealt over ``r`` parts too and the left row
    goes to each, so every pair meets in one of l x r cells."""
    out = _spread(left, left_key, salt)
    on = [_K, _KN]
    if heavy is not None:
        parts = [f"__r{i}" for i in range(len(lookups))]
        out = (out.join(heavy.keys, (F.col(_K) == F.col("__hk")) & ~F.col(_KN), "left").drop("__hk")
               .withColumn(_P, F.pmod(F.xxhash64(*[F.col(s) for s in salt]), F.coalesce("__l", F.lit(1))).cast("int")).drop("__l"))
        on = [*on, _P]
    for i, (lookup, lookup_key) in enumerate(lookups):
        columns = [c for c in lookup.columns if c != lookup_key]
        right = (lookup.where(F.col(lookup_key).isNotNull())
                 .withColumns({_K: F.col(lookup_key).cast("string"), _KN: F.lit(False)}).drop(lookup_key))
        if heavy is None:
            out = out.join(right, on=on, how="left")
            continue
        right = right.join(heavy.keys, F.col(_K) == F.col("__hk"), "left").withColumn(
            _P, F.explode(F.sequence(F.lit(0), F.coalesce("__l", F.lit(1)) - 1)))
        if not heavy.wide[i]:
            out = out.join(right.select(*columns, *on), on=on, how="left")
            continue
        mine = F.coalesce(F.col(parts[i]), F.lit(1))
        right = right.withColumn(_Q, F.pmod(F.xxhash64(*columns), mine).cast("int")).select(*columns, *on, _Q, F.lit(True).alias(_HIT))
        out = out.withColumn(_Q, F.explode(F.sequence(F.lit(0), mine - 1))).join(right, on=[*on, _Q], how="left")
        # a key in parts has matches: cells without one add nothing
        out = out.where((mine == 1) | F.col(_HIT)).drop(_Q, _HIT)
    return out.drop(_K, _KN, _P, *[f"__r{i}" for i in range(len(lookups))])


def not_in(df: DataFrame, key: str, subset: DataFrame, subset_key: str,
           salt: Sequence[str], distinct_keys: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` where ``key NOT IN (SELECT subset_key FROM subset)`` holds
    under SQL three-valued logic: an empty subset keeps every row (NULL keys
    too); a subset containing NULL keeps none; otherwise rows with a non-NULL
    key absent from the subset.

    The anti join runs on the distinct non-NULL subset keys; the two subset
    facts (empty? holds NULL?) are one scalar subquery, evaluated once and
    inlined as a literal -- no cross join, no driver round trip of data.
    ``distinct_keys``: the distinct values of ``subset_key`` as a written table, if
    there is one; the join's inputs are then plain shuffles that AQE can split.
    """
    sk = F.col(subset_key)
    stats = subset.select(F.struct(F.count(F.lit(1)).alias("n"),
                                   F.count_if(sk.isNull()).alias("n_null")).alias("s")).scalar()
    if distinct_keys is None:
        distinct_keys = subset.select(sk).distinct()
    keys = (distinct_keys.where(sk.isNotNull()).select(sk.cast("string").alias(_K))
            .withColumn(_KN, F.lit(False)))
    kept = _spread(df, F.col(key), salt).join(keys, on=[_K, _KN], how="left_anti").drop(_K, _KN)
    return kept.where((stats.getField("n") == 0)
                      | (F.col(key).isNotNull() & (stats.getField("n_null") == 0)))
