"""Ordered positions inside a group without putting a whole group in one task.

Adds, for ``ORDER BY ts ASC NULLS LAST, tiebreak ASC NULLS LAST`` within each
group: ``row_number`` (1-based), ``lag(ts)``, ``lead(ts)`` and the group size
-- the values the plain window functions give -- computed as:

1. window over ``(group, chunk)``: local row number, local lag/lead; chunks are
   days, or ranges of the sort key where a day is too large (``operators.chunks``);
2. per-chunk summary ``(count, min ts, max ts)`` by partial aggregation, then a
   window over the group's chunk rows for the count of earlier rows and the
   neighbouring chunks' boundary timestamps (one row per chunk, so a group's
   cost is bounded by its time span, not its row count);
3. join back on ``(group, chunk)``; the large side is already partitioned on
   those keys.

NULL timestamps sort last, NULL groups are kept as a group of their own, exactly
like window partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchcredit.operators.asof import DAY_SECONDS
from touchcredit.operators.chunks import Keep, chunked

_G, _GN, _C = "__pg", "__pgn", "__pc"


def ordered_positions(df: DataFrame, group: str, ts: str, tiebreak: str | Sequence[str],
                      position: str = "position", prev_ts: str = "prev_ts",
                      next_ts: str = "next_ts", group_size: str = "group_size",
                      chunk_seconds: int = DAY_SECONDS, keep: Keep | None = None,
                      max_chunk_rows: int | None = None, name: str = "position_ranges") -> DataFrame:
    t = F.col(ts)
    order = [F.col(c).asc_nulls_last() for c in (ts, *([tiebreak] if isinstance(tiebreak, str) else tiebreak))]
    keyed = df.withColumns({
        _G: F.coalesce(F.col(group).cast("string"), F.lit("")),
        _GN: F.col(group).isNull(),
    })
    keyed = chunked(keyed, [F.col(_GN), F.col(_G)], order, t, chunk_seconds, _C, keep, max_chunk_rows, name)
    local = Window.partitionBy(_G, _GN, _C).orderBy(*order)
    rows = keyed.withColumns({
        "__rn": F.row_number().over(local).cast("bigint"),
        "__lp": F.lag(t).over(local),
        "__ln": F.lead(t).over(local),
    })

    chunks = keyed.groupBy(_G, _GN, _C).agg(F.count(F.lit(1)).alias("__n"),
                                           F.min(t).alias("__lo"), F.max(t).alias("__hi"))
    by_chunk = Window.partitionBy(_G, _GN).orderBy(_C)
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(
        _G, _GN, _C, "__n",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).cast("bigint").alias("__off"),
        F.lag("__hi").over(by_chunk).alias("__pl"),
        F.lead("__lo").over(by_chunk).alias("__nf"),
        F.sum("__n").over(Window.partitionBy(_G, _GN)).cast("bigint").alias("__tot"))

    out = rows.join(chunks, [_G, _GN, _C], "inner")
    first, last = F.col("__rn") == 1, F.col("__rn") == F.col("__n")
    return out.select(
        *df.columns,
        (F.col("__off") + F.col("__rn")).alias(position),
        F.when(first, F.col("__pl")).otherwise(F.col("__lp")).alias(prev_ts),
        F.when(last, F.col("__nf")).otherwise(F.col("__ln")).alias(next_ts),
        F.col("__tot").alias(group_size))
