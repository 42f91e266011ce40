"""Forward as-of join without a per-key pair blow-up or a per-key hot task.

Semantics: every left row (key k, time t) is paired with the right row of the
same key that sorts first by ``(right_ts, right_order)`` among those with
``right_ts >= t``; left rows with no such right row are dropped (inner). When
the right rows of a key cut its time line into half-open intervals
``(previous, current]``, this is exactly the interval join
``k = k' AND previous < t <= current`` -- but with no k x m candidate pairs.

Plan (all native operators):

1. Union both sides and window over ``(key, chunk)``: scanning a chunk in
   descending time, a running ``min(right struct)`` gives each left row its
   first right row at or after it inside the chunk. A key that holds a third
   of all rows is spread over its chunks, so no task receives a whole key:
   days, or ranges of the sort key where a day is too large (``operators.chunks``).
2. For rows with no hit in their chunk, a carry table gives the first right
   row of the nearest later chunk. It is a running min over one row per
   ``(key, chunk)`` -- bounded by the key's time span, not by its row count.
3. The carry table is joined back on ``(key, chunk)``; the windowed side is
   already hash-partitioned on those columns, so only the small side moves.

Running mins use a growing frame (``UNBOUNDED PRECEDING .. CURRENT ROW``),
which Spark evaluates in one pass; a shrinking frame would be quadratic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchcredit.operators.chunks import Keep, chunked

DAY_SECONDS = 86400
_K, _C, _T, _KIND, _L, _O = "__ak", "__ac", "__at", "__kind", "__l", "__o"


def asof_forward(left: DataFrame, right: DataFrame, left_by: str, left_ts: str,
                 right_by: str, right_ts: str, right_order: str, right_cols: Sequence[str],
                 chunk_seconds: int = DAY_SECONDS, keep: Keep | None = None,
                 max_chunk_rows: int | None = None, name: str = "asof_ranges") -> DataFrame:
    """Left columns plus ``right_cols`` of the matched right row (see module doc)."""
    left_cols = left.columns
    clash = set(left_cols) & set(right_cols)
    if clash:
        raise ValueError(f"right columns clash with left columns: {sorted(clash)}")
    lt, rt = F.col(left_ts), F.col(right_ts)
    lsel = left.where(F.col(left_by).isNotNull() & lt.isNotNull())
    rsel = right.where(F.col(right_by).isNotNull() & rt.isNotNull())
    hit = F.struct(rt.alias("_t"), F.col(right_order).isNull().alias("_n"),
                   F.col(right_order).alias("_o"), *[F.col(c).alias(c) for c in right_cols])

    lrows = lsel.select(F.col(left_by).alias(_K), lt.alias(_T), F.lit(0).alias(_KIND),
                        F.struct(*[F.col(c) for c in left_cols]).alias(_L))
    rrows = rsel.select(F.col(right_by).alias(_K), rt.alias(_T), F.lit(1).alias(_KIND), hit.alias(_O))
    # each side lacks the other's struct column: unionByName fills it with typed NULLs
    both = lrows.unionByName(rrows, allowMissingColumns=True)
    # left rows of one instant are interchangeable here: a hash of the row lets ranges split them
    ties = [F.xxhash64(_L), F.xxhash64(_O)]
    both = chunked(both, [F.col(_K)], [F.col(_T), F.col(_KIND), *ties], F.col(_T), chunk_seconds, _C, keep, max_chunk_rows, name)
    lrows, rrows = both.where(F.col(_KIND) == 0), both.where(F.col(_KIND) == 1)

    # 1. in-chunk: running min of right structs, scanning time backwards; at equal
    #    times right rows come first, so a right row at exactly t counts.
    backwards = (Window.partitionBy(_K, _C).orderBy(F.col(_T).desc(), F.col(_KIND).desc())
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    in_chunk = (both.withColumn("__m", F.min(_O).over(backwards))
                .where(F.col(_KIND) == 0).select(_K, _C, _L, "__m"))

    # 2. carry: first right row of any strictly later chunk of the same key.
    right_chunks = rrows.select(_K, _C, _O).groupBy(_K, _C).agg(F.min(_O).alias("__first")).withColumn(_KIND, F.lit(1))
    left_chunks = lrows.select(_K, _C).distinct().withColumn(_KIND, F.lit(0))
    later = (Window.partitionBy(_K).orderBy(F.col(_C).desc(), F.col(_KIND).asc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry = (left_chunks.unionByName(right_chunks, allowMissingColumns=True)
             .withColumn("__next", F.min("__first").over(later))
             .where(F.col(_KIND) == 0).select(_K, _C, "__next"))

    # 3. the first of both (an instant's right rows may lie in two ranges); every left chunk has exactly one carry row, so the inner join keeps all left rows.
    matched = (in_chunk.join(carry, [_K, _C], "inner")
               .withColumn("__hit", F.least("__m", "__next"))
               .where(F.col("__hit").isNotNull()))
    return matched.select(*[F.col(_L).getField(c).alias(c) for c in left_cols],
                          *[F.col("__hit").getField(c).alias(c) for c in right_cols])
