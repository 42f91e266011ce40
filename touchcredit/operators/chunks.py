"""Chunks of a group's sort order, small enough for one task whatever the key.

A group is cut into time chunks (a day by default). That is enough while no
(group, day) is large. Where one is -- a bot's day, a backfill, a batch stamped
with one instant, guest orders, or rows without a time -- its rows, and only
those, are range-partitioned by the full sort key: Spark samples the key, ties
included, so a hot day or instant spans several ranges, and the number of the
range divides the day. All other rows stay where their day puts them, unmoved.
Chunk numbers rise with the sort order, which is all the carry logic needs. The
ranged rows are written once (``keep``), because two readers must see the same
ranges; their number of partitions follows the cluster, not only the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchcredit.functions.normalize import time_chunk

#: Rows of one (group, chunk) above which it is divided into ranges.
MAX_CHUNK_ROWS = 500_000
#: Hot (group, chunk) pairs up to which their table is broadcast: a few MB of keys and a number.
MAX_BROADCAST_KEYS = 100_000
#: Ranges at most, as a multiple of the session's shuffle partitions.
RANGES_PER_PARTITION = 4
#: Ranges of one chunk are numbered within this many; a chunk of rows without a time comes after every real one.
_RANGES, _NO_TIME = 1 << 20, 1 << 42
Keep = Callable[[DataFrame, str], DataFrame]


def chunked(df: DataFrame, group: Sequence[Column], order: Sequence[Column], ts: Column, chunk_seconds: int, into: str,
            keep: Keep | None = None, max_chunk_rows: int | None = None, name: str = "ranges") -> DataFrame:
    """``df`` with the chunk column ``into``. Without ``keep`` (a lazy plan) chunks are always by time."""
    by_time = df.withColumn(into, time_chunk(ts, chunk_seconds))
    if keep is None:
        return by_time
    limit = max_chunk_rows or MAX_CHUNK_ROWS
    keys = [g.alias(f"__h{i}") for i, g in enumerate(group)]
    hot = by_time.groupBy(*keys, F.col(into).alias("__hc")).agg(F.count(F.lit(1)).alias("__hn")).where(F.col("__hn") > limit)
    pairs, rows = hot.agg(F.count(F.lit(1)), F.sum("__hn")).first()
    if not pairs:
        return by_time
    hot = keep(hot, f"{name}_hot")
    if pairs <= MAX_BROADCAST_KEYS:
        hot = F.broadcast(hot)
    same = reduce(lambda a, b: a & b, [g.eqNullSafe(F.col(f"__h{i}")) for i, g in enumerate(group)], F.col(into) == F.col("__hc"))
    # a time chunk and a range within it in one number
    place = F.least(F.col(into), F.lit(_NO_TIME)) * F.lit(_RANGES)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(2, min(-(-2 * rows // limit), RANGES_PER_PARTITION * partitions, _RANGES - 1))
    divided = (by_time.join(hot, same, "left_semi").repartitionByRange(ranges, *group, *order)
               .withColumn(into, place + F.spark_partition_id()))
    return by_time.join(hot, same, "left_anti").withColumn(into, place).unionByName(keep(divided, name))
