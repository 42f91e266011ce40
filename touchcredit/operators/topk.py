"""Top-1 per group as an aggregation.

``row_number() over (partition by k order by ...) = 1`` needs a whole group in
one task; ``min(struct(order keys, payload))`` gives the same row through a
partial (map-side) plus final aggregate, so a group holding a third of all rows
is reduced to one row per map task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchcredit.functions.normalize import asc_nulls_last


def top1(df: DataFrame, keys: Sequence[str], order: Sequence[Column], payload: Sequence[str],
         last: bool = False) -> DataFrame:
    """One row per ``keys`` group: the first row by ``order`` (ASC NULLS LAST), or
    the last one when ``last``. Returns ``keys + payload`` columns. Express a
    descending boolean key as its negation."""
    packed = F.struct(*asc_nulls_last(*order), *[F.col(p).alias(p) for p in payload])
    pick = (F.max if last else F.min)(packed).alias("__top")
    return (df.groupBy(*keys).agg(pick)
            .select(*keys, *[F.col("__top").getField(p).alias(p) for p in payload]))
