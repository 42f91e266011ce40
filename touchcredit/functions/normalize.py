"""Column-level helpers: identity keys, dialect-exact string/date arithmetic and
sort keys. All are native Catalyst expressions (no UDFs), so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_trim(c: ColumnOrName) -> Column:
    """Lower-cased, surrounding spaces removed (source-id and email keys)."""
    return F.lower(F.trim(_c(c)))


def email_key(c: ColumnOrName) -> Column:
    """Identity-side email key: lower-cased, surrounding spaces removed."""
    return lower_trim(c)


def email_lower(c: ColumnOrName) -> Column:
    """Touch-side email key: lower-cased only (inbound mails are looked up untrimmed)."""
    return F.lower(_c(c))


def phone_digits(c: ColumnOrName) -> Column:
    """Phone key: every non-digit character removed."""
    return F.regexp_replace(_c(c), r"[^0-9]", "")


def concat_skip_nulls(*cols: ColumnOrName) -> Column:
    """String concatenation that skips NULL parts (``concat('a', NULL)`` = ``'a'``)."""
    return F.concat_ws("", *[_c(c) for c in cols])


def money(c: ColumnOrName, to: str = "decimal(12,2)") -> Column:
    """A double as a decimal with two places: hundredths are taken of the binary value, then rounded half
    away from zero, so 1.005 (just below, in binary) is 1.00. Spark's own cast rounds the shortest decimal
    form instead. Too large an amount fails, as the cast does."""
    hundredths = F.round(_c(c).cast("double") * F.lit(100.0)).cast("decimal(36,0)")
    return (hundredths * F.lit("0.01").cast("decimal(2,2)")).cast(to)


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def day_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of midnights crossed from ``start`` to ``end`` (calendar-day difference)."""
    return F.datediff(_c(end), _c(start)).cast("bigint")


def second_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of whole-second boundaries crossed from ``start`` to ``end``."""
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))).cast("bigint")


def asc_nulls_last(*cols: ColumnOrName) -> list[Column]:
    """Fields that make a struct compare like ``ORDER BY c1, c2 ... ASC NULLS LAST``.

    Spark orders struct fields nulls-first, so each column is preceded by its
    ``IS NULL`` flag. Used for top-1 picks by ``min(struct(...))``.
    """
    out: list[Column] = []
    for i, c in enumerate(cols):
        col = _c(c)
        out += [col.isNull().alias(f"_n{i}"), col.alias(f"_k{i}")]
    return out


def time_chunk(ts: ColumnOrName, chunk_seconds: int) -> Column:
    """Monotone bucket of a zone-less timestamp; NULL timestamps sort after every chunk."""
    bucket = F.floor(F.unix_timestamp(_c(ts)) / F.lit(chunk_seconds)).cast("bigint")
    return F.coalesce(bucket, F.lit(2**62).cast("bigint"))
