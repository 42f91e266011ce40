"""Loading the eight raw sources from storage.

``RawSources`` is the bundle every model takes. ``read_sources`` reads one
table per source from any Spark file format (or catalog table) and conforms it
to the contract in ``schemas`` with an explicit projection, so Catalyst prunes
columns and pushes filters straight into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchcredit.sources.schemas import SOURCE_SCHEMAS


@dataclass(frozen=True)
class RawSources:
    customers: DataFrame
    orders: DataFrame
    ga4_events: DataFrame
    meta_pixel_events: DataFrame
    calls: DataFrame
    helpdesk_emails: DataFrame
    google_costs: DataFrame
    meta_costs: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema`` (name, order and type); fails on a missing column."""
    have = [(f.name, f.dataType) for f in df.schema.fields]
    if have == [(f.name, f.dataType) for f in schema.fields]:
        return df
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_source(spark: SparkSession, location: str, name: str, fmt: str = "parquet") -> DataFrame:
    schema = SOURCE_SCHEMAS[name]
    if fmt == "table":
        df = spark.read.table(location)
    elif fmt in ("csv", "json"):
        df = spark.read.schema(schema).option("header", "true").format(fmt).load(location)
    else:
        df = spark.read.format(fmt).load(location)
    return conform(df, schema)


def read_sources(spark: SparkSession, locations: dict[str, str], fmt: str = "parquet") -> RawSources:
    """``locations`` maps each source name in ``SOURCE_SCHEMAS`` to a path or table name."""
    return RawSources(**{n: read_source(spark, locations[n], n, fmt) for n in SOURCE_SCHEMAS})


def write_sources(sources: RawSources, root: str, mode: str = "overwrite") -> None:
    """Persist a source bundle as one parquet table per source (the loader's CTAS step)."""
    for name, df in sources.as_dict().items():
        df.write.mode(mode).parquet(f"{root}/{name}")
