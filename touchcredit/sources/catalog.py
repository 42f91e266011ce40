"""Catalog tables that are replaced as a whole, and catalog views over them.

``replace_table`` first writes the new rows to a folder of their own, which no
reader knows, and only then points the table to it, one change of the catalog.
A write that fails or is killed leaves the old table as it was. Readers that
have begun go on with the files they know: the version before is kept, older
ones are deleted.

Views are stored in the catalog, so every session that shares it reads them by
name. ``attach`` registers the newest complete versions under a folder in a
catalog that does not know them, such as that of another application without a
shared metastore.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Written next to a table whose columns changed, for the moment of the exchange.
NEXT = "__next"
#: Tables behind views.
ROWS = "__rows"


def quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{at}")


def table_root(spark: SparkSession, table: str) -> str:
    """The folder that holds the versions of a table: its name in the folder of its database."""
    database, name = table.split(".")
    return f"{spark.catalog.getDatabase(database).locationUri}/{name}"


def _folder(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str, inside: str | None = None) -> list[str]:
    """Names of the folders in ``path``, in order; with ``inside``, of those that hold a file of that name."""
    at, fs = _folder(spark, path)
    if not fs.exists(at):
        return []
    found = [x.getPath() for x in fs.listStatus(at) if x.isDirectory()]
    jvm = spark.sparkContext._jvm
    return sorted(x.getName() for x in found if inside is None or fs.exists(jvm.org.apache.hadoop.fs.Path(x, inside)))


def versions(spark: SparkSession, table: str) -> list[str]:
    """The complete versions of a table, oldest first."""
    return [f"{table_root(spark, table)}/{v}" for v in _names(spark, table_root(spark, table), "_SUCCESS")]


def recover(spark: SparkSession, table: str) -> None:
    """Finish an exchange of columns that was cut off between its two steps."""
    if not spark.catalog.tableExists(quoted(table)) and spark.catalog.tableExists(quoted(table + NEXT)):
        spark.sql(f"ALTER TABLE {quoted(table + NEXT)} RENAME TO {quoted(table)}")


def _shape(schema: T.StructType) -> list[tuple]:
    return [(f.name, f.dataType) for f in schema.fields]


def replace_table(df: DataFrame, table: str, fmt: str = "parquet", keep: int = 1) -> str:
    """Create ``database.table`` with the rows of ``df``, or replace it; the folder of the new version.

    With the columns it had, the table changes in one step. With other ones it is made anew under a second name
    and renamed, which ``recover`` completes should it be cut off. ``keep`` versions before the new one stay.
    """
    spark = df.sparkSession
    recover(spark, table)
    location = f"{table_root(spark, table)}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").format(fmt).save(location)
    name = quoted(table)
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=location, source=fmt, schema=df.schema)
    elif _shape(spark.table(name).schema) == _shape(df.schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(table + NEXT)}")
        spark.catalog.createTable(quoted(table + NEXT), path=location, source=fmt, schema=df.schema)
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {quoted(table + NEXT)} RENAME TO {name}")
    done = versions(spark, table)
    for old in done[:max(0, done.index(location) - keep)]:
        path, fs = _folder(spark, old)
        fs.delete(path, True)
    return location


def replace_view(spark: SparkSession, view: str, over: str, columns: list[str]) -> None:
    """A stored view with the given columns of a table."""
    chosen = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(view)} AS SELECT {chosen} FROM {quoted(over)}")


def publish(df: DataFrame, view: str) -> None:
    """Store a model: its rows as a table behind a view of its name. The table may be replaced at any time."""
    replace_table(df, view + ROWS)
    replace_view(df.sparkSession, view, view + ROWS, df.columns)


def attach(spark: SparkSession, database: str, location: str) -> list[str]:
    """Register what was stored under ``location`` in a catalog without it; the names of its tables and views."""
    create_database(spark, database, location)
    names = []
    for name in _names(spark, location):
        done = _names(spark, f"{location}/{name}", "_SUCCESS")
        table = f"{database}.{name}"
        if not done or spark.catalog.tableExists(quoted(table)):
            continue
        spark.catalog.createTable(quoted(table), path=f"{location}/{name}/{done[-1]}", source="parquet")
        names.append(name)
        if name.endswith(ROWS):
            view = name.removesuffix(ROWS)
            replace_view(spark, f"{database}.{view}", table, spark.table(quoted(table)).columns)
            names.append(view)
    return names
