"""Helpers shared by the operators: intermediate tables in the shared folder, held-out rows, doc ids."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import os
import uuid
from collections.abc import Callable, Iterable
from pathlib import Path

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.session import ensure_checkpoint_dir

#: White space of the word pattern ``[^\x20\x09-\x0D]+``, as a Java / RE2 character class.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


class Workspace:
    """Tables one operator call writes under the session's checkpoint folder.

    A written table cuts lineage like a checkpoint, is read back with column
    pruning, and survives a lost executor. ``spark.checkpoint.dir`` names the
    folder on a cluster; the session helper creates one only in local tests.
    A result that is a lazy plan reads these tables, so the operator leaves them;
    whoever has written the result calls ``drop`` or ``drop_workspaces``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.tables: list[str] = []
        _open[self.root] = self

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_bucketed(self, df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
        """``keep`` as a catalog table in buckets: tables of one bucketing meet by its column without a shuffle."""
        table = f"{self.root.rsplit('/', 1)[-1]}_{name}".replace("-", "_")
        (df.write.format("parquet").mode("overwrite").option("path", f"{self.root}/{name}")
         .bucketBy(buckets, by).sortBy(by).saveAsTable(table))
        self.tables.append(table)
        return self.spark.table(table)

    def forget(self, *names: str) -> None:
        """Delete tables that nothing reads any more, and let Spark delete the shuffle files of finished plans."""
        for name in names:
            self._delete(f"{self.root}/{name}")
        # Spark deletes the files of a shuffle once the driver has collected its plan; long jobs cannot wait for that
        gc.collect()
        with contextlib.suppress(Py4JJavaError):   # events that wait for their listeners still hold finished plans
            self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(5000)
        self.spark.sparkContext._jvm.System.gc()

    def drop(self) -> None:
        """Delete the tables; what reads them must have been written or collected."""
        _open.pop(self.root, None)
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._delete(self.root)

    def _delete(self, folder: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_open: dict[str, Workspace] = {}


def workspaces() -> list[str]:
    """Folders of the workspaces that have not been dropped, in the order they were opened."""
    return list(_open)


def drop_workspaces(keep: Iterable[str] = ()) -> None:
    """Drop all but some workspaces: for callers that have written the results they want."""
    for root in set(_open) - set(keep):
        _open[root].drop()


def hand_back() -> None:
    """Return freed memory of this worker to the system: it waits for its next task, maybe of another stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):          # another C library: it does so by itself, or not at all
        pass


#: What this worker keeps from task to task: by module, how to let it go.
caches: dict[str, Callable[[], None]] = {}


def let_go(module: str) -> None:
    """Drop what other modules keep in this worker. Workers call this by name: a pickled dict would be a copy."""
    for other, forget in list(caches.items()):
        if other != module:
            forget()


def tidy(run: Callable) -> Callable:
    """``run`` (an iterator of batches to an iterator), which lets the caches of other modules go, whose stages are over,
    and hands memory back at the end of a task."""

    @functools.wraps(run)
    def tidied(batches):
        let_go(run.__module__)
        try:
            yield from run(batches)
        finally:
            hand_back()

    return tidied


#: Bytes of a batch that Spark hands to a Python worker: both sides hold a few of them.
BATCH_BYTES = 8 << 20


def ensure_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, unless it is installed there, and bound
    the bytes of their batches (a limit of rows alone lets long texts add up).

    Spark prepends this to the workers' PYTHONPATH; a folder that an executor lacks is ignored.
    """
    limit = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").removesuffix("b")
    if not limit.isdigit() or int(limit) > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    here = str(Path(__file__).resolve().parents[2])
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH", ""), here) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    used = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name.lower() in used:
        name += "_"
    return name


def fold(id_col: str, mod: int) -> Column:
    """``crc32(id as text) mod n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % F.lit(mod)
