"""SparkSession helpers shared by tests, the bench and the driver entry point."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the engine relies on. AQE re-plans joins from runtime sizes (so a
# lookup side is broadcast only when it is measured to be small), coalesces
# small shuffle partitions and splits skewed join partitions.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot keys also where the chained lookups of one key then need another shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "touchcredit", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode runs every task in the driver JVM: give it the heap
            builder = builder.config("spark.driver.memory", "8g")
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    On a cluster it is the shared folder named by ``spark.checkpoint.dir``;
    only when nothing is configured (local tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="touchcredit-ckpt-")
    elif configured.startswith("file:") and not sc.master.startswith("local"):
        raise RuntimeError(f"spark.checkpoint.dir must be shared by the cluster, not {configured}")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
               bytes_per_shuffle_partition: int = 1 << 30,
               split_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of source data.

    The initial shuffle partition count gives about ``bytes_per_shuffle_partition``
    of input per reducer of the largest shuffle (touches, at most the input
    size after projection) and at least three waves of tasks; AQE coalesces
    small partitions to ``split_bytes`` and splits skewed ones at run time.
    Scan splits are ``split_bytes``, small enough for executor memory.
    """
    slots = max(1, executors * cores_per_executor)
    partitions = max(3 * slots, -(-input_bytes // bytes_per_shuffle_partition))
    return {
        **ENGINE_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * split_bytes),
    }
