"""Session helpers.

The library never creates its own cluster settings at import time. ``get_session`` is a convenience
for tests, the bench and local runs; on a cluster the caller passes its own ``SparkSession`` to every
operator.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on: UTC so timestamps agree with the SQL oracle, AQE so joins against
# tables whose size is only known at run time are re-planned (broadcast when the measured side is small,
# skew splits for sort-merge joins), and the Arrow path for the few pandas hand-offs.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "touchline") -> SparkSession:
    """Return the active session, or build a local one with the library defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    builder = builder.config("spark.driver.memory", os.environ.get("TOUCHLINE_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local master without one gets its own folder.

    Lineage is cut with ``DataFrame.checkpoint()`` into this shared folder, never with
    ``localCheckpoint`` (its blocks die with the executor that holds them). A cluster without the setting
    is refused: a folder on the driver's disk is not one that executors share.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {master}")
        configured = tempfile.mkdtemp(prefix="touchline-ckpt-", dir=os.environ.get("TOUCHLINE_SCRATCH"))
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and every executor share, for tables written between stages."""
    return ensure_checkpoint_dir(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back. This cuts the lineage as ``checkpoint()`` does and keeps columns
    apart, so that a fit over a few of them reads only those and no row is decoded as an object."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows_each: int | None = None) -> DataFrame:
    """``df`` dealt evenly over all cores, before costly work a row: a file of one row group is one task otherwise,
    and adaptive coalescing sizes tasks by bytes, not by work. With ``rows_each`` (``df`` is counted) in no more tasks
    than give each that many rows."""
    spark = df.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(min(tasks, max(1, -(-df.count() // rows_each))) if rows_each else tasks)


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 * 1024 * 1024,
                 rows_per_task: int = 4_000_000) -> dict[str, str]:
    """Settings for a cluster run, sized from the input volume.

    * file splits and post-shuffle partitions aim at ``partition_bytes`` (AQE coalesces small ones and
      splits skewed join partitions above 2x that size);
    * the shuffle partition count starts at input / partition size (at least 2 per core) so the widest
      stage never holds more than one split per task;
    * broadcast joins are left to AQE's runtime sizes, capped at 64 MB;
    * ``touchline.skew.rowsPerTask`` is the entity size above which windows split a key.
    """
    parts = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        "touchline.skew.rowsPerTask": str(rows_per_task),
    }
