"""Session helpers.

The library never creates a session of its own inside an operator: every
operator takes DataFrames (and, where it must write, the caller's session).
``local_session`` is for tests and the bench only.

``scratch_path`` is the one place that decides where intermediate files go.
On a cluster that is the shared folder named by ``spark.checkpoint.dir``;
only when that is unset (local tests) is a fresh local folder set up.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "keelson") -> SparkSession:
    """A local session configured the way tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("KEELSON_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and staged files.

    Taken from the session (``spark.checkpoint.dir`` or a directory already
    set on the context). Only a local-mode session with neither gets a fresh
    temporary folder; a cluster session without one is an error, because a
    machine-local folder is not visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="keelson-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage_parquet(df, name: str, partition_by: str | None = None):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: the lineage ends there, survives the loss of executors, and
    later reads prune columns and push filters down. The folder is the
    cluster's to clean (like any checkpoint)."""
    path = scratch_path(df.sparkSession, name)
    w = df.write
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return df.sparkSession.read.parquet(path)


def scale_conf(input_bytes: int, total_cores: int,
               partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Session settings sized for an input of ``input_bytes`` on a cluster
    with ``total_cores`` task slots.

    Scan splits and post-shuffle partitions target ``partition_bytes`` so a
    task's working set fits in executor memory; the initial shuffle width
    is at least two waves of tasks and at most one partition per target
    size, and AQE coalesces small partitions and splits skewed ones at run
    time. For 100 TB on 8,000 cores this gives about 400,000 initial
    shuffle partitions, coalesced by AQE to what the data needs.
    """
    width = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL settings on the caller's session."""
    for k, v in conf.items():
        spark.conf.set(k, v)
