"""Session construction and the shared scratch folder.

Library code never creates its own session; tests, ``bench.py`` and the
command line call :func:`build_session`.  Everything that has to be written
(report files, sinks, lineage cuts) goes below :func:`scratch_root`, which is
the cluster's ``spark.checkpoint.dir`` when the cluster names one.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(cpus: int | None = None, master: str | None = None,
                  app: str = "evalpress", extra: dict | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(cpus))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("EVALPRESS_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(total_cores: int, shuffle_bytes_estimate: int | None = None) -> dict[str, str]:
    """Settings for a large cluster (e.g. 1000 executors reading ~100 TB).

    Shuffle partitions follow the larger of 3x the cores and the shuffle
    volume at ~200 MB per partition; AQE then coalesces small partitions and
    splits skewed ones (a key holding a third of the rows is split into
    advisory-size pieces on the join side).  Broadcasts stay behind the
    measured-size threshold.  ``spark.checkpoint.dir`` must be a shared folder
    (HDFS/S3-compatible) so lineage cuts survive lost executors.
    """
    parts = 3 * total_cores
    if shuffle_bytes_estimate:
        parts = max(parts, shuffle_bytes_estimate // (200 * 1024 * 1024))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written tables.

    The cluster's ``spark.checkpoint.dir`` wins.  Only when it is unset and
    the master is local (tests) is a private folder created and registered as
    checkpoint dir; a cluster without the setting is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder: executors do not see the driver's own")
    local = tempfile.mkdtemp(prefix="evalpress-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([scratch_root(spark), "evalpress", *parts])
