"""Session creation and the shared folder for written tables.

Library code never invents a machine-local folder on a cluster: written
tables (silver, gold, dimensions) go under the folder the cluster names in
``spark.checkpoint.dir``.  Only a local-mode session (tests, bench) without
that setting gets a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def half_memory_mb(most: int = 16384) -> int:
    """Half of this machine's memory, for the heap of a local session."""
    return min(most, os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") // (2 << 20))


def local_session(cpus: int | str = "*", app: str = "actuaria", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf.setdefault("spark.driver.memory", os.environ.get("ACTUARIA_DRIVER_MEMORY", f"{half_memory_mb()}m"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever folder they run in."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; set one only for local sessions."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: a cluster run needs a shared folder for written tables"
        )
    folder = tempfile.mkdtemp(prefix="actuaria-ckpt-", dir=os.environ.get("ACTUARIA_SCRATCH", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder
