"""Spark session helpers.

Everything in the library takes a ``SparkSession``; this module only builds a
local one for tests and the bench, and resolves the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "stratum",
    driver_memory: str = "8g",
) -> SparkSession:
    """Local session with the settings the library assumes (UTC, ANSI, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# SQL settings the library recommends on any session (runtime-settable).
RECOMMENDED_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_recommended_conf(spark: SparkSession) -> None:
    for key, value in RECOMMENDED_SQL_CONF.items():
        spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is.  Only when it is unset (local tests) a scratch folder is created.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        if not fallback and not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        current = fallback or tempfile.mkdtemp(prefix="stratum-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A folder below the shared checkpoint folder (never a machine-local tmp)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts]) if parts else base


def _is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def local_dir_exists(path: str) -> bool:
    return _is_local_path(path) and os.path.isdir(path.replace("file:", "", 1))
