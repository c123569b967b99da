"""Spark session helpers.

Cluster settings (checkpoint folder, memory, executors) come from the
cluster's own configuration; this module only fills gaps for local runs.
"""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (event times are zone-less),
# AQE for runtime join / partition decisions, no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: The folder made for each local application that names none.
_LOCAL_FOLDERS: dict[str, str] = {}


def get_session(
    master: str | None = None,
    app_name: str = "machinewatch",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session; ``master`` only applies when no session exists yet."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable parts of ``BASE_CONF`` to an existing session."""
    for key, value in BASE_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    # Python workers started from another folder find this package where the driver has it.
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set one only if unset on a local master (tests).

    On a cluster a folder of the driver's machine would be another one on
    every executor, so there the setting is required.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured and sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not configured:
        if sc.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[sc.applicationId] = tempfile.mkdtemp(prefix="mw-ckpt-")
        configured = _LOCAL_FOLDERS[sc.applicationId]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "machinewatch", name)
