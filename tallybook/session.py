"""Spark session helpers.

The library never creates its own cluster settings beyond sane defaults for
local runs: on a real cluster the session comes from the job launcher and is
passed in.  Two things are read from the session rather than assumed:

* ``spark.checkpoint.dir`` -- the shared folder used to cut lineage
  (``DataFrame.checkpoint``) and to stage export files.  Only when it is unset
  (local tests) is a scratch folder created.
* shuffle partitions / AQE -- left to the cluster configuration.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tallybook") -> SparkSession:
    """Session for tests and the local bench (``local[cores]``)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("TALLYBOOK_DRIVER_MEM", "8g")))
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    # results must not depend on the session zone; TALLYBOOK_TZ runs the
    # suite under another zone to show it
    builder = builder.config("spark.sql.session.timeZone", os.environ.get("TALLYBOOK_TZ", "UTC"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder
    and is used as is.  A machine-local scratch folder is created only when no
    folder is configured at all, which is the local-test case.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect: no driver-side context
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tallybook-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for staged exports)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])
