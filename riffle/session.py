"""Spark session and shared settings.

The library never creates a session behind the user's back: operators take
DataFrames.  This module only helps tests, ``bench.py`` and the driver entry
points build a session with sane settings, and resolves the shared checkpoint
folder that jobs use to cut lineage.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session built here gets.  AQE re-plans joins and coalesces
# small shuffle partitions at run time; skew join splits hot partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Reliable checkpoints go to the shared folder; remove them once the
    # DataFrames that use them are gone, so the folder does not grow.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Lookup tables are broadcast explicitly (with a size check); keep the
    # automatic threshold at its default 10 MB so nothing large is broadcast.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "riffle", extra: dict | None = None) -> SparkSession:
    """Return a session with the library defaults (used by tests and bench)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is respected as
    is.  Only when it is unset and everything runs in one process (local
    mode, as in tests) a scratch folder is created; on a cluster the setting
    is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = configured or tempfile.mkdtemp(prefix="riffle-ckpt-")
    if not configured:
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001  (Spark Connect: the conf above is used)
        pass
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike ``localCheckpoint``); used where a plan
    would otherwise be recomputed many times.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Load one driver table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
