"""Session construction and the shared scratch/checkpoint location."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

_LOCK = threading.Lock()

# Settings every job in this package assumes; a cluster deployment sets the
# same keys in its own spark-defaults, these are the local/test defaults.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Truncate-and-load: an overwrite replaces the whole table.
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Remove reliable-checkpoint files once their RDD is no longer referenced
    # (the materialised layers are ordinary files and are not affected).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tierwise", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    if master.startswith("local"):
        # Keep the catalog's default location out of the cwd; a cluster has its own.
        conf.setdefault("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tierwise-warehouse-"))
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised layers.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system the
    cluster names); without it the call fails, since a folder of one machine
    can't be read by the others. Only a local master gets a private directory, once.
    """
    with _LOCK:
        return _shared_root(spark)


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext; the server owns the setting
        sc = None
    if sc is not None:
        root = root or sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        # SparkContext appends a per-application uuid directory; use its parent.
        return current.rstrip("/").rsplit("/", 1)[0]
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tierwise-ckpt-")
    sc.setCheckpointDir(local)
    return local


def application_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", None) or spark.sparkContext.applicationId


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under :func:`shared_root` (never reused)."""
    return os.path.join(shared_root(spark), "tierwise", *parts, uuid.uuid4().hex)
