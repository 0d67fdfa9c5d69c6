"""Session helpers: scale-oriented defaults and a shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults chosen for a large cluster; local runs override shuffle partitions.
CLUSTER_CONF = {
    # AQE re-plans at runtime: coalesces small shuffle partitions, splits
    # skewed join partitions and turns joins into broadcast joins only when
    # the *measured* shuffle output of one side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Static broadcast only below 10 MB of estimated size (compressed on disk, several times
    # that in memory); AQE decides on measured sizes beyond it.
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "overround") -> SparkSession:
    """Create (or get) a session with the defaults above.

    ``master``/``shuffle_partitions`` are only for local runs and tests; on a
    cluster the submitter sets them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is a shared filesystem path set by the operator; a
    missing setting is an error there, since executors can't see a folder of
    the driver's machine.  Only a local master gets one under the system temp
    folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): use the conf value
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="overround-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory.

    Used for intermediate tables that cut lineage or land documents; never a
    machine-local temp folder.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/overround-{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side helpers can open the path."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["CLUSTER_CONF", "build_session", "ensure_checkpoint_dir", "scratch_path", "local_path"]
