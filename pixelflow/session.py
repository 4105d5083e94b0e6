"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings for a large cluster (hundreds of executors, tens of TB per run):
# many initial shuffle partitions that AQE coalesces to ~256 MiB each, the
# same target for scan splits, and AQE skew handling.  Applied by
# get_session(master=None) unless the submitter already set a key.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def get_session(master: str | None = None, app: str = "pixelflow",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session configured for these jobs.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    :data:`CLUSTER_CONF` defaults are then applied where not already set.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    if not master:
        for k, v in CLUSTER_CONF.items():
            if k == "spark.sql.shuffle.partitions" and shuffle_partitions:
                continue
            if spark.sparkContext.getConf().get(k) is None:
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Reads the checkpoint folder from the session (``spark.checkpoint.dir``);
    only where it is unset on a local master (tests) is a private temporary
    folder created and registered.  On a cluster executors would write such a
    folder to their own disks, so there an unset folder is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    base = sc.getCheckpointDir() if sc is not None else None
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if sc is None or not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is not set")
        base = tempfile.mkdtemp(prefix="pixelflow-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return os.path.join(base.rstrip("/"), f"{name}-{uuid.uuid4().hex[:12]}")


def delete_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`shared_dir`."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
