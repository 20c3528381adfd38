"""Session defaults and the shared scratch folder.

Intermediate files (key allocation checkpoints, fixtures that round-trip
through files, published warehouse versions in examples) go below the
cluster's ``spark.checkpoint.dir``, never to a machine-local folder. Only a
session whose master is local gets a folder of its own when none is set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "starload", extra=None) -> SparkSession:
    """A session on the cluster it was submitted to; master and shuffle
    partitions are set only where the caller names them."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Where none is configured, a session on a local master gets a new folder; on
    any other master that is an error, as executors would not see it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: use the configured folder
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir must be set for a remote session") from None
        return conf_dir
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {sc.master}")
        conf_dir = tempfile.mkdtemp(prefix="starload-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/starload-scratch/{name}-{uuid.uuid4().hex[:12]}"
