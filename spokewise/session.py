"""Spark session defaults and the shared work folder.

All file-producing jobs (stages, landing zones, snapshots, stream
checkpoints) live under the folder the cluster names in
``spark.checkpoint.dir``. On a cluster that folder must be shared
storage (HDFS / object store); we only pick a local one for local-mode
tests where the setting is absent.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Suggested settings for a large cluster (~100 TB inputs); the library never sets them itself.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "32000",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", app: str = "spokewise",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local builder used by tests, bench and tools (a cluster passes its own session)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - not a runtime conf on every deployment
            d = None
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    return d or None


def shared_dir(spark: SparkSession) -> str:
    """Return the shared work folder; set one only for local mode when unset."""
    d = _configured_checkpoint_dir(spark)
    if d:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="spokewise-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def new_workdir(spark: SparkSession, tag: str) -> str:
    """A fresh, never-reused folder under the shared work folder."""
    base = shared_dir(spark)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if base.startswith("file:"):
        # file:/x, file:///x -> /x (a leading // would read as a host name); the scheme stays where
        # a plain path would mean another file system
        plain = "/" + base[len("file:"):].lstrip("/")
        base = plain if conf.get("fs.defaultFS", "file:///").startswith("file:") else f"file://{plain}"
    path = f"{base}/spokewise/{tag}-{uuid.uuid4().hex[:12]}"
    if "://" not in path:
        # made on the file system that a plain path names, which need not be the driver's disk
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).mkdirs(p)
    return path
