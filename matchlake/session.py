"""Session construction and the shared scratch location.

Cluster jobs cut lineage into the shared folder named by
``spark.checkpoint.dir``; without one they fail.  Only a local master creates
a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE measures the real size of a join side at runtime before it
    # broadcasts it, and falls back to a sort-merge join beyond this.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    # collect_list over bounded (<= 16 element) per-order lists: keep the
    # object hash map up to 16k groups per task before sorting (default 128)
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
}


#: Codec of the files that loads write and read again; smaller than Spark's default.
CODEC = "zstd"


def build_session(master: str | None = None, app: str = "matchlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
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


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only a
    local master, whose executors share the driver's disk, gets a folder of its
    own when neither is set; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    leaf = "/".join(parts) if parts else "scratch"
    return base.rstrip("/") + "/" + leaf + "-" + uuid.uuid4().hex[:12]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a shared target: the context's
    checkpoint dir, else ``spark.checkpoint.dir``, else (local master only) a
    temporary folder."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="matchlake-ckpt-")
    sc.setCheckpointDir(conf)
    return conf


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme for os-level checks in tests."""
    return p[5:] if p.startswith("file:") else p


@contextmanager
def small_splits(spark: SparkSession, size: str = "16m"):
    """Files are read in splits of at most ``size``, so that a task that widens and
    sorts the rows of its split holds little; the setting is put back afterwards."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


__all__ = ["CODEC", "small_splits", "build_session", "shared_dir", "ensure_checkpoint_dir", "local_path"]
