"""Spark session helpers.

Everything in the library works on a session the caller owns; these helpers only
fill in settings the library depends on when the caller has not set them.
"""

from __future__ import annotations

import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings the merge plans rely on.  They are applied only where the cluster
# (spark-submit, spark-defaults.conf) or the caller has not set a value.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.scheduler.mode": "FAIR",  # datasets that run side by side share the executors
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a shuffled MB takes about 10 MB in the sorts of a merge task and a scanned
    # one about 30 MB in a partial aggregate, so a task's share stops growing here
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app_name: str = "snapmerge",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``extra`` and ``shuffle_partitions`` are explicit caller choices and always
    apply; :data:`DEFAULT_CONF` only fills keys nobody has set.
    """
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    active = SparkSession.getActiveSession()
    if active is not None:
        for k, v in DEFAULT_CONF.items():
            if k.startswith(("spark.sql.", "snapmerge.")) and active.conf.get(k, None) is None:
                active.conf.set(k, v)
        for k, v in explicit.items():
            active.conf.set(k, v)
        ensure_checkpoint_dir(active)
        return active
    cluster = SparkConf()  # picks up spark-submit / spark-defaults values
    builder = SparkSession.builder.appName(app_name)
    if master and not cluster.contains("spark.master"):
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        if not cluster.contains(k):
            builder = builder.config(k, v)
    for k, v in explicit.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only on a local master without the setting (tests) is a private temporary
    folder created and recorded in the session, so later calls agree on it; on
    a cluster executors would each write to a disk of their own, so it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="snapmerge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point ``SparkContext.setCheckpointDir`` at :func:`checkpoint_root`."""
    root = checkpoint_root(spark)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root + "/rdd")
    return root
