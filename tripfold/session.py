"""Session construction and shared-storage helpers.

No master is hard-coded: on a cluster `spark-submit` decides it.  Settings
that the cluster already made (checkpoint folder, shuffle width) are read
from the session and never overridden.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a large cluster, applied only where the cluster's own
# configuration (spark-submit / spark-defaults) leaves a key unset.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffles here carry partial aggregates (bounded by key domain × map
    # tasks), except a row-level join to an over-bound dimension; the shuffle
    # width is the cluster's setting (AQE coalesces it to ~128 MB reads).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # Trip scans are pruned to a handful of columns, so 256 MB splits keep
    # the task count sane at 100 TB without making tasks heavy.
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}

# Our own policy for every job: no web UI server.
STATIC_SETTINGS = {"spark.ui.enabled": "false"}


def build_session(app_name: str = "tripfold", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    ``master`` is only for tests and local runs; leave it ``None`` under
    ``spark-submit``.  ``conf`` entries are set explicitly; the defaults
    above fill only keys the cluster did not configure.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    defaults = dict(CLUSTER_DEFAULTS)
    if spark.sparkContext.master.startswith("local"):
        # one JVM: as many shuffle partitions as cores
        defaults["spark.sql.shuffle.partitions"] = str(spark.sparkContext.defaultParallelism)
    already = spark.conf.getAll  # set at launch or at run time
    for key, value in defaults.items():
        if key not in already:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/…)
    and is used as is; without it a cluster job is refused.  Only on a local
    master, where all executors share the machine, is a scratch folder made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tripfold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts]) if parts else base


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique table location under the shared folder."""
    return shared_path(spark, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
