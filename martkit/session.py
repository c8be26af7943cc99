"""Session construction and the shared scratch location.

Library code never creates a session and never changes session settings it
does not own; these helpers are for entry points (CLI, bench, tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Core settings needed before the context starts (no web UI, no progress bar).
CORE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Core settings applied before the context starts, only where the cluster
# (spark-defaults, ``--conf``) has not set them: checkpoint files (shared
# partials, JDBC snapshots) are deleted once nothing references them.
CORE_DEFAULTS = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# SQL settings applied by ``build_session`` only where the cluster (spark-defaults,
# ``--conf``) has not set the key already.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from compressed-file-size estimates: a side is broadcast only
    # when a probe (operators.joins) or AQE's measured shuffle size proves it small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "martkit",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session: UI off, AQE on, estimate-based broadcast off.

    Explicit ``conf`` and ``shuffle_partitions`` always apply; ``SQL_DEFAULTS``
    fill in only keys the cluster configuration leaves unset.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    explicit = dict(conf or {})
    if shuffle_partitions is not None:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**CORE_CONF, **explicit}.items():
        builder = builder.config(key, value)
    cluster = SparkConf()  # spark-defaults and --conf, as spark-submit passes them
    for key, value in CORE_DEFAULTS.items():
        if key not in explicit and not cluster.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    configured = spark.sparkContext.getConf()
    for key, value in SQL_DEFAULTS.items():
        if key not in explicit and not configured.contains(key):
            spark.conf.set(key, value)
    if checkpoint_dir(spark):  # only jobs that checkpoint need one
        ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The reliable shared folder the cluster names, if any."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a local one only when none is set.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. A local temporary folder is chosen only for local sessions (tests,
    bench), where there is no other executor to lose it.
    """
    current = checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return spark.sparkContext.getCheckpointDir() or current
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster needs a shared folder for "
            "checkpoints and staged outputs"
        )
    local = tempfile.mkdtemp(prefix="martkit-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/martkit-scratch/{name}-{uuid.uuid4().hex}"


def env_secret(name: str | None) -> str | None:
    """Read a secret from the environment variable the caller names."""
    if not name:
        return None
    value = os.environ.get(name)
    if value is None:
        raise KeyError(f"environment variable {name!r} is not set")
    return value
