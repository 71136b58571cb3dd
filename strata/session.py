"""Session construction and shared-storage scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every strata job relies on. Hour buckets and dates are defined in
# UTC, so the session time zone is pinned rather than left to the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    app_name: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the strata defaults.

    ``master`` is left unset on a cluster, where spark-submit provides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session time zone to UTC (hour and date keys depend on it)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        return None


def session_key(spark: SparkSession) -> str:
    """Identity of the application behind a session (for per-run caches)."""
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.client.session_id


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", None) or spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables and stream checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (or set
    with ``SparkContext.setCheckpointDir``); without it, a cluster session
    raises. Only a ``local`` master with neither set, as in tests, gets a
    temporary folder created and registered.
    """
    sc = _context(spark)
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    else:  # a machine-local folder is not visible to other executors
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), "strata", f"{name}-{uuid.uuid4().hex[:12]}")
