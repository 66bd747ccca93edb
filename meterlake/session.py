"""Session setup and the shared scratch folder."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


# Settings for a large cluster (~100 TB of readings, ~1000 executors).  AQE
# can only merge shuffle partitions, never split them, so start with many and
# let it coalesce to the advisory size; size-first coalescing keeps tasks near
# that size instead of chasing parallelism; larger scan splits cut task count.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
}


def session_settings(profile: str = "local", shuffle_partitions: int | None = None,
                     extra: dict[str, str] | None = None) -> dict[str, str]:
    """Settings the package relies on (UTC, AQE, no UI), plus the profile's.

    ``profile="cluster"`` adds ``CLUSTER_CONF``; explicit arguments win.
    """
    if profile not in ("local", "cluster"):
        raise ValueError(f"unknown profile {profile!r}")
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    return conf


def get_session(master: str | None = None, app: str = "meterlake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None, profile: str = "local") -> SparkSession:
    """Session with ``session_settings(profile, shuffle_partitions, extra)``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in session_settings(profile, shuffle_partitions, extra).items():
        b = b.config(k, v)
    return configure(b.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC: readings are stored and bucketed in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Where none is named, a local session gets a private one; on a cluster
    that is an error, as every machine would write to a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="meterlake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/meterlake/{name}-{uuid.uuid4().hex[:12]}"


def staging_path(spark: SparkSession, kind: str, handle: str) -> str:
    """A staging folder for one run of a job on a dataset.

    Named by the database-qualified handle and a run id, so tables of the
    same name, or two sessions, never share one; the job deletes it.
    """
    if "/" not in handle and "." not in handle:
        handle = f"{spark.catalog.currentDatabase()}.{handle}"
    safe = re.sub(r"[^A-Za-z0-9_.-]", "_", handle)[-80:]
    digest = hashlib.sha1(handle.encode()).hexdigest()[:8]
    return f"{checkpoint_root(spark)}/meterlake/staging/{kind}-{safe}-{digest}-{uuid.uuid4().hex[:12]}"


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Set SQL confs for the duration of one write, then restore them.

    Used where a per-write option does not reach the planner (``insertInto``
    takes the partition-overwrite mode and codec from the session).
    """
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# Spark's default form of timestamps in Parquet has no statistics; this one
# has, so a time range skips row groups and pages.
TIME_CONF = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}

# Writes of partitioned layouts cost per file as much as per byte: keep small
# writes spread over the cores instead of letting AQE merge them into one
# task.  Large writes are unaffected (the advisory size governs there).
WRITE_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB", **TIME_CONF}


def write_conf(spark: SparkSession, extra: dict[str, str] | None = None):
    """``session_conf`` with the write settings (plus ``extra``)."""
    return session_conf(spark, {**WRITE_CONF, **(extra or {})})


def unique_table(name: str) -> str:
    """Unique managed-table name for jobs that must not collide."""
    return f"{name}_{uuid.uuid4().hex[:12]}"
