"""Session settings and the shared folder that jobs may write scratch data to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_MADE: list[str] = []


def build_session(app_name: str = "tidemill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings every job here relies on.

    Partition counts are left to AQE: the initial number is generous on a cluster and coalesced
    at run time, so only local runs pass their own ``spark.sql.shuffle.partitions``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**PINNED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Settings that change results: the zone times are read in, and whether a JSON object that repeats a
# key is refused or its last value taken.
PINNED = {"spark.sql.session.timeZone": "UTC", "spark.sql.variant.allowDuplicateKeys": "true"}


def pin_settings(spark: SparkSession) -> SparkSession:
    """Set what results depend on in a session somebody else has built."""
    for key, value in PINNED.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a machine-local path
    would lose data with the machine, so that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tidemill-checkpoint-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created until something writes to it."""
    path = f"{shared_root(spark)}/tidemill/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def scratch_made() -> list[str]:
    """All paths that :func:`scratch_path` gave in this process, oldest first."""
    return list(_MADE)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of our own in any file system that Spark writes to; a missing one is fine."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
