"""Session construction and the shared scratch location.

Scratch data (checkpoints, landing files, table snapshots written by the
example queries) lives under ``spark.checkpoint.dir``: on a cluster that is a
shared folder the operator configures, so it is read from the session.  Only a
session in one process (``local[...]``: tests, single-node runs) may leave it unset and
gets a private folder, deleted at exit; on a cluster an unset folder is an error,
because executors could not share a local one.
"""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files of frames that are no longer referenced are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "inkwell", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators rely on.

    UTC session time zone and ANSI mode are required for the exact date and
    ``try_*`` semantics; AQE is on so joins and skew are re-planned at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Session settings every operator assumes (safe to call on any session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder (see the module docstring)."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or None
        if not root:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="inkwell-ckpt-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one job's written tables.

    It is created through Hadoop's file system, so it may lie in any store.  It
    stays until ``drop_scratch``, because results are read from it lazily.
    """
    path = f"{checkpoint_root(spark).rstrip('/')}/inkwell/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    return path


_SCRATCH: list[str] = []


def drop_scratch(spark: SparkSession, path: str | None = None) -> int:
    """Delete the scratch folders this process has made, or the one given; call it once their results are used."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [p for p in _SCRATCH if path in (None, p)]
    for p in paths:
        _SCRATCH.remove(p)
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        folder.getFileSystem(conf).delete(folder, True)
    return len(paths)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of the jobs inside are deleted when each job ends, not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
