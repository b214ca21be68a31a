"""Session construction and the few session-level helpers the jobs need."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings every job assumes: UTC wall clock, ANSI arithmetic, adaptive execution with
# runtime broadcast conversion and skew-join splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark's own size check decides broadcasts: a side is broadcast only when its
    # (runtime) size is below this bound, otherwise the join stays a sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
}


_SCRATCH: dict[str, list[str]] = {}

#: Sides (as stored) that runs over the whole fleet broadcast at most: a side takes ten to
#: twenty times that in memory, and such a run has some sixty joins.
FLEET_BROADCAST = 1 << 20
BROADCAST_CONF = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def build_session(app: str = "fleetwarden", cpus: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the cluster's builder."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("FLEETWARDEN_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All time logic is written for the UTC wall clock (timestamps are TIMESTAMP_NTZ)."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def small_broadcasts(spark: SparkSession, limit: int = FLEET_BROADCAST):
    """Plans made and run inside broadcast no side above ``limit`` bytes; what they send to
    the driver then stops growing with the fleet. The session's settings come back after."""
    given = {k: spark.conf.get(k, None) for k in BROADCAST_CONF}
    for k in BROADCAST_CONF:
        spark.conf.set(k, str(limit))
    try:
        yield
    finally:
        for k, v in given.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """What the ``jobs`` return. They need nothing of each other, so they run at the same
    time, each in its own thread: one's tasks fill the cores that another's last tasks, planning
    and commits leave idle."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediates.

    Read from ``spark.checkpoint.dir``. Only a local-mode session without the setting
    (tests, the bench) gets a fresh folder under the system temp dir; a cluster session
    without it is an error, because a machine-local folder would not survive executor loss.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        d = tempfile.mkdtemp(prefix="fleetwarden-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared folder (stream sinks, stream checkpoints)."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def apply_conf(spark: SparkSession) -> SparkSession:
    """The SQL settings of ``BASE_CONF`` on a session that a cluster built, as far as its
    submitter left them open."""
    given = dict(spark.sparkContext.getConf().getAll())
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql.") and k not in given:
            spark.conf.set(k, v)
    return spark


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its own file system (any that Spark can read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder; none if it is not there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there, in its own file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet into the shared folder and read back. Unlike a checkpoint,
    its true size is then known to the optimiser, which decides broadcasts by it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_folders(spark: SparkSession) -> list[str]:
    """The intermediate folders that this session has written so far."""
    return list(_SCRATCH.get(spark.sparkContext.applicationId, []))


def clear_scratch(spark: SparkSession, keep: tuple[str, ...] = (), but: list[str] | None = None) -> None:
    """Deletes the intermediate folders that this session wrote under the shared folder, but
    for those whose names start with one of ``keep`` and those in ``but``; results that
    still read them must have been written before."""
    app, spared = spark.sparkContext.applicationId, set(but or ())
    paths = _SCRATCH.pop(app, [])
    _SCRATCH[app] = [p for p in paths if os.path.basename(p).startswith(keep) or p in spared]
    for path in set(paths) - set(_SCRATCH[app]):
        delete_path(spark, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never localCheckpoint): a lost executor
    then costs a re-read of the checkpoint, not a replay of the whole plan."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
