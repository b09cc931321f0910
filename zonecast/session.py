"""Session settings and reliable intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_stages: list[str] = []


def use_utc(spark: SparkSession) -> SparkSession:
    """All timestamps are naive UTC; truncation goes through the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Rows of a dozen numbers that a task can sort or group in a small part of an executor's memory.
ROWS_PER_TASK = 500_000


def partitions_for(spark: SparkSession, rows: int) -> int:
    """The session's shuffle partitions, or more when each would get over ``ROWS_PER_TASK`` rows."""
    return max(shuffle_partitions(spark), -(-rows // ROWS_PER_TASK))


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir`` or by ``setCheckpointDir``.  Only a local
    session without either uses a temporary folder; elsewhere executors would not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not is_local(spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = spark.conf.get("spark.zonecast.scratch", None)
    if not local:
        local = tempfile.mkdtemp(prefix="zonecast-")
        spark.conf.set("spark.zonecast.scratch", local)
    return local


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one, which :func:`clear_stages` removes."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _stages.append(path)
    return path


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage and shares work between several readers.  The files survive the
    loss of executors, and later scans still prune columns and push filters.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_stages(spark: SparkSession) -> int:
    """Deletes the intermediate tables this process stored; call it when their readers are done."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    count = len(_stages)
    while _stages:
        target = path(_stages.pop())
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return count


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files of finished queries go when the driver collects what refers to them; a long job asks for that between its steps."""
    gc.collect()
    spark._jvm.System.gc()


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path (or ``*`` pattern) exists on any Hadoop file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def publish(spark: SparkSession, staged: str, final: str) -> str:
    """Puts a checked table in its place, replacing an earlier one, without copying rows."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    source, target = path(staged), path(final)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    aside = path(f"{final.rstrip('/')}.old-{uuid.uuid4().hex}")
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"cannot move {final} aside")
    if not fs.rename(source, target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"cannot move {staged} to {final}")
    if had:
        fs.delete(aside, True)
    return final
