"""Session settings the jobs rely on, and the shared folders they write work files to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SESSION_CONF = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


# What one shuffle partition should hold.
_PARTITION_BYTES = 256 * 1024 * 1024


def initial_partitions(input_bytes: int) -> int:
    """Shuffle partitions to start with for an input of that size; adaptive execution merges small ones."""
    return max(200, -(-input_bytes // _PARTITION_BYTES))


def build_session(
    app_name: str = "trendmill", master: str | None = None, conf: dict | None = None, input_bytes: int | None = None
) -> SparkSession:
    """A session with the settings the jobs rely on.

    ``input_bytes`` is the rough size of the largest table a job will shuffle. Spark's fixed default of
    200 partitions would give each task gigabytes of a large table.
    """
    sized = {}
    if input_bytes:
        sized["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions(input_bytes))
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **sized, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files below a folder, from their listing; 0 if there is none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        return files.load(path).agg(F.sum("length")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def planned_bytes(scan: DataFrame) -> int:
    """The size of the files that a scan of some partitions of a table opens; runs no job.

    ``scan`` has to filter on partition columns: Spark looks up the files of a whole table only when it reads it.
    """
    return int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of any store Spark reads and writes."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The size of a folder that exists, as its store tells it; runs no job, so for folders of small tables."""
    store, place = file_system(spark, path)
    return int(store.getContentSummary(place).getLength())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it; one that is not there is no error."""
    store, place = file_system(spark, path)
    store.delete(place, True)


def folder_names(spark: SparkSession, pattern: str) -> list[str]:
    """The full paths that match a glob pattern."""
    store, place = file_system(spark, pattern)
    return [str(found.getPath().toString()) for found in store.globStatus(place) or []]


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int):
    """Start the shuffles of a job with enough partitions for its input, never with fewer than the session has.

    Adaptive execution merges small partitions, but it does not add any for aggregates and windows.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    least = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(key, str(max(least, -(-input_bytes // _PARTITION_BYTES))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def settings(spark: SparkSession, **values: object):
    """Have some settings for a while; names are given with ``__`` for the dots."""
    wanted = {key.replace("__", "."): str(value) for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def byte_setting(spark: SparkSession, key: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


# Bytes of files that a task reads at once where it sorts the rows it reads.
SORTED_BYTES = 16 * 1024 * 1024


def small_scans(spark: SparkSession):
    """Let a task of a scan read SORTED_BYTES at most, for jobs that sort what a task reads before they shuffle it.

    Parquet of repetitive rows takes some thirty times its size when it is sorted, so a task with files of Spark's 128 MB
    would need gigabytes.
    """
    now = byte_setting(spark, "spark.sql.files.maxPartitionBytes")
    return settings(spark, spark__sql__files__maxPartitionBytes=min(now, SORTED_BYTES))


def use_job_settings(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else built.

    Dates are cut from timestamps in UTC, arithmetic overflow must raise instead of wrapping, and
    adaptive execution has to be there to split hot partitions.
    """
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled",
                "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(key, SESSION_CONF[key])
    return spark


def work_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a temporary folder, which is
    removed when Python exits. On a cluster a missing setting is an error, because a machine-local
    folder would be lost with its executor.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="trendmill-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


_local_folder: str | None = None


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written yet, below the shared folder."""
    return f"{work_folder(spark)}/trendmill-{label}-{uuid.uuid4().hex}"


def enable_checkpoints(spark: SparkSession) -> None:
    """Point ``checkpoint()`` at the shared folder unless the session already has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_folder(spark))
