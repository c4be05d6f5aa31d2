"""Session helpers: settings the library expects and the shared folder for
data that has to outlive an executor."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # call sites are looked up per column expression otherwise
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, **extra) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("freshet")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sizing(input_bytes: int, cores: int, partition_bytes: int = 192 << 20) -> dict[str, str]:
    """Settings for a job over ``input_bytes`` on ``cores`` cores.

    Shuffles start with partitions of about ``partition_bytes``, a size that
    sorts and aggregates in memory next to its neighbours on an executor, and
    at least two per core; AQE joins the ones that turn out small and splits
    the ones that turn out skewed.
    """
    partitions = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
    }


_OWN: dict[str, str] = {}  # application -> folder of a local session that names none
_SCRATCH: dict[str, list[str]] = {}  # application -> what was written for it below the shared folder


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, as the cluster names it.

    Only a local session without the setting gets a folder of its own; a
    cluster without one is refused, since a driver-local path would be
    invisible to the executors.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or _OWN.get(context.applicationId)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = _OWN[context.applicationId] = tempfile.mkdtemp(prefix="freshet-")
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder.  The session owns it: it goes with
    ``release_scratch``, and at the latest when the program ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    application = spark.sparkContext.applicationId
    if application not in _SCRATCH:
        atexit.register(_release_quietly, spark)
    owned = _SCRATCH.setdefault(application, [])
    owned.append(path)
    return path


def scratch_paths(spark: SparkSession) -> list[str]:
    """The intermediates that the session owns by now."""
    return list(_SCRATCH.get(spark.sparkContext.applicationId, []))


def release_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Deletes intermediates of this session, all or those in ``paths``;
    results that still read them have to be stored first."""
    owned = _SCRATCH.get(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    for name in owned[:] if paths is None else paths:
        path = hadoop(name)
        path.getFileSystem(configuration).delete(path, True)
        owned.remove(name)


def _release_quietly(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may have been stopped
        release_scratch(spark)


#: Has Spark delete the shuffle files of a query when it ends and not when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files: a job of several written
    steps then needs the disk of its largest step and not of all of them."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the files.

    Loops and plans that read one unrepeatable intermediate several times need
    this: a lost executor then costs a re-read instead of a replay.  The files
    are Parquet, so the planner knows their size (a small change set is
    broadcast) and reads only the columns it needs.
    """
    return written(df, "cut")[0]


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` as Parquet in the shared folder, and its path for ``release_scratch``."""
    path = scratch_path(df.sparkSession, label)
    with shuffles_released(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path), path
