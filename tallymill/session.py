"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A shuffle added by a skew split costs less than one task holding a hot key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # HotSpot never compiles a method above 8,000 bytes; steps that would need one are not fused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task writes up to so many partition folders side by side; more are sorted first, which takes
    # memory by the task's rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_LOCAL_WORK: dict[str, str] = {}
_SCOPE: ContextVar[str] = ContextVar("work_scope", default="shared")


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings the plans count on; leaves sizing settings alone."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(
    app_name: str = "tallymill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above. Without ``master``, spark-submit decides."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in {**RUNTIME_SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local master may go
    without: one process sees its own disk, a cluster's executors do not share theirs.
    """
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if shared:
        return shared.rstrip("/") + "/tallymill"
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    if app not in _LOCAL_WORK:
        _LOCAL_WORK[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_WORK[app]


def new_work_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{work_folder(spark)}/{app}/{_SCOPE.get()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def work_scope(spark: SparkSession, name: str) -> Iterator[None]:
    """Intermediate tables written inside are dropped at the end; nothing lazy may outlive it.

    Outside a scope, frames handed to the caller still read theirs, so they stay until the
    shared folder's own clean-up.
    """
    token = _SCOPE.set(f"{name}-{uuid.uuid4().hex}")
    path = f"{work_folder(spark)}/{spark.sparkContext.applicationId}/{_SCOPE.get()}"
    try:
        yield
    finally:
        _SCOPE.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def settle(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared work folder and return a scan of what was written.

    Cuts lineage in a way that survives lost executors, gives the planner an exact size (so a
    small table is broadcast by the planner's own threshold and a big one is not), and puts a
    plain scan under the next join, which is the shape AQE can split hot keys in. A join right
    on top of an aggregate by the same key reuses that aggregate's shuffle and cannot be split.
    """
    spark = df.sparkSession
    path = new_work_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_own_folders(df: DataFrame, path: str, *by: str, file_format: str = "parquet", **options) -> None:
    """Write partition folders that no other writer writes, beside what a table holds.

    Replacing just these folders repeats safely, and unlike an append it keeps its unfinished
    files apart from those of other jobs that write to the same table at the same time.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**options).partitionBy(*by).format(file_format).save(path)


def in_parallel(spark: SparkSession, *calls: Callable) -> list:
    """Run calls that start Spark jobs side by side, so that one's tail does not idle the cluster.

    All calls end before the first error, if any, is raised.
    """
    with ThreadPoolExecutor(max_workers=len(calls)) as pool:
        running = [
            pool.submit(copy_context().run, inheritable_thread_target(spark)(call))
            for call in calls
        ]
    return [call.result() for call in running]
