"""Cutting lineage with tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

_local_dirs: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may run without the setting: a folder of one machine is useless to the executors of a
    cluster, so there the missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tokenloom-")
    return _local_dirs[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Row groups of tables with arrays: a reader decodes thousands of rows at once, but never more than a group.
GROUP_ROWS, GROUP_BYTES = 128, 8 << 20


def group_options(schema: T.StructType) -> dict[str, str]:
    """Options for writing a Parquet table: arrays in small row groups, as their decoded rows may be long."""
    if not any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in schema.fields):
        return {}
    return {"parquet.block.row.count.limit": str(GROUP_ROWS), "parquet.block.size": str(GROUP_BYTES)}


#: Whether Spark removes the shuffle files of a query as it ends; otherwise they stay until the driver collects its garbage.
SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tasks that list folders; Spark's own figure is one for each folder up to 10,000, which takes longer to start than to list.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Tasks move their own files where the job puts them; otherwise the driver moves them one after the other.
MOVED_BY_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for what runs inside."""
    before = spark.conf.get(key) if key in spark.conf.getAll else None
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries that end inside leave no shuffle files behind: what they wrote is read from where it lies."""
    return setting(spark, SHUFFLES_REMOVED, "true")


def folders_listed(spark: SparkSession) -> AbstractContextManager[None]:
    """Readers made inside list many folders with a few tasks for each core."""
    return setting(spark, LISTING_TASKS, str(8 * spark.sparkContext.defaultParallelism))


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a scan of what was written.

    Parquet rather than ``checkpoint()``: the scan keeps column pruning and file sizes, and a lost executor costs a
    re-read instead of a recomputation. Values that depend on the physical layout (partition numbers, row numbers
    inside a partition) are frozen by the write.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.options(**group_options(df.schema)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_with(df: DataFrame, label: str, *aggregates: Column) -> tuple[DataFrame, dict]:
    """Write ``df`` once and return the scan and what the named ``aggregates`` over its rows came to during the write.

    The observed values are summed by the tasks that write, and the scheduler counts a task of the last stage once however
    often it ran, so a lost executor does not change them.
    """
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    written = staged(df.observe(seen, *aggregates), label)
    return written, seen.get
