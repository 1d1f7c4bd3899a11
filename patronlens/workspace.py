"""Intermediate tables in the cluster's shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

PARALLEL_ACTIONS = 4


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder below its warehouse; on a cluster a
    machine-local folder would be lost together with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    context.setCheckpointDir(f"{warehouse}/_scratch-{uuid.uuid4().hex}")
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that nobody else uses."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/patronlens/{spark.sparkContext.applicationId}"


def _hadoop_path(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as it knows it."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _hadoop_path(spark, path)
    return files.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right below ``path``; none if it does not exist."""
    files, target = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def content_length(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    files, target = _hadoop_path(spark, path)
    return files.getContentSummary(target).getLength()


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; whether there was one."""
    files, target = _hadoop_path(spark, path)
    return files.delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application staged, once no DataFrame needs it any more."""
    files, target = _hadoop_path(spark, _application_folder(spark))
    files.delete(target, True)


def stage_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``stage``, with the path, so that the caller can delete the table with
    ``delete_path`` once all that reads it has been written."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    Cuts lineage like ``checkpoint()`` but stays columnar, so that each later
    pass reads only the columns it uses. The files outlive lost executors.
    """
    return stage_at(df, label)[0]


def in_parallel[K, T](
    spark: SparkSession, tasks: Mapping[K, Callable[[], T]], threads: int = PARALLEL_ACTIONS
) -> dict[K, T]:
    """Run independent Spark actions side by side, so that one table's last few tasks do
    not leave the cluster idle. The first error is raised."""
    run = inheritable_thread_target(spark)(lambda task: task())
    with ThreadPool(max(1, min(len(tasks), threads))) as pool:
        return dict(zip(tasks, pool.map(run, tasks.values(), chunksize=1)))
