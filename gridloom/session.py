"""Where driver and executors share files, and cutting of lineage there."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or, on a local master, a folder of our own.

    A cluster without it is an error: a machine's own folder would lose data.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "gridloom-shared")
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """The same rows, kept in the shared folder: later steps neither recompute them nor lose them with an executor.

    ``spark.cleaner.referenceTracking.cleanCheckpoints`` makes Spark remove the files once nothing refers to them.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(df: DataFrame, *keys: str, each: int = 50_000, n: int | None = None) -> DataFrame:
    """The rows dealt by their keys to as many tasks as it takes for about ``each`` rows a task, cores at least.

    A number given like this is not coalesced, so what a task holds does not grow with the table.  It takes a count, if
    their number ``n`` is not known: for tables and checkpoints, not for steps that would be worked out twice.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-(df.count() if n is None else n) // each))
    return df.repartition(parts, *keys)


def deleted_at_exit(spark: SparkSession, path: str) -> str:
    """The path, which its file system removes when the application ends."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path
