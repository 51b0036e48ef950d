"""Workbooks as they arrive: each batch is ingested, tables first and then the log, so that a batch that fails is tried again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from gridloom.operators import ingest_log
from gridloom.sources import files


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of a folder's workbooks."""
    fields = "path string, modificationTime timestamp, length bigint, content binary"
    found = spark.readStream.format("binaryFile").schema(fields).option("recursiveFileLookup", True).load(folder)
    return files.wanted(found, extensions=(".xlsx",))


def run(stream: DataFrame, checkpoint: str, log_path: str, load: Callable[[DataFrame], DataFrame]) -> DataStreamWriter:
    """load takes a batch of files and gives (path, status) rows once its tables are written; files logged as done are left out."""

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            log = spark.read.parquet(log_path)
            batch = ingest_log.unprocessed(batch, log, ["path"])
        except Exception as e:  # no log yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        load(batch).withColumn("batch", F.lit(number)).write.mode("append").parquet(log_path)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one)
