"""The log of what has been loaded: skipping, upserts, summaries, and guards before a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t


def unprocessed(sheets: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sheets without a successful row in the log."""
    return sheets.join(log.where(F.col("status") == "SUCCESS").select(*keys).distinct(), list(keys), "left_anti")


def upserted(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key."""
    last = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("last", last).where(F.col("last") == 1).drop("last")


def summary(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def longest(df: DataFrame) -> DataFrame:
    """(column_name, longest, column_type): each column's longest value and the text type that holds it.  One pass."""
    most = df.agg(*(F.coalesce(F.max(F.length(F.col(f"`{c}`").cast("string"))), F.lit(0)).cast("long").alias(c) for c in df.columns))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("longest")) for c in df.columns))).alias("x")
    return most.select(pairs).select("x.column_name", "x.longest", t.column_type(F.col("x.longest")).alias("column_type"))


def guarded(n_columns: Column, n_rows: Column, most: int = 100) -> Column:
    """SKIP for a sheet that is too wide or empty."""
    return F.when((n_columns > most) | (n_rows == 0), "SKIP").otherwise("SUCCESS")


#: The log: a row a sub-table, keyed by path, sheet and sub-table.
LOG = {
    "id": "bigint", "table_name": "string", "source_path": "string", "source_filename": "string", "sheet_name": "string", "sheet_index": "int",
    "subtable_index": "int", "subtable_label": "string", "parse_strategy": "string", "agent": "string", "status": "string", "original_row_count": "int",
    "actual_row_count": "int", "column_count": "int", "column_names": "string", "table_description": "string", "error_message": "string",
    "file_size_bytes": "bigint", "is_xls": "boolean", "has_merged_cells": "boolean", "merged_cells_count": "int", "parse_time_ms": "int", "created_at": "timestamp",
}
LOG_KEY = ("source_path", "sheet_name", "subtable_index")


def completed(rows: DataFrame) -> DataFrame:
    """Rows with some of the log's columns as rows with all of them, of its types; what must not be missing has a default."""
    path = F.col("source_path") if "source_path" in rows.columns else F.lit("")
    default = {
        "id": F.xxhash64(*(F.col(c) if c in rows.columns else F.lit(0) for c in LOG_KEY)), "source_path": F.lit(""), "source_filename": F.substring_index(F.replace(path, F.lit("\\"), F.lit("/")), "/", -1),
        "subtable_index": F.lit(0), "parse_strategy": F.lit("UNKNOWN"), "status": F.lit("UNKNOWN"), "is_xls": F.lower(path).endswith(".xls"),
        "has_merged_cells": (F.col("merged_cells_count") > 0) if "merged_cells_count" in rows.columns else F.lit(False), "created_at": F.current_timestamp(),
    }
    null = F.lit(None)
    return rows.select(*(F.coalesce(F.col(c) if c in rows.columns else null, default.get(c, null)).cast(kind).alias(c) for c, kind in LOG.items()))


def merged_log(log: DataFrame | None, rows: DataFrame) -> DataFrame:
    """The log after a run: new rows take the place of those of their key.  Columns that an older log lacks are filled."""
    new = completed(rows).withColumn("new", F.lit(1))
    if log is None:
        return upserted(new, LOG_KEY, [F.desc("new")]).drop("new")
    return upserted(new.unionByName(completed(log).withColumn("new", F.lit(0))), LOG_KEY, [F.desc("new"), F.desc("created_at")]).drop("new")
