"""Listing of files to read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def wanted(paths: DataFrame, skip_dirs: Sequence[str] = (), skip_prefixes: Sequence[str] = ("~$",), extensions: Sequence[str] | None = (".xlsx", ".xls")) -> DataFrame:
    """(…, file, is_xls): the paths whose name and folders are not to be skipped and whose extension is asked for, in any case."""
    file = F.substring_index("path", "/", -1)
    out = paths.withColumn("file", file).withColumn("is_xls", F.lower("path").endswith(".xls"))
    for prefix in skip_prefixes:
        out = out.where(~F.col("file").startswith(prefix))
    if skip_dirs:
        out = out.where(~F.arrays_overlap(F.slice(F.split("path", "/"), 1, F.greatest(F.size(F.split("path", "/")) - 1, F.lit(0))), F.array(*map(F.lit, skip_dirs))))
    if extensions:
        out = out.where(F.concat(F.lit("."), F.lower(F.substring_index("file", ".", -1))).isin(*extensions))
    return out


def scan(spark: SparkSession, folder: str, **rules: object) -> DataFrame:
    """(path, length, modificationTime, content, file, is_xls) of the folder's files, subfolders too."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return wanted(found, **rules)
