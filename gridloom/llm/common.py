"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from functools import reduce
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import cut, deleted_at_exit, shared_dir

#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: A word is a longest run of anything else.
WORD = "[^\\x20\\x09-\\x0D]+"
HIDDEN = "__gl_"
__all__ = ["ASCII_SPACE", "HIDDEN", "WORD", "cut", "doc_fold", "give_back", "hash128", "join_hot", "labelled_sample", "n_shuffle", "shared_dir", "shared_path", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, for files that last as long as the application."""
    return deleted_at_exit(spark, f"{shared_dir(spark).rstrip('/')}/gridloom-{name}-{uuid.uuid4().hex}")


def hash128(*cols: Column) -> Column:
    """Two 64-bit hashes with different seeds, as a struct of longs ``a`` and ``b``."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(0x5EED), *cols).alias("b"))


def join_hot(many: DataFrame, few: DataFrame, keys: list[str], weight: str, total: int, share: int = 10_000, least: int = 100) -> DataFrame:
    """An inner join on ``keys``, which name one row each in ``few``; its column ``weight`` tells how many rows of ``many`` a key has.

    Keys with more than a ``share``-th of ``total``, the sum of all weights, are fewer than ``share``: these are broadcast,
    so that a hot key's rows stay where they are.  The rest, none of them hot, meet by a shuffle.
    """
    hot = F.col(weight) > max(least, total // share)
    rest = few.where(~hot).drop(weight)
    if total <= least:
        return many.join(rest, keys)
    loud = few.where(hot).drop(weight)
    names = F.broadcast(loud.select(*keys))
    return many.join(F.broadcast(loud), keys).unionByName(many.join(names, keys, "left_anti").join(rest, keys))


def give_back() -> None:
    """Free memory of this process back to the system: a driver that has trained a model keeps none of what that took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not this C library
        ctypes.CDLL(None).malloc_trim(0)


def n_shuffle(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def doc_fold(modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``: the folds that hold labels out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


#: Characters that a training sample has in all, at most (a document that goes beyond is left out of it, not cut).
SAMPLE_CHARS = 64_000_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int], seed: int) -> pd.DataFrame:
    """The rows of ``labelled_rows`` on the driver, by doc_id."""
    return labelled_rows(docs, labels, label, most, seed).orderBy("doc_id", "label").toPandas()


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int], seed: int) -> DataFrame:
    """(doc_id, text, label): ``most[v]`` labelled documents of each label v, the first by a hash of the doc_id.

    Rows that repeat a doc_id count as one, the one with the least text hash.  So rows are bounded by ``most``, and
    characters by SAMPLE_CHARS.
    """
    order = F.xxhash64(F.lit(seed), "doc_id")
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(*most)).select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    some = [rows.where(F.col("label") == v).orderBy(order, "doc_id").limit(n) for v, n in most.items()]
    chosen = cut(reduce(DataFrame.unionByName, some))  # sum(most.values()) rows
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id")
    one = cut(texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), F.coalesce(F.length("text"), F.lit(0)).alias("size"), "text")).alias("t")))
    sizes = sorted((r[1], r[0]) for r in one.select("doc_id", "t.size").collect())  # two numbers a row of chosen
    fits = [i for (_, i), total in zip(sizes, accumulate(n for n, _ in sizes), strict=True) if total <= SAMPLE_CHARS]
    kept = one.select("doc_id", "t.text").where(F.col("doc_id").isin(fits) if len(fits) < len(sizes) else F.lit(True))
    return kept.join(chosen, "doc_id")
