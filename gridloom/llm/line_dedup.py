"""Removal of lines that many documents repeat.

Lines are exploded, hashed (128 bits) and counted by distinct document; only hashes and positions travel, never the text.
A line over the threshold goes from every document but the largest ``doc_id`` that holds it: its positions are gathered by
document, and what stays is put together again in order.  Lines that very many documents hold are told to every task
(``join_hot``), so that no task gathers all their holders.

Defined cases: a null or empty text is one empty line; rows that repeat a ``doc_id`` are one document (each row loses
the same lines); a row without ``doc_id`` counts for no line and loses none; lines and texts of any length and number are
taken whole, and a document's work grows with its lines only; of equal holders the largest ``doc_id`` keeps the line, in
all its places there; an empty table gives an empty table; other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import ASCII_SPACE, HIDDEN, cut, join_hot

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GONE, ID, MARK = (f"{HIDDEN}{x}" for x in ("gone", "id", "mark"))


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space, with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(ASCII_SPACE)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, mark, pos, a, b): the lines with keys of at least ``min_chars`` code points; mark tells rows of one doc_id apart."""
    key = F.col("key")
    return (
        docs.where(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("mark"), _lines(F.coalesce("text", F.lit(""))).alias("lines"))  # once a text
        .select("doc", "mark", F.posexplode("lines").alias("pos", "line"))
        .select("doc", "mark", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length(key) >= min_chars)
        .select("doc", "mark", "pos", F.xxhash64(key).alias("a"), F.xxhash64(F.lit(0x5EED), key).alias("b"))
    )


def repeated_lines(lines: DataFrame, min_docs: int = 3) -> DataFrame:
    """(a, b, keeper, places): the hash of each line found in ``min_docs`` documents, the largest of them, and its number of places."""
    counted = lines.groupBy("a", "b").agg(F.count_distinct("doc").alias("n"), F.max("doc").alias("keeper"), F.count(F.lit(1)).alias("places"))
    return counted.where(F.col("n") >= min_docs).drop("n")


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, counts: bool = True) -> DataFrame:
    """``docs`` with ``text`` rewritten and, if asked for, columns ``n_lines`` and ``n_dropped`` (replaced if there)."""
    lines = cut(hashed_lines(docs, min_chars))
    keepers = cut(repeated_lines(lines, min_docs))
    total = keepers.agg(F.coalesce(F.sum("places"), F.lit(0))).first()[0]
    gone = (
        join_hot(lines, keepers, ["a", "b"], "places", total)
        .where(F.col("doc") != F.col("keeper"))
        .groupBy(F.col("doc").alias(ID), F.col("mark").alias(MARK))
        .agg(F.collect_set("pos").alias(GONE))  # of one document: no more than its lines
    )
    text = F.coalesce(F.col("text"), F.lit(""))

    def put_together(parts: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(GONE))  # by hash, in order
        return F.array_join(F.transform(places, lambda i: F.get(parts, i)), "\n")

    rest = [c for c in docs.columns if not (counts and c in ("n_lines", "n_dropped"))]
    joined = docs.select(*(F.col(f"`{c}`") for c in rest)).join(gone, (F.col("doc_id") == F.col(ID)) & (F.xxhash64("text") == F.col(MARK)), "left")
    if counts:
        joined = joined.withColumn("n_lines", (F.regexp_count(text, F.lit("\n")) + 1).cast("long"))
        joined = joined.withColumn("n_dropped", F.coalesce(F.size(GONE), F.lit(0)).cast("long"))
    kept = F.when(F.col(GONE).isNull(), text).otherwise(F.get(F.transform(F.array(_lines(text)), put_together), 0))  # one split a text
    return joined.withColumn("text", kept).drop(GONE, ID, MARK)
