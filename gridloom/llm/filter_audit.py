"""Audit of how document filters interact: what each removes, in every order in which they can be applied.

1. Each document's whole text is looked at once, and gives a mask with a bit for each filter that it fails.
2. Masks are crossed with the orders of the filters (120, broadcast), and each row's five steps are exploded.
3. A document leaves at the first step whose filter it fails.  Counts by part, order and step are conditional sums that
   each task combines before the shuffle, so that a part is a few hundred rows a task, however many documents it has.

The filters (words are runs of anything but ASCII white space, case counts): A under 100 words; B fewer than 80 distinct
words in 100; C more than 10 of A-Z in 100 code points; D one of # $ % & * | ; E a text that a smaller doc_id has too.

Defined cases: a null text is the empty one, and a null part (``lang``) the empty string; rows that repeat a doc_id are
documents of their own, and of equal texts none with the smallest doc_id fails E; a row without doc_id fails E for no
other row, and not itself, and has no labels; a doc_id labelled more than once has a label if any of its rows says 1;
texts of any length count whole; an empty table gives no part, so no row; other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut, hash128, join_hot

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10  # the last two in a hundred
CAPITALS, LATER_BYTES = bytes(range(ord("A"), ord("Z") + 1)), bytes(range(0x80, 0xC0))
SIGNS = re.compile(rb"[#$%&*|]")


def text_mask(text: bytes | None) -> int:
    """The bits of A to D (1, 2, 4, 8) for the filters that a UTF-8 text fails."""
    text = text or b""
    words = text.split()  # at ASCII white space
    n, size = len(words), len(text)
    points, capitals = len(text.translate(None, LATER_BYTES)), size - len(text.translate(None, CAPITALS))
    return (
        (n < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * n) << 1
        | (100 * capitals > MOST_CAPITALS * points) << 2
        | (SIGNS.search(text) is not None) << 3
    )


def masks(docs: DataFrame, part: str = "lang") -> DataFrame:
    """(doc_id, part, mask), a row a document: which of the five filters its text fails."""
    kind = dict(docs.dtypes)["doc_id"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([text_mask(t.as_py()) for t in batch.column(4)], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], found], ["doc_id", "part", "a", "b", "mask"])

    text = F.coalesce("text", F.lit(""))
    held = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), hash128(text).alias("h"), text.cast("binary").alias("text"))
    looked = cut(held.select("doc_id", "part", "h.a", "h.b", "text").mapInArrow(look, f"doc_id {kind}, part string, a bigint, b bigint, mask int"))
    firsts = cut(looked.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")))
    total = firsts.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return join_hot(looked, firsts, ["a", "b"], "copies", total).select("doc_id", "part", F.col("mask").bitwiseOR(F.shiftleft(again, 4)).alias("mask"))


def orders(docs: DataFrame) -> DataFrame:
    """(filter_order, bits): each order of the filters, with their bits in that order.  120 rows."""
    rows = [("".join(p), [1 << FILTERS.index(f) for f in p]) for p in permutations(FILTERS)]
    return docs.sparkSession.createDataFrame(rows, "filter_order string, bits array<int>")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)"""

    def said(label: str) -> Column:
        return F.coalesce(F.max((F.col(label) == 1).cast("int")), F.lit(0)).alias(label)

    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(said("quality"), said("toxic"))
    flags = masks(docs, part).join(known, "doc_id", "left").select("part", "mask", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("quality", "toxic")))

    crossed = flags.crossJoin(F.broadcast(orders(docs)))
    fails = [F.col("mask").bitwiseAND(F.get("bits", i)) != 0 for i in range(len(FILTERS))]
    first = F.coalesce(*(F.when(f, F.lit(i + 1)) for i, f in enumerate(fails)), F.lit(len(FILTERS) + 1))
    replayed = crossed.select("part", "filter_order", "mask", "quality", "toxic", first.alias("first"), F.posexplode("bits").alias("at", "bit"))

    def count(condition: Column) -> Column:
        return F.sum(condition.cast("long"))

    step = F.col("at") + 1
    gone, failed = F.col("first") == step, F.col("mask").bitwiseAND(F.col("bit")) != 0
    counted = replayed.groupBy("part", "filter_order", step.alias("step"), "bit").agg(
        count(F.col("first") > step).alias("kept"),
        count(gone).alias("removed"),
        count(failed & (F.col("first") < step)).alias("redundant"),
        count(F.col("mask") == F.col("bit")).alias("unique_fails"),
        count(gone & (F.col("quality") == 1)).alias("good_lost"),
        count(gone & (F.col("toxic") == 1)).alias("toxic_lost"),
    )
    counted = cut(counted)  # 600 rows a part
    return counted.join(counted.groupBy("part", "bit").agg(F.sum("removed").alias("shapley")), ["part", "bit"]).drop("bit")
