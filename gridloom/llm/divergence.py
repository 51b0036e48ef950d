"""Audit of how far the sources of a language differ in their words, with a sketch that rules rare terms out first.

1. Every task counts, a language, in how many of its documents each term occurs, and adds that to a count-min sketch of
   CELLS counters in each of DEPTH rows.  Tasks' sketches are merged a block of counters at a time.  A counter only ever
   grows by what falls on it, so the least of a term's counters is never below its document frequency; counters stop at
   the frequency asked for, which is all that they are held against, so that one takes a byte.
2. The merged sketch (DEPTH x CELLS bytes, whatever the input) is broadcast, and terms that it shows to be too rare never
   leave the task that reads them.  The rest are summed by task, shuffled, and counted exactly, so that the sketch can't
   change a result; only those that reach the frequency are kept.
3. Two sources differ by the sum of |p - q| over all kept terms.  Terms that neither has all add the same.  So the sum is
   worked out from the terms that either has: a term only one has differs from the other's value for none, which depends
   on its count alone and so is summed over the counts that a source has; for terms that both have, a join on the term
   adds the difference between that and what is true.

Terms are runs of ASCII letters and of all characters above ASCII; A-Z are lower-cased.  p is the count's share of the
group's count, in thousand millionths after five are added to each term's, rounded down, plus one; all in whole numbers.

Defined cases: nulls in text, lang and source are empty strings; rows that repeat a doc_id are documents of their own; a
language without kept terms gives pairs with value 0 and no terms; a group without terms has p as its share of nothing; a
language's only source has no pairs; ties go to the smaller item by its bytes; texts of any length count whole; an empty
table gives an empty one; other columns play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.common import cut, n_shuffle

#: The sketch's rows and the counters in each; how many of these travel together.
DEPTH, CELLS, BLOCK = 4, 1 << 22, 1 << 16
#: A task hands on what it has counted once it holds so many terms.
MOST_TERMS = 400_000
ADDED, SCALE = 5, 1_000_000_000
#: Bytes of a term as they are, A-Z lower-cased, and blanks for all others.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(TERM_BYTES).split() if text else []


def cells_of(lang: str, terms: list[bytes], cells: int = CELLS) -> np.ndarray:
    """(DEPTH, len(terms)): each term's counter in each row of the sketch."""
    seed = xxhash.xxh64_intdigest(lang)
    h = np.fromiter((xxhash.xxh64_intdigest(t, seed) for t in terms), np.uint64, len(terms))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(k) * step) % np.uint64(cells) for k in range(DEPTH)]).astype(np.int64) + (np.arange(DEPTH) * cells)[:, None]


def _texts(docs: DataFrame) -> DataFrame:
    names = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))
    return docs.select(*names, F.col("text").cast("binary").alias("text"))


def sketch(docs: DataFrame, least: int, cells: int = CELLS, most_terms: int = MOST_TERMS) -> np.ndarray:
    """The merged count-min sketch of document frequencies by language, counters up to ``least``; ``cells`` a row, whole blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter[bytes]] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(2), strict=True):
                of = found.setdefault(lang.as_py(), Counter())
                held -= len(of)
                of.update(set(terms_of(text.as_py())))
                held += len(of)
                if held > most_terms:
                    yield _blocks(found, least, cells)
                    found, held = {}, 0
        yield _blocks(found, least, cells)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, np.zeros(BLOCK, np.int64)
        for batch in batches:
            for number, at, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != block:
                    if block is not None:
                        yield _merged(block, total, least)
                    block, total = number, np.zeros(BLOCK, np.int64)
                total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.uint8)  # a place stands there once
        if block is not None:
            yield _merged(block, total, least)

    blocks = _texts(docs).mapInArrow(count, "block int, at binary, n binary")
    dealt = blocks.repartition(n_shuffle(docs.sparkSession), "block").sortWithinPartitions("block")
    out = np.zeros(DEPTH * cells, np.uint8)
    for number, values in dealt.mapInArrow(merge, "block int, counters binary").collect():  # DEPTH x cells bytes in all
        out[number * BLOCK : (number + 1) * BLOCK] = np.frombuffer(values, np.uint8)
    return out


def _blocks(found: dict[str, Counter[bytes]], least: int, width: int) -> pa.RecordBatch:
    """A task's counters that are not 0, up to ``least``, by block: their places in it and values."""
    each = [(cells_of(lang, list(of), width).ravel(), np.tile(np.fromiter(of.values(), np.int64, len(of)), DEPTH)) for lang, of in found.items() if of]
    cells, n = (np.concatenate(x) for x in zip(*each, strict=True)) if each else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    cells, which = np.unique(cells, return_inverse=True)
    sums = np.minimum(np.bincount(which, n, len(cells)), least).astype(np.uint8)
    numbers, starts = np.unique(cells // BLOCK, return_index=True)
    parts = list(zip(starts, [*starts[1:], len(cells)], strict=True)) if len(cells) else []
    at = [(cells[a:b] % BLOCK).astype(np.uint16).tobytes() for a, b in parts]
    columns = [pa.array(numbers.astype(np.int32)), pa.array(at, pa.binary()), pa.array([sums[a:b].tobytes() for a, b in parts], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["block", "at", "n"])


def _merged(block: int, total: np.ndarray, least: int) -> pa.RecordBatch:
    counters = np.minimum(total, least).astype(np.uint8).tobytes()
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([counters], pa.binary())], ["block", "counters"])


def counts(docs: DataFrame, least: int = 30) -> DataFrame:
    """(lang, source, term, n): how often each term of at least ``least`` of a language's documents occurs in a source."""
    if not 0 < least < 256:
        raise ValueError("least must be from 1 to 255: counters are bytes")
    shared = docs.sparkSession.sparkContext.broadcast(sketch(docs, least))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter[bytes], Counter[bytes]]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*batch.columns, strict=True):
                n, in_docs = found.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                terms = terms_of(text.as_py())
                held -= len(n)
                n.update(terms)
                in_docs.update(set(terms))
                held += len(n)
                if held > MOST_TERMS:
                    yield from survivors(found)
                    found, held = {}, 0
        yield from survivors(found)

    def survivors(found: dict[tuple[str, str], tuple[Counter[bytes], Counter[bytes]]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, in_docs) in found.items():
            terms = list(n)
            possible = shared.value[cells_of(lang, terms)].min(0) >= least
            kept = [t for t, ok in zip(terms, possible, strict=True) if ok]
            columns = [pa.array(v, k) for v, k in (([lang] * len(kept), pa.string()), ([source] * len(kept), pa.string()), (kept, pa.binary()), ([n[t] for t in kept], pa.int64()), ([in_docs[t] for t in kept], pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    partial = _texts(docs).mapInArrow(count, "lang string, source string, term binary, n bigint, docs bigint")
    summed = cut(partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = summed.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least).select("lang", "term")
    return summed.drop("docs").join(kept, ["lang", "term"]).select("lang", "source", F.col("term").cast("string").alias("term"), "n")


def _p(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + ADDED) / (total + ADDED * size)), in whole numbers; NULL without terms."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + ADDED).cast("decimal(20,0)")
    return F.call_function("div", top, F.nullif((total + ADDED * size).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))) + 1


def audit(docs: DataFrame, least: int = 30, most: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from each other one, and its ``most`` own terms."""
    found = cut(counts(docs, least))
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    whole = cut(found.groupBy("lang", "term").agg(F.sum("n").alias("n")))
    langs = whole.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.count(F.lit(1)).alias("n_terms"))
    facts = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = F.lit(0).cast("long")
    facts = facts.select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("n_group", "n_terms", "size", "total")))
    facts = cut(facts.withColumn("none", F.coalesce(_p(zero, F.col("n_group"), F.col("size")), zero)))  # a row a source
    p = cut(found.join(facts.drop("n_terms", "total"), ["lang", "source"]).select("lang", "source", "term", "n", "none", _p(F.col("n"), F.col("n_group"), F.col("size")).alias("p")))

    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = _differences(facts, p).withColumn("rank", F.row_number().over(by_value))
    q = whole.join(langs, "lang").select("lang", "term", _p(F.col("n"), F.col("total"), F.col("size")).alias("q"))
    own = p.join(q, ["lang", "term"]).where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    own = own.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= most)
    return pairs.unionByName(own).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")


def _differences(facts: DataFrame, p: DataFrame) -> DataFrame:
    """(lang, source, part, item, value): each two sources' sum of |p - q| over all kept terms of their language."""
    other = facts.select("lang", F.col("source").alias("item"), F.col("none").alias("none_b"), F.col("n_terms").alias("terms_b"))
    two = facts.join(other, "lang").where(F.col("source") != F.col("item"))
    # what a source's terms add if the other has none of them: by the values that they take, which are few
    values = p.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"))
    alone = values.join(two.select("lang", "source", "item", "none_b"), ["lang", "source"])
    alone = alone.groupBy("lang", "source", "item").agg(F.sum(F.col("times") * F.abs(F.col("p") - F.col("none_b"))).alias("alone"))
    # and what is too much of that for terms that both have
    a, b = p.select("lang", "term", "source", "none", "p"), p.select("lang", "term", F.col("source").alias("item"), F.col("none").alias("none_b"), F.col("p").alias("p_b"))
    met = a.join(b, ["lang", "term"]).where(F.col("source") < F.col("item"))
    over = F.abs(F.col("p") - F.col("p_b")) - F.abs(F.col("p") - F.col("none_b")) - F.abs(F.col("none") - F.col("p_b"))
    met = met.groupBy("lang", "source", "item").agg(F.sum(over + F.abs(F.col("none") - F.col("none_b"))).alias("both"))
    met = met.unionByName(met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "both"))
    back = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("alone").alias("alone_b"))
    keys = ["lang", "source", "item"]
    joined = two.join(alone, keys, "left").join(back, keys, "left").join(met, keys, "left")
    rest = (F.col("size") - F.col("n_terms") - F.col("terms_b")) * F.abs(F.col("none") - F.col("none_b"))
    value = rest + sum(F.coalesce(c, F.lit(0)) for c in ("alone", "alone_b", "both"))
    return joined.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
