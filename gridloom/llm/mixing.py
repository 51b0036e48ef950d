"""Mixing of sources to target weights, by weighted fair queueing.

Each source queues its documents in a pseudo-random order, up to ``max_epochs`` times over.  A document's virtual finish
time is its source's cumulative words divided by the source's weight; all queues are merged by it, and the merged
sequence is cut where its words reach the budget.  A source that runs dry leaves its share to the others, which is what
the targets (``min(level * weight, max_epochs * size)``) say too.

No window ever spans a source or the corpus: cumulative sums are taken in two levels (random buckets of a source, then
inside a bucket) and the merged sequence is cut in slices of virtual time, each of about the same number of words.

Defined cases: a null text has size 0; documents of size 0 are taken 0 times; a null source is a source, the last one;
rows that agree in doc_id, source and text are one entry of the queue and are taken alike; a row without doc_id queues
like any other; an empty table gives an empty table; other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.llm.common import HIDDEN, WORD, cut

#: About so many documents in a bucket of a source's queue, and entries in a slice of the merged sequence.
BUCKET, SLICE = 4_000, 50_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_epochs: int = 3, budget: float | None = None) -> DataFrame:
    """(source, n, source_size, weight, level, target, budget, all_n) from (source, n, source_size): one row a source, null last.

    ``level`` solves sum(min(level * weight, max_epochs * source_size)) = budget, which is all words if not given.
    The windows over all sources see one row a source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    drier = W.orderBy("dry", "rank").rowsBetween(W.unboundedPreceding, -1)
    rest = W.orderBy("dry", "rank").rowsBetween(W.currentRow, W.unboundedFollowing)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    limit = F.lit(max_epochs) * F.col("source_size")
    # if the drier sources run dry and the rest do not, the level is this; the first row where that holds has the largest
    level = (F.col("budget") - F.coalesce(F.sum(limit).over(drier), F.lit(0))) / F.sum("weight").over(rest)
    return (
        sizes.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight.cast("double"))
        .withColumn("dry", limit / F.col("weight"))
        .withColumn("budget", F.lit(float(budget)) if budget is not None else F.sum("source_size").over(every).cast("double"))
        .withColumn("all_n", F.sum("n").over(every))
        .withColumn("try", level)
        .withColumn("level", F.coalesce(F.max(F.when(F.col("try") <= F.col("dry"), F.col("try"))).over(every), F.max("dry").over(every)))
        .withColumn("target", F.least(F.col("level") * F.col("weight"), limit.cast("double")))
        .select("source", "n", "source_size", "weight", "level", "target", "budget", "all_n")
    )


def queue(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, source, mark, size, copies, u): the entries; u in [0, 1) is their place in the shuffled queue."""
    mark = F.xxhash64("text")
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "mark"), 11) / F.lit(float(1 << 53))
    return docs.select("doc_id", "source", mark.alias("mark"), n_words(F.col("text")).alias("size")).withColumn("u", u)


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_epochs: int = 3, budget: float | None = None, seed: int = 7) -> DataFrame:
    """(doc_id, source, mark, size, source_size, target, times), a row a document: how many times the mix takes it."""
    planned = plan(docs, weights, max_epochs, budget, seed)
    return planned.withColumn("copies", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).drop("copies")


def plan(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_epochs: int = 3, budget: float | None = None, seed: int = 7) -> DataFrame:
    """Like mix, but a row an entry, with its number of copies."""
    flat = cut(queue(docs.select("doc_id", "source", "text"), seed))
    entries = flat.groupBy("doc_id", "source", "mark", "size", "u").agg(F.count(F.lit(1)).alias("copies"))
    sizes = flat.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs, budget)
    t = targets.withColumnRenamed("source", "s")
    placed = entries.join(t, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    bucket = F.floor(F.col("u") * F.ceil(F.col("n") / BUCKET))
    placed = cut(placed.withColumn("bucket", bucket).withColumn("words", F.col("size") * F.col("copies")))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("source", "bucket").agg(F.sum("words").alias("words"))
        .select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    )
    inside = W.partitionBy("source", "bucket").orderBy("u", "doc_id", "mark", "size").rowsBetween(W.unboundedPreceding, 0)
    cumulative = (
        placed.withColumn("upto", F.sum("words").over(inside))
        .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .withColumn("upto", F.col("upto") + F.col("start"))
        .drop("s", "b", "start")
    )
    epochs = cumulative.select("*", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch")).where(F.col("words") > 0)
    # a document counts up to its middle, so that the cut rounds to the nearest document of a source, not down
    served = F.col("epoch") * F.col("source_size") + F.col("upto") - F.col("words") / 2
    epochs = epochs.withColumn("finish", served / F.col("weight"))
    taken = _first(epochs).groupBy("doc_id", "source", "mark", "size", "u").agg(F.count(F.lit(1)).alias("times"))
    key = ["doc_id", "source", "mark", "size", "u"]
    mine = placed.select(*key, "copies", "source_size", "target")
    other = taken.select(*(F.col(c).alias(f"t_{c}") for c in key), "times")
    same = [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in key]
    joined = mine.join(other, (same[0]) & same[1] & same[2] & same[3] & same[4], "left")
    return joined.select("doc_id", "source", "mark", "size", "copies", "source_size", "target", F.coalesce("times", F.lit(0)).alias("times"))


def _first(epochs: DataFrame) -> DataFrame:
    """The entries that come first by finish time, as long as their words sum up to the budget at most.

    Virtual time is cut in slices: between two of them every queue moves alike, so they hold about equally many words.
    Slices up to the one where the budget ends are taken whole, and only that one is put in order.
    """
    slices = F.greatest(F.lit(64), F.ceil(F.col("all_n") / SLICE))
    sliced = epochs.withColumn("slice", F.floor(F.col("finish") / F.col("level") * slices))
    upto = W.orderBy("slice").rowsBetween(W.unboundedPreceding, 0)  # one row a slice
    sums = sliced.groupBy("slice", "budget").agg(F.sum("words").alias("in_slice")).withColumn("after", F.sum("in_slice").over(upto))
    near = sums.withColumn("base", F.col("after") - F.col("in_slice")).where(F.col("base") < F.col("budget")).select(F.col("slice").alias("sl"), "base", "after")
    both = sliced.join(near, F.col("slice") == F.col("sl"))
    order = W.partitionBy("slice").orderBy("finish", F.col("source").asc_nulls_last(), "doc_id", "mark").rowsBetween(W.unboundedPreceding, 0)
    edge = both.where(F.col("after") > F.col("budget")).withColumn("run", F.sum("words").over(order) + F.col("base")).where(F.col("run") <= F.col("budget"))
    whole = both.where(F.col("after") <= F.col("budget"))
    key = ["doc_id", "source", "mark", "size", "u"]
    return whole.select(*key).unionByName(edge.select(*key))


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """``docs`` as the mix takes them: a row once for each time, not at all if it isn't taken."""
    taken = plan(docs, **options).where(F.col("times") > 0)
    mine = taken.select(*(F.col(c).alias(f"{HIDDEN}{c}") for c in ("doc_id", "source", "mark", "times")))
    marked = docs.withColumn(f"{HIDDEN}text", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col(f"{HIDDEN}doc_id")) & F.col("source").eqNullSafe(F.col(f"{HIDDEN}source")) & (F.col(f"{HIDDEN}text") == F.col(f"{HIDDEN}mark"))
    copies = F.explode(F.array_repeat(F.lit(0), F.col(f"{HIDDEN}times").cast("int"))).alias(f"{HIDDEN}copy")
    return marked.join(mine, same).select(*(F.col(f"`{c}`") for c in docs.columns), copies).drop(f"{HIDDEN}copy")
