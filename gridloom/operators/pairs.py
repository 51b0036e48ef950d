"""Records that span several rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t
from gridloom.operators import predicates as p

#: Groups that the score of a span looks at: a sheet's layout shows in its first records.
SCORED_GROUPS = 24


def record_span_scores(rows: DataFrame) -> DataFrame:
    """(sheet, span, score): the share of the first groups of 2, 3 and 4 rows that are a main row and continuations."""
    n = rows.select("sheet", "row_idx", p.n_filled(F.col("cells")).alias("n"))
    every = n.select("*", F.explode(F.array(*map(F.lit, (2, 3, 4)))).alias("span")).withColumn("group", F.floor(F.col("row_idx") / F.col("span"))).where(F.col("group") < SCORED_GROUPS)
    off = F.pmod(F.col("row_idx"), F.col("span"))
    main = F.max(F.when(off == 0, F.col("n"))).over(W.partitionBy("sheet", "span", "group"))
    marked = every.withColumn("off", off).withColumn("main", main)
    cont = (F.col("off") > 0) & p.is_continuation(F.col("n"), F.col("main"))
    groups = marked.groupBy("sheet", "span", "group").agg(F.max("main").alias("main"), F.count_if(cont).alias("cont"))
    good = (F.col("main") >= 2) & (F.col("cont") == F.col("span") - 1)
    return groups.groupBy("sheet", "span").agg((F.count_if(good) / F.count(F.lit(1))).alias("score"))


def record_span(scores: DataFrame) -> DataFrame:
    """(sheet, span): the best score from 0.7 up, the smaller span of equals; else 2."""
    best = F.max_by("span", F.struct(F.col("score"), -F.col("span")))
    return scores.groupBy("sheet").agg(F.when(F.max("score") >= 0.7, best).otherwise(2).cast("int").alias("span"))


def fold(rows: DataFrame, span: int = 2, width: int = 3) -> DataFrame:
    """(sheet, rec, cells): main rows' cells, then each column's continuations joined by spaces; blank records go."""
    off = F.pmod(F.col("row_idx"), F.lit(span))
    keyed = rows.select("sheet", F.floor(F.col("row_idx") / span).alias("rec"), off.alias("off"), "cells")
    main = [F.coalesce(F.max(F.when(F.col("off") == 0, F.get("cells", F.lit(i)))), F.lit("")) for i in range(width)]
    rest = []
    for i in range(width):
        value = F.get("cells", F.lit(i))
        kept = F.collect_list(F.when((F.col("off") > 0) & ~t.blank(value), F.struct("off", value.alias("v"))))
        rest.append(F.array_join(F.transform(F.array_sort(kept), lambda x: x.v), " "))
    folded = keyed.groupBy("sheet", "rec").agg(F.array(*main, *rest).alias("cells"))
    return folded.where(~p.is_blank(F.col("cells")))


def with_record_span(rows: DataFrame) -> DataFrame:
    """Rows with their sheet's ``span``, told by windows: as record_span of record_span_scores."""
    w, whole = W.partitionBy("sheet").orderBy("row_idx"), W.partitionBy("sheet")
    row, n = F.col("row_idx"), F.col("n")
    marked = rows.withColumn("n", p.n_filled(F.col("cells")))
    marked = marked.select("*", F.lag("row_idx").over(w).alias("before"), *(F.lead(F.struct("row_idx", "n"), k).over(w).alias(f"next{k}") for k in (1, 2, 3)))
    scores = []
    for span in (2, 3, 4):
        group = F.floor(row / span)
        begins = F.col("before").isNull() | (F.floor(F.col("before") / span) < group)
        good = (F.pmod(row, F.lit(span)) == 0) & (n >= 2)
        for k in range(1, span):
            good = good & (F.col(f"next{k}.row_idx") == row + k) & p.is_continuation(F.col(f"next{k}.n"), n)
        scored = lambda c, group=group: F.sum(F.when((group < SCORED_GROUPS) & c, 1).otherwise(0)).over(whole)
        marked = marked.withColumn(f"good{span}", scored(good)).withColumn(f"groups{span}", scored(begins))
        scores.append(F.struct(F.coalesce(F.try_divide(f"good{span}", f"groups{span}"), F.lit(0.0)).alias("score"), F.lit(-span).alias("less")))
    best = F.array_max(F.array(*scores))
    span = F.when(best["score"] >= 0.7, -best["less"]).otherwise(2).cast("int")
    return marked.select(*rows.columns, span.alias("span"))


def records(rows: DataFrame) -> DataFrame:
    """(sheet, rec, names, main, rest) of rows with span and names: the main row's cells, and each column's continuations joined by spaces."""
    off = F.pmod(F.col("row_idx"), F.col("span")).alias("off")
    keyed = rows.select("sheet", F.floor(F.col("row_idx") / F.col("span")).alias("rec"), "names", F.struct(off, "cells").alias("r"))
    by = keyed.groupBy("sheet", "rec").agg(F.first("names").alias("names"), F.array_sort(F.collect_list("r")).alias("rs"))
    every = F.sequence(F.lit(0), F.size("names") - 1)
    main, rest = F.filter("rs", lambda r: r.off == 0), F.filter("rs", lambda r: r.off > 0)
    firsts = t.let(F.get(main, F.lit(0)).cells, lambda row: F.transform(every, lambda i: F.coalesce(F.get(row, i), F.lit(""))))
    others = t.let(rest, lambda x: F.transform(every, lambda i: F.array_join(F.filter(F.transform(x, lambda r: F.get(r.cells, i)), lambda v: ~t.blank(v)), " ")))
    return by.select("sheet", "rec", "names", firsts.alias("main"), others.alias("rest"))


def with_continuations(folded: DataFrame, groups: int = 20) -> DataFrame:
    """Records with ``more``: in ascending order the columns with content in the continuations of a sheet's first records."""
    held = F.when(F.col("rec") < groups, F.filter(F.transform("rest", lambda v, i: F.when(v != "", i)), lambda i: i.isNotNull()))
    return folded.withColumn("more", F.array_sort(F.array_distinct(F.flatten(F.collect_list(held).over(W.partitionBy("sheet"))))))


def continuation_columns(rows: DataFrame, span: int = 2, groups: int = 20) -> DataFrame:
    """(sheet, col_idx): columns with content in the continuation rows of the first groups."""
    part = rows.where((F.col("row_idx") < span * groups) & (F.pmod(F.col("row_idx"), F.lit(span)) > 0))
    return part.select("sheet", F.posexplode("cells").alias("col_idx", "value")).where(~t.blank(F.col("value"))).select("sheet", "col_idx").distinct()


def unique_after(names: Column, more: Column) -> Column:
    """The names and those that follow them, which get _2, _3 … where an earlier one is the same."""

    def add(out: Column, name: Column) -> Column:
        tries = F.transform(F.sequence(F.lit(2), F.size(out) + 2), lambda k: F.concat(name, F.lit("_"), k.cast("string")))
        return F.concat(out, F.array(F.when(F.array_contains(out, name), F.get(F.filter(tries, lambda x: ~F.array_contains(out, x)), F.lit(0))).otherwise(name)))

    return F.aggregate(more, names, add)
