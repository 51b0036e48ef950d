"""Regions of a sheet: columns and rows of their own tables, and which of them are worth keeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t
from gridloom.operators import ranges
from gridloom.operators import predicates as p


def trim_sides(rows: DataFrame, keys: tuple[str, ...] = ("sheet",)) -> DataFrame:
    """Cut to the columns from the first to the last that hold anything; (…, left): the first of them.  Blank regions go."""
    place, w = F.transform("cells", lambda c, i: F.when(~t.blank(c), i)), W.partitionBy(*keys)
    ends = rows.withColumn("left", F.min(F.array_min(place)).over(w)).withColumn("right", F.max(F.array_max(place)).over(w)).where(F.col("left").isNotNull())
    return ends.withColumn("cells", F.slice("cells", F.col("left") + 1, F.col("right") - F.col("left") + 1)).drop("right")


def regions_of_splits(splits: DataFrame, widths: DataFrame) -> DataFrame:
    """(sheet, sub_idx, start, end) from split columns (sheet, col_idx) and (sheet, width): a split column opens the region on its right."""
    edges = splits.select("sheet", "col_idx").unionByName(widths.select("sheet", F.lit(0).alias("col_idx"))).distinct()
    w = W.partitionBy("sheet").orderBy("col_idx")
    ends = edges.join(widths, "sheet").where(F.col("col_idx") < F.col("width"))
    return ends.select("sheet", (F.row_number().over(w) - 1).alias("sub_idx"), F.col("col_idx").alias("start"), (F.coalesce(F.lead("col_idx").over(w), F.col("width")) - 1).alias("end"))


def sliced(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """(sheet, sub_idx, row_idx, cells, …): each row's cells in each region of (sheet, sub_idx, start, end), end included."""
    cells = F.slice("cells", F.col("start") + 1, F.col("end") - F.col("start") + 1)
    return rows.join(regions, "sheet").withColumn("cells", cells).drop("start", "end")


def side_by_side(rows: DataFrame, split_cols: DataFrame | None = None, hints: DataFrame | None = None) -> DataFrame:
    """(sheet, sub_idx, label, start, end, hint, judged): the column regions of each sheet, by the first signal that it has.

    The signals, in this order: hints that say where a header is; split columns of borders, two or more regions; other
    hints; two or more blank columns before one with content, in four or more; a repeated header; nothing, one region.
    hint is a struct of the rows that a hint names, judged says that the region is a hint's own.  Where borders part a sheet,
    a hint lends its label and rows to the border region with which it has most columns in common.
    """
    facts = _columns(rows).join(ranges.repeated_header(rows.withColumn("row_idx", F.col("row_idx") - F.col("trim_start")) if "trim_start" in rows.columns else rows), "sheet", "left")
    width, wide = F.col("width"), F.col("width") >= 4
    kind = "struct<sub_idx: int, label: string, start: int, end: int, hint: struct<header_start: int, header_end: int, data_start: int>, judged: boolean>"

    def parted(splits: Column) -> Column:
        opened = t.let(F.array_sort(F.filter(F.array_union(splits, F.array(F.lit(0))), lambda c: c < width)), lambda x: F.transform(x, lambda c, k: F.struct(k.alias("k"), c.alias("c"), (F.coalesce(F.get(x, k + 1), width) - 1).alias("end"))))
        return F.transform(opened, lambda r: F.struct(r.k.alias("sub_idx"), F.concat(F.lit("p"), (r.k + 1).cast("string")).alias("label"), r.c.alias("start"), r.end.alias("end"), F.lit(None).cast("struct<header_start: int, header_end: int, data_start: int>").alias("hint"), F.lit(False).alias("judged")))

    def lent(region: Column) -> Column:
        """With the label and the rows of the hint that has most columns in common, the first of equals."""
        shared = F.transform("given", lambda g: F.struct((F.greatest(region.start, g.start) - F.least(region.end, g.end) - 1).alias("less"), F.struct(g.sub_idx.alias("sub_idx"), g.own_label.alias("label"), g.hint.alias("hint")).alias("of")))
        best = lambda b: F.struct(region.sub_idx.alias("sub_idx"), F.coalesce(b.of.label, region.label).alias("label"), region.start.alias("start"), region.end.alias("end"), F.coalesce(b.of.hint, region.hint).alias("hint"), region.judged.alias("judged"))
        return t.let(F.array_min(F.filter(shared, lambda x: x.less < 0)), best)

    signals = []
    if hints is not None:
        of = F.struct(*(F.col(c).cast("int").alias(c) for c in ("header_start", "header_end", "data_start")))
        told = F.coalesce("header_start", "header_end", "data_start").isNotNull()
        by = hints.groupBy("sheet").agg(F.collect_list(F.struct("sub_idx", "label", "col_start", "col_end", of.alias("hint"))).alias("given"), F.max(told).alias("told"))

        def placed(g: Column) -> Column:
            start = F.greatest(F.least(F.coalesce(g.col_start, F.lit(0)), width - 1), F.lit(0))
            end = F.greatest(F.least(F.coalesce(g.col_end, width - 1), width - 1), start)
            return F.struct(g.sub_idx.alias("sub_idx"), g.label.alias("own_label"), start.alias("start"), end.alias("end"), g.hint.alias("hint"))

        facts = facts.join(by, "sheet", "left").withColumn("given", F.transform("given", placed))
        named = lambda g: F.coalesce(g.own_label, F.concat(F.lit("p"), (g.sub_idx + 1).cast("string")))
        own = F.transform("given", lambda g: F.struct(g.sub_idx.alias("sub_idx"), named(g).alias("label"), g.start.alias("start"), g.end.alias("end"), g.hint.alias("hint"), F.lit(True).alias("judged")))
        signals.append(F.when(F.col("told"), own))
    if split_cols is not None:
        facts = facts.join(split_cols.groupBy("sheet").agg(F.collect_set(F.col("col_idx").cast("int")).alias("splits")), "sheet", "left")
        bordered = parted(F.col("splits"))
        signals.append(F.when(F.col("splits").isNotNull(), bordered if hints is None else F.when(F.col("given").isNotNull(), F.transform(bordered, lent)).otherwise(bordered)))
    if hints is not None:
        signals.append(F.when(~F.col("told"), own))
    signals.append(F.when(wide & (F.size("gaps") > 0), parted(F.col("gaps"))))
    signals.append(F.when(F.col("split_col").isNotNull(), parted(F.array("split_col"))))
    whole = F.struct(F.lit(0).alias("sub_idx"), F.lit("whole").alias("label"), F.lit(0).alias("start"), (width - 1).alias("end"), F.lit(None).cast("struct<header_start: int, header_end: int, data_start: int>").alias("hint"), F.lit(False).alias("judged"))
    found = F.coalesce(*(s.cast(f"array<{kind}>") for s in signals), F.array(whole).cast(f"array<{kind}>"))
    return facts.select("sheet", F.explode(found).alias("r")).select("sheet", "r.*")


def _columns(rows: DataFrame) -> DataFrame:
    """(sheet, width, gaps): a row a sheet that has cells; gaps: where two blank columns or more begin that one with content follows."""
    by = rows.select("sheet", F.posexplode("cells").alias("col_idx", "value")).groupBy("sheet", "col_idx").agg(F.count_if(t.blank(F.col("value"))).alias("blanks"), F.count(F.lit(1)).alias("n"))
    columns = by.groupBy("sheet").agg(F.sort_array(F.collect_list(F.struct("col_idx", "blanks", "n"))).alias("columns"))
    n = F.get("columns", F.lit(0)).n  # every row with cells has the first column
    full = F.transform(F.filter("columns", lambda c: c.blanks / n <= 0.8), lambda c: c.col_idx)
    begins = t.let(full, lambda x: F.transform(x, lambda c, k: F.struct(c.alias("c"), (F.when(k > 0, F.get(x, k - 1)).otherwise(-1) + 1).alias("begin"))))
    gaps = F.transform(F.filter(begins, lambda b: b.c - b.begin >= 2), lambda b: b.begin)
    return columns.select("sheet", F.size("columns").alias("width"), gaps.alias("gaps"))


def worth_keeping(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(sheet, sub_idx): sub-tables of two rows or more of which, beyond two columns, 30 % have a name of their own.

    names is (sheet, sub_idx, name), counts is (sheet, sub_idx, n_rows).
    """
    named = names.groupBy("sheet", "sub_idx").agg(F.count(F.lit(1)).alias("columns"), F.count_if(~F.col("name").rlike(r"^col_\d+$")).alias("own"))
    met = named.join(counts, ["sheet", "sub_idx"])
    return met.where((F.col("n_rows") >= 2) & ((F.col("columns") <= 2) | (F.col("own") >= 0.3 * F.col("columns")))).select("sheet", "sub_idx")


def without_blank_columns(cells: DataFrame, names: DataFrame) -> DataFrame:
    """Cells (sheet, row_idx, col_idx, value) less the columns that have no name (``col_<i>``) and hold nothing."""
    held = cells.groupBy("sheet", "col_idx").agg(F.count_if(~t.blank(F.col("value"))).alias("held"))
    gone = names.where(F.col("name").rlike(r"^col_\d+$")).join(held.where(F.col("held") == 0), ["sheet", "col_idx"]).select("sheet", "col_idx")
    return cells.join(gone, ["sheet", "col_idx"], "left_anti")


def subtable_totals(counts: DataFrame) -> DataFrame:
    """(sheet, n_subtables, n_rows) over all sub-tables of (sheet, sub_idx, n_rows)."""
    return counts.groupBy("sheet").agg(F.count(F.lit(1)).alias("n_subtables"), F.sum("n_rows").alias("n_rows"))


def begins_of_subtables(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """(sheet, split, data_start): after each split row, the first row that is no blank, footnote, title, header or category."""
    cells = F.col("cells")
    lone = p.n_filled(cells) == 1
    data = ~p.is_blank(cells) & ~p.is_footnote(cells) & ~p.is_title(cells) & ~lone & ~p.is_header_like(cells)
    # a split is a row of its own under the one it names, so that it counts where that one is missing or the sheet is NULL
    ends = splits.select("sheet", F.col("split").alias("row_idx"), F.lit(None).cast("boolean").alias("data"), F.col("split").alias("own"))
    marked = rows.select("sheet", "row_idx", data.alias("data"), F.lit(None).cast("int").alias("own")).unionByName(ends)
    w = W.partitionBy("sheet").orderBy("row_idx", F.col("own").isNotNull()).rowsBetween(W.unboundedPreceding, -1)
    held = marked.withColumn("split", F.last("own", ignorenulls=True).over(w)).where(F.col("own").isNull() & F.col("split").isNotNull())
    return held.groupBy("sheet", "split").agg(F.min(F.when(F.col("data"), F.col("row_idx"))).alias("data_start"))
