"""Row ranges of sheets: footnotes, data start, headers, splits and column islands, as windows and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t
from gridloom.operators import layout
from gridloom.operators import predicates as p


def sheet_window() -> W:
    return W.partitionBy("sheet").orderBy("row_idx")


def next_filled(rows: DataFrame) -> DataFrame:
    """With next_filled: the first row from this one on that is not blank."""
    ahead = W.partitionBy("sheet").orderBy(F.desc("row_idx")).rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.withColumn("next_filled", F.min(F.when(~p.is_blank(F.col("cells")), F.col("row_idx"))).over(ahead))


def truncate_footnotes(rows: DataFrame) -> DataFrame:
    """Without the last run of footnotes and blank rows, if a footnote is in it."""
    cells = F.col("cells")
    ends = rows.groupBy("sheet").agg(
        F.max(F.when(~p.is_blank(cells) & ~p.is_footnote(cells), F.col("row_idx"))).alias("content"),
        F.max(F.when(p.is_footnote(cells), F.col("row_idx"))).alias("note"),
    )
    has_note = F.col("note").isNotNull() & (F.col("content").isNull() | (F.col("note") > F.col("content")))
    return rows.join(ends, "sheet").where(~has_note | (F.col("row_idx") <= F.col("content"))).drop("content", "note")


def stop_at_footnote(rows: DataFrame) -> DataFrame:
    """Up to, not including, the first footnote."""
    seen = F.sum(p.is_footnote(F.col("cells")).cast("int")).over(sheet_window().rowsBetween(W.unboundedPreceding, W.currentRow))
    return rows.withColumn("seen", seen).where(F.col("seen") == 0).drop("seen")


def data_start(rows: DataFrame) -> DataFrame:
    """(sheet, data_start): the first data row; else the first ordinal category or row with a number; else -1."""
    data, other = layout.data_start(F.col("cells"))
    first, second = F.min(F.when(data, F.col("row_idx"))), F.min(F.when(other, F.col("row_idx")))
    return rows.groupBy("sheet").agg(F.coalesce(first, second, F.lit(-1)).cast("int").alias("data_start"))


def header_start_from_end(rows: DataFrame, header_end: DataFrame) -> DataFrame:
    """(sheet, header_end, header_start): up from header_end to the nearest lone long text that is no supplement."""
    cells, row = F.col("cells"), F.col("row_idx")
    above = rows.join(header_end, "sheet").where(row <= F.col("header_end"))
    lone = (p.n_filled(cells) == 1) & (F.length(p.first_filled(cells)) > 4) & ~t.is_header_supplement(p.first_filled(cells))
    marked = above.select("sheet", "row_idx", "header_end", lone.alias("stop"), (~p.is_blank(cells) & ~p.is_title(cells)).alias("keep"))
    stops = F.max(F.when(F.col("stop"), row)).over(W.partitionBy("sheet"))
    kept = F.min(F.when(F.col("keep") & (row > F.coalesce(F.col("at"), F.lit(-1))), row))
    return marked.withColumn("at", stops).groupBy("sheet", "header_end").agg(F.coalesce(kept, F.col("header_end")).alias("header_start"))


def header_range(rows: DataFrame) -> DataFrame:
    """(sheet, header_start, header_end): as layout.with_header_range tells each row."""
    told = layout.with_header_range(layout.with_data_start(rows))
    return told.groupBy("sheet").agg(F.min("header_start").alias("header_start"), F.min("header_end").alias("header_end"))


def repeated_header(rows: DataFrame, widest: int = 12) -> DataFrame:
    """(sheet, split_col): where the densest of the first five rows says its own beginning again, at least 70 % of it."""
    cells = F.col("cells")
    first = rows.where(F.col("row_idx") < 5).groupBy("sheet").agg(F.max_by("cells", F.struct(p.n_filled(cells), -F.col("row_idx"))).alias("cells"))
    first = first.where((F.size("cells") >= 6) & (p.n_filled(cells) >= 4))
    same = lambda n: F.size(F.filter(F.zip_with(F.slice(cells, 1, n), F.slice(cells, n + 1, n), lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x))
    hits = F.coalesce(*(F.when((F.size(cells) >= 2 * n) & (same(n) >= 0.7 * n), F.lit(n)) for n in range(2, widest + 1)))
    return first.select("sheet", hits.alias("split_col")).where(F.col("split_col").isNotNull())


def retreat_header(rows: DataFrame, header_end: DataFrame) -> DataFrame:
    """(sheet, header_end): one row less where that row holds two, and 30 %, data numbers after its first cell."""
    at = rows.select("sheet", F.col("row_idx").alias("header_end"), layout.numbers_in(F.col("cells")).alias("data"))
    return header_end.join(at, ["sheet", "header_end"], "left").select("sheet", F.when(F.col("data") & (F.col("header_end") > 0), F.col("header_end") - 1).otherwise(F.col("header_end")).alias("header_end"))


def vertical_splits(rows: DataFrame) -> DataFrame:
    """(sheet, split): the first blank row before each further table of a sheet.

    A run of blank rows splits if the next content is header-like, or a lone title followed by header-like content.
    Blank rows between such a title and its header belong to the table that has begun.
    """
    cells, row = F.col("cells"), F.col("row_idx")
    flags = rows.select(
        "sheet", "row_idx", p.is_blank(cells).alias("blank"), p.is_footnote(cells).alias("note"),
        ((p.n_filled(cells) == 1) & ~p.is_footnote(cells)).alias("lone"), (p.is_header_like(cells) & (p.n_filled(cells) > 1)).alias("header"),
    )
    flags = flags.withColumn("gap", F.last(F.when(F.col("blank"), row), ignorenulls=True).over(layout.below()))  # the next blank row
    content = flags.where(~F.col("blank") & ~F.col("note"))
    w = sheet_window()
    content = content.select("sheet", "row_idx", "lone", "header", F.lead("header").over(w).alias("header_next"), F.lag("gap").over(w).alias("split"), F.lag("lone").over(w).alias("lone_before"))
    begins = (F.col("header") & ~F.coalesce(F.col("lone_before"), F.lit(False))) | (F.col("lone") & F.coalesce(F.col("header_next"), F.lit(False)))
    return content.where((F.col("split") < row) & begins).select("sheet", "split")


def splits_under_header(rows: DataFrame, header_end: DataFrame) -> DataFrame:
    """(sheet, split): as vertical_splits, from the second row under the header on, and the row before the first blank one."""
    under = rows.join(header_end, "sheet").where(F.col("row_idx") >= F.col("header_end") + 2).select("sheet", "row_idx", "cells")
    return vertical_splits(under).select("sheet", (F.col("split") - 1).alias("split"))


def blank_columns(cells: DataFrame) -> DataFrame:
    """(sheet, col_idx, ratio, is_blank): the share of blank cells among a sheet's rows, and whether it is over 0.8."""
    n_rows = cells.groupBy("sheet").agg(F.count_distinct("row_idx").alias("n"))
    by = cells.groupBy("sheet", "col_idx").agg(F.count_if(t.blank(F.col("value"))).alias("blanks"))
    ratio = F.col("blanks") / F.col("n")
    return by.join(n_rows, "sheet").select("sheet", "col_idx", ratio.alias("ratio"), (ratio > 0.8).alias("is_blank"))


def column_islands(columns: DataFrame) -> DataFrame:
    """(sheet, start, end): runs of columns that are not blank."""
    w = W.partitionBy("sheet").orderBy("col_idx")
    full = columns.where(~F.col("is_blank")).select("sheet", "col_idx", (F.col("col_idx") - F.row_number().over(w)).alias("island"))
    return full.groupBy("sheet", "island").agg(F.min("col_idx").alias("start"), F.max("col_idx").alias("end")).drop("island")


def split_column(columns: DataFrame) -> DataFrame:
    """(sheet, split_col): the first of two or more adjacent blank columns that a column with content follows."""
    w = W.partitionBy("sheet").orderBy("col_idx")
    blank = columns.where("is_blank").select("sheet", "col_idx", (F.col("col_idx") - F.row_number().over(w)).alias("island"))
    runs = blank.groupBy("sheet", "island").agg(F.min("col_idx").alias("a"), F.max("col_idx").alias("b"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2)
    last = columns.where(~F.col("is_blank")).groupBy("sheet").agg(F.max("col_idx").alias("last"))
    return runs.join(last, "sheet").where(F.col("last") > F.col("b")).groupBy("sheet").agg(F.min("a").alias("split_col"))


def blank_runs(columns: DataFrame, least: int = 2) -> DataFrame:
    """(sheet, col_idx): where each run of ``least`` or more blank columns begins that a column with content follows."""
    w = W.partitionBy("sheet").orderBy("col_idx")
    full = columns.where(~F.col("is_blank")).select("sheet", "col_idx", (F.coalesce(F.lag("col_idx").over(w), F.lit(-1)) + 1).alias("begin"))
    return full.where(F.col("col_idx") - F.col("begin") >= least).select("sheet", F.col("begin").alias("col_idx"))


def best_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """(sheet, start, end, hint, overlap): for each interval the hint with most columns in common; the first of equals."""
    h = right.select("sheet", F.col("start").alias("hs"), F.col("end").alias("he"), "hint")
    overlap = F.least("end", "he") - F.greatest("start", "hs") + 1
    best = F.row_number().over(W.partitionBy("sheet", "start", "end").orderBy(F.desc("overlap"), "hint"))
    return left.join(h, "sheet").withColumn("overlap", overlap).where(F.col("overlap") > 0).withColumn("r", best).where(F.col("r") == 1).select("sheet", "start", "end", "hint", "overlap")


def label(c: Column) -> Column:
    """A region's label: at most 30 characters."""
    return F.when(F.length(c) > 30, F.concat(F.substring(c, 1, 28), F.lit(".."))).otherwise(c)
