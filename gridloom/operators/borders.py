"""Border signals: statistics of edges by row and column, and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.operators.ranges import sheet_window

# The styles' kinds.
SOLID = ("thin", "medium", "thick", "double")
DASH = ("dashDot", "dashDotDot", "dashed", "dotted", "slantDashDot", "mediumDashed", "mediumDashDot", "mediumDashDotDot")
BY_CODE = ("none", "thin", "medium", "dashed", "dotted", "thick", "double", "hair", "mediumDashed", "dashDot", "mediumDashDot", "mediumDashDotDot", "dashDotDot", "slantDashDot")


def style_of_code(code: Column) -> Column:
    return F.get(F.array(*map(F.lit, BY_CODE)), code.cast("int"))


def edge_stats(cells: DataFrame, along: str, style: str) -> DataFrame:
    """(sheet, <along>, style, ratio, is_solid, is_dash): the commonest edge style of a row or column, the first of
    equals, and the share of its cells with any.  ``along`` is row_idx or col_idx."""
    across = "col_idx" if along == "row_idx" else "row_idx"
    by = cells.where(F.col(style).isNotNull()).groupBy("sheet", along, style).agg(F.count(F.lit(1)).alias("n"), F.min(across).alias("at"))
    best = by.groupBy("sheet", along).agg(F.min_by(style, F.struct(-F.col("n"), F.col("at"), F.col(style))).alias("style"), F.sum("n").alias("styled"))
    width = cells.groupBy("sheet", along).agg(F.count(F.lit(1)).alias("width"))
    out = width.join(best, ["sheet", along], "left")
    return out.select(
        "sheet", along, "style", (F.coalesce("styled", F.lit(0)) / F.col("width")).alias("ratio"),
        F.coalesce(F.col("style").isin(*SOLID), F.lit(False)).alias("is_solid"), F.coalesce(F.col("style").isin(*DASH), F.lit(False)).alias("is_dash"),
    )


def row_edges(cells: DataFrame) -> DataFrame:
    """(sheet, row_idx, bottom_ratio, top_ratio, is_solid, is_dash, border) of cells with their edges, in one pass.

    border: over half of a row's cells have a solid or dashed lower edge.
    """
    known = F.col("b_bottom").isin(*SOLID, *DASH)
    by = cells.groupBy("sheet", "row_idx", "b_bottom").agg(F.count(F.lit(1)).alias("n"), F.min("col_idx").alias("at"), F.count("b_top").alias("tops"), F.count_if(known).alias("closed"))
    styled = F.when(F.col("b_bottom").isNotNull(), F.col("n"))
    best = F.min_by("b_bottom", F.when(F.col("b_bottom").isNotNull(), F.struct(-F.col("n"), F.col("at"), F.col("b_bottom"))))
    rows = by.groupBy("sheet", "row_idx").agg(best.alias("style"), F.sum(styled).alias("styled"), F.sum("tops").alias("tops"), F.sum("closed").alias("closed"), F.sum("n").alias("width"))
    kind = lambda styles: F.coalesce(F.col("style").isin(*styles), F.lit(False))
    ratio = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.col("width")
    return rows.select("sheet", "row_idx", ratio("styled").alias("bottom_ratio"), ratio("tops").alias("top_ratio"), kind(SOLID).alias("is_solid"), kind(DASH).alias("is_dash"), (F.col("closed") > 0.5 * F.col("width")).alias("border"))


def is_boundary(ratio: Column, is_solid: Column, is_dash: Column) -> Column:
    """A row that ends a block: an edge under 70 % of it, or a dashed one under 30 %."""
    return (is_solid & (ratio >= 0.7)) | (is_dash & (ratio >= 0.3))


def header_end_by_border(rows: DataFrame) -> DataFrame:
    """(sheet, header_end, gap) from (sheet, row_idx, boundary): the boundary before the widest gap of two rows or more.

    Of equal gaps the first; no signal where over 70 % of the rows are boundaries.  Without such a gap, the first
    boundary with two open rows among the four after it, and no gap.
    """
    w = sheet_window()
    open_after = F.sum((~F.col("boundary")).cast("int")).over(w.rowsBetween(1, 4))
    share = rows.groupBy("sheet").agg(F.avg(F.col("boundary").cast("double")).alias("share"), F.max("row_idx").alias("last"))
    bounds = rows.withColumn("open", F.coalesce(open_after, F.lit(0))).where("boundary").join(share, "sheet").where(F.col("share") <= 0.7)
    gap = F.coalesce(F.lead("row_idx").over(w), F.col("last") + 1) - F.col("row_idx") - 1
    wide = F.when(F.col("gap") >= 2, F.col("gap"))
    found = bounds.withColumn("gap", gap).groupBy("sheet").agg(
        F.max(wide).alias("gap"), F.max_by("row_idx", F.when(F.col("gap") >= 2, F.struct(F.col("gap"), -F.col("row_idx")))).alias("first"), F.min(F.when(F.col("open") >= 2, F.col("row_idx"))).alias("other")
    )
    return found.select("sheet", F.when(F.col("gap").isNotNull(), F.col("first")).otherwise(F.col("other")).alias("header_end"), "gap").where(F.col("header_end").isNotNull())


def region_header_end(rows: DataFrame, first: int = 15, most: int = 9) -> DataFrame:
    """(sheet, header_end, gap): of the first rows with a boundary, the one that most open rows follow, two or more (nine count at most)."""
    last = rows.groupBy("sheet").agg(F.max("row_idx").alias("last"))
    bounds = rows.where("boundary").join(last, "sheet")
    gap = F.least(F.lit(most), F.coalesce(F.lead("row_idx").over(sheet_window()), F.col("last") + 1) - F.col("row_idx") - 1)
    near = bounds.withColumn("gap", gap).where((F.col("row_idx") < first) & (F.col("gap") >= 2))
    return near.groupBy("sheet").agg(F.max_by("row_idx", F.struct(F.col("gap"), -F.col("row_idx"))).alias("header_end"), F.max("gap").alias("gap"))


def splits_by_border(rows: DataFrame, header_end: DataFrame) -> DataFrame:
    """(sheet, split) from (sheet, row_idx, bottom_ratio, top_ratio, is_solid, is_dash): boundaries under the header that a bare row
    (hardly any edge above or below) and two or more open rows part from the next one.

    Where fewer than two rows have an edge under 70 % of them, dashed ones from 30 % up count too.
    """
    w, upto = sheet_window(), sheet_window().rowsBetween(W.unboundedPreceding, W.currentRow)
    under = rows.join(header_end, "sheet").where(F.col("row_idx") > F.col("header_end"))
    strong, dashed = F.col("is_solid") & (F.col("bottom_ratio") >= 0.7), F.col("is_dash") & (F.col("bottom_ratio") >= 0.3)
    few = F.coalesce(F.sum(strong.cast("int")).over(W.partitionBy("sheet")), F.lit(0)) < 2
    is_open = ~is_boundary(F.col("bottom_ratio"), F.col("is_solid"), F.col("is_dash"))
    bare = (F.col("bottom_ratio") < 0.1) & (F.col("top_ratio") < 0.1)
    summed = under.select("sheet", "row_idx", (strong | (few & dashed)).alias("bound"), F.sum(is_open.cast("int")).over(upto).alias("open"), is_open.cast("int").alias("o"), F.sum(bare.cast("int")).over(upto).alias("bare"), bare.cast("int").alias("b"))
    bounds = summed.where("bound")
    between = bounds.withColumn("opens", F.lead(F.col("open") - F.col("o")).over(w) - F.col("open")).withColumn("bares", F.lead(F.col("bare") - F.col("b")).over(w) - F.col("bare"))
    return between.where((F.col("opens") >= 2) & (F.col("bares") >= 1)).select("sheet", F.col("row_idx").alias("split"))


def dash_streak(rows: DataFrame, least: int = 2) -> DataFrame:
    """(sheet, row_idx, streak): boundaries after at least so many open rows in a row."""
    w = sheet_window()
    bounds = rows.where("boundary").withColumn("streak", F.col("row_idx") - F.coalesce(F.lag("row_idx").over(w), F.lit(-1)) - 1)
    return bounds.where(F.col("streak") >= least).select("sheet", "row_idx", "streak")


def split_columns(columns: DataFrame) -> DataFrame:
    """(sheet, col_idx): columns with a dashed right edge (0.3), and where thin runs (below 0.3) begin, in four columns or more:
    runs between two full columns (over 0.5), or after one at the sheet's end."""
    w = W.partitionBy("sheet").orderBy("col_idx")
    dash = F.col("is_dash") & (F.col("ratio") >= 0.3)
    edge = F.when(F.col("ratio") >= 0.3, F.struct("ratio"))
    after = F.last(edge, ignorenulls=True).over(W.partitionBy("sheet").orderBy(F.desc("col_idx")).rowsBetween(W.unboundedPreceding, -1))
    told = columns.withColumn("before", F.lag("ratio").over(w)).withColumn("after", after).withColumn("n", F.count(F.lit(1)).over(W.partitionBy("sheet")))
    enclosed = F.col("after").isNull() | (F.col("after.ratio") > 0.5)
    runs = (F.col("n") >= 4) & (F.col("ratio") < 0.3) & (F.col("before") > 0.5) & enclosed
    return told.where(dash | runs).select("sheet", "col_idx").distinct()


def pre_classify(rows: DataFrame, columns: DataFrame) -> DataFrame:
    """(sheet, strategy, confidence, split_col): vertical where a dashed row edge follows open rows, else horizontal at a dashed column
    edge, the first of which is split_col."""
    vertical = dash_streak(rows).select("sheet").distinct().select("sheet", F.lit(0).alias("rank"), F.lit("vertical_subtable").alias("strategy"), F.lit(None).cast("int").alias("split_col"))
    dashed = columns.where(F.col("is_dash") & (F.col("ratio") >= 0.3)).groupBy("sheet").agg(F.min("col_idx").cast("int").alias("split_col"))
    horizontal = dashed.select("sheet", F.lit(1).alias("rank"), F.lit("horizontal_split").alias("strategy"), "split_col")
    best = vertical.unionByName(horizontal).groupBy("sheet").agg(F.min(F.struct("rank", "strategy", "split_col")).alias("b"))
    return best.select("sheet", "b.strategy", F.lit(0.9).alias("confidence"), "b.split_col")
