"""Grids: a sheet's rows as arrays of cell texts, with the sheet's key and a row index from 0.

``grid_rows`` is (sheet, row_idx, cells array<string>); ``grid_cells`` is its long form (sheet, row_idx, col_idx, value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t
from gridloom.operators import predicates as p


def to_grid(df: DataFrame, sheet: str, order: Sequence[str], cells: Sequence[Column]) -> DataFrame:
    """Any table as a grid: a sheet for each value of a column, rows in the given order."""
    row = (F.row_number().over(W.partitionBy(sheet).orderBy(*order)) - 1).cast("int")
    return df.select(F.col(sheet).alias("sheet"), row.alias("row_idx"), F.array(*(c.cast("string") for c in cells)).alias("cells"))


def to_cells(rows: DataFrame) -> DataFrame:
    return rows.select("sheet", "row_idx", F.posexplode("cells").alias("col_idx", "value"))


def to_rows(cells: DataFrame, width: int) -> DataFrame:
    """Sparse cells to dense rows of a width; what is missing is NULL.  Each cell is written once, so max() picks it."""
    value = [F.max(F.when(F.col("col_idx") == i, F.col("value"))) for i in range(width)]
    return cells.groupBy("sheet", "row_idx").agg(F.array(*value).alias("cells"))


def densify(cells: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """(sheet, row_idx, col_idx, value) for every row of (sheet, row_idx) and every column, from sparse cells."""
    every = rows.select("sheet", "row_idx", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("col_idx"))
    return every.join(cells, ["sheet", "row_idx", "col_idx"], "left")


def fill_merged(cells: DataFrame, merges: DataFrame) -> DataFrame:
    """Every cell of a merged range takes the value of its first cell, NULL too.

    Ranges (sheet, r0, c0, r1, c1) become one row for each of their own rows, so that they meet cells by equality on
    sheet and row and not by a range condition over whole sheets.
    """
    first = cells.select(F.col("sheet").alias("s"), F.col("row_idx").alias("r"), F.col("col_idx").alias("c"), F.col("value").alias("anchor"))
    at = (F.col("sheet") == F.col("s")) & (F.col("r0") == F.col("r")) & (F.col("c0") == F.col("c"))
    anchors = merges.join(first, at, "left").select(F.col("sheet").alias("ms"), F.explode(F.sequence("r0", "r1")).alias("mr"), "c0", "c1", "anchor")
    inside = (F.col("sheet") == F.col("ms")) & (F.col("row_idx") == F.col("mr")) & F.col("col_idx").between(F.col("c0"), F.col("c1"))
    value = F.when(F.col("ms").isNotNull(), F.col("anchor")).otherwise(F.col("value"))
    return cells.join(anchors, inside, "left").select("sheet", "row_idx", "col_idx", value.alias("value"))


def preview(rows: DataFrame, n: int = 20, merges: DataFrame | None = None) -> DataFrame:
    """The first n rows of each sheet, with its number of rows and widest row, and, of (sheet, …) of merged ranges, their number."""
    dims = rows.groupBy("sheet").agg(F.count(F.lit(1)).alias("max_row"), F.max(F.size("cells")).cast("long").alias("max_col"))
    if merges is not None:
        counted = merges.groupBy("sheet").agg(F.count(F.lit(1)).alias("merged_count"))
        dims = dims.join(counted, "sheet", "left").withColumn("merged_count", F.coalesce("merged_count", F.lit(0)))
    return rows.where(F.col("row_idx") < n).join(dims, "sheet")


def first_columns(rows: DataFrame, n_cols: int = 2, max_rows: int = 500) -> DataFrame:
    """The first columns of the first rows, blank rows at the end left out; raw_row_count counts them."""
    part = rows.where(F.col("row_idx") < max_rows).select("sheet", "row_idx", F.slice("cells", 1, n_cols).alias("cells"))
    ends = part.groupBy("sheet").agg(F.count(F.lit(1)).alias("raw_row_count"), F.max(F.when(~p.is_blank(F.col("cells")), F.col("row_idx"))).alias("last"))
    return part.join(ends, "sheet").where(F.col("row_idx") <= F.col("last")).drop("last")


def trim_blank_rows(rows: DataFrame) -> DataFrame:
    """Without blank rows at the start and the end; trim_start is the first row kept."""
    full = F.when(~p.is_blank(F.col("cells")), F.col("row_idx"))
    ends = rows.groupBy("sheet").agg(F.min(full).alias("trim_start"), F.max(full).alias("trim_end"))
    return rows.join(ends, "sheet").where(F.col("row_idx").between(F.col("trim_start"), F.col("trim_end"))).drop("trim_end")


def trim_blank_columns(rows: DataFrame) -> DataFrame:
    """Cut to the right-most column that holds anything."""
    last = F.array_max(F.transform(F.col("cells"), lambda c, i: F.when(~t.blank(c), i + 1)))
    width = rows.groupBy("sheet").agg(F.coalesce(F.max(last), F.lit(0)).alias("width"))
    return rows.join(width, "sheet").withColumn("cells", F.slice("cells", 1, F.col("width"))).drop("width")


def regions(rows: DataFrame, cuts: Sequence[tuple[int, int, str]]) -> DataFrame:
    """Column slices of each row: (sheet, row_idx, label, cells), one row a region (start, inclusive end, label)."""
    parts = F.array(*(F.struct(F.lit(label).alias("label"), F.slice("cells", a + 1, b - a + 1).alias("cells")) for a, b, label in cuts))
    return rows.select("sheet", "row_idx", F.explode(parts).alias("r")).select("sheet", "row_idx", "r.label", "r.cells")
