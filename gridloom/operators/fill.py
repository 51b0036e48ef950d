"""Filling of first cells: forward, inside bordered groups, and from category rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t
from gridloom.operators import predicates as p
from gridloom.operators.ranges import sheet_window


def _first(cells: Column) -> Column:
    first = F.get(cells, 0)
    return F.when(~t.blank(first), first)


def _rest_filled(cells: Column) -> Column:
    return ~p.is_blank(F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1))))


def _with_first(cells: Column, value: Column) -> Column:
    return F.concat(F.array(value), F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1))))


def forward_fill(rows: DataFrame) -> DataFrame:
    """The last first cell above goes into rows that have none but hold something else."""
    cells = F.col("cells")
    seen = F.last(_first(cells), ignorenulls=True).over(sheet_window().rowsBetween(W.unboundedPreceding, W.currentRow))
    return rows.withColumn("seen", seen).withColumn("cells", F.when(_first(cells).isNull() & _rest_filled(cells), _with_first(cells, F.col("seen"))).otherwise(cells)).drop("seen")


def bordered_groups(rows: DataFrame, border: str = "border") -> DataFrame:
    """With gid: a row with a border below closes its group."""
    closed = F.sum(F.col("closed").cast("long")).over(sheet_window().rowsBetween(W.unboundedPreceding, W.currentRow))
    return rows.withColumn("closed", F.coalesce(F.lag(border).over(sheet_window()), F.lit(False))).withColumn("gid", closed).drop("closed")


def group_fill(rows: DataFrame) -> DataFrame:
    """A group of several rows with one distinct first cell gives it to its rows that hold something else (needs gid)."""
    cells, group = F.col("cells"), W.partitionBy("sheet", "gid")
    only = F.when((F.min(_first(cells)).over(group) == F.max(_first(cells)).over(group)) & (F.count(F.lit(1)).over(group) > 1), F.min(_first(cells)).over(group))
    filled = F.when(_first(cells).isNull() & _rest_filled(cells) & F.col("only").isNotNull(), _with_first(cells, F.col("only"))).otherwise(cells)
    return rows.withColumn("only", only).withColumn("cells", filled).drop("only")


def fill_down(rows: DataFrame) -> DataFrame:
    """First cells down their bordered groups (needs border and gid) in sheets with any border, down to all rows below in the others."""
    bordered = F.max(F.col("border").cast("int")).over(W.partitionBy("sheet")) == 1
    told = rows.withColumn("bordered", F.coalesce(bordered, F.lit(False)))
    filled = forward_fill(told.withColumn("own", F.col("cells"))).withColumnsRenamed({"cells": "down"}).withColumnsRenamed({"own": "cells"})
    return group_fill(filled).withColumn("cells", F.when(F.col("bordered"), F.col("cells")).otherwise(F.col("down"))).drop("down", "bordered")


def push_down_categories(rows: DataFrame, blanks: bool = True) -> DataFrame:
    """A row with its first cell only gives that to the next row that is not blank, if that has none.  blanks: whether rows can be blank."""
    cells = F.col("cells")
    category = F.when(_first(cells).isNotNull() & ~_rest_filled(cells), _first(cells))
    full = (rows.where(~p.is_blank(cells)) if blanks else rows).withColumn("above", F.lag(category).over(sheet_window()))
    done = full.withColumn("cells", F.when(_first(cells).isNull() & F.col("above").isNotNull(), _with_first(cells, F.col("above"))).otherwise(cells)).drop("above")
    return done.unionByName(rows.where(p.is_blank(cells))) if blanks else done
