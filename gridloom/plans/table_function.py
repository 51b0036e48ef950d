"""A table function for SQL: sheets of a grid as one relation with the columns that are asked for.

    SELECT * FROM sheet_table(TABLE(grid) PARTITION BY sheet ORDER BY (row_idx), array('年份', '产量'))

Its columns follow from the names asked for; in each sheet the first row that isn't blank says where they stand, so that
sheets with other orders, or more columns, go into one relation.  A column that a sheet lacks is NULL; blank rows go.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


class SheetTable:
    """Rows (sheet, row_idx, cells) of one sheet, in order, to (sheet, row_no, and a column for each name)."""

    @staticmethod
    def analyze(rows: AnalyzeArgument, names: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable or not {"sheet", "cells"} <= set(rows.dataType.names):
            raise ValueError("the first argument must be a table with the columns sheet, row_idx and cells")
        if not names.value:
            raise ValueError("the second argument must be a constant array of column names")
        schema = StructType().add("sheet", rows.dataType["sheet"].dataType).add("row_no", LongType())
        for name in names.value:
            schema = schema.add(name, StringType())
        return AnalyzeResult(schema=schema)

    def __init__(self) -> None:
        self.places: list[int | None] | None = None
        self.row_no = 0

    def eval(self, rows: Row, names: list[str]) -> Iterator[tuple]:
        cells = [c.strip() if c else "" for c in rows["cells"] or ()]
        if not any(cells):
            return
        if self.places is None:
            self.places = [cells.index(n) if n in cells else None for n in names]
            return
        self.row_no += 1
        yield (rows["sheet"], self.row_no, *(cells[p] or None if p is not None and p < len(cells) else None for p in self.places))


def register(spark: SparkSession, name: str = "sheet_table") -> None:
    spark.udtf.register(name, udtf(SheetTable))
