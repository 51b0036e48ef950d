"""Workbooks as tables of cells and of merged ranges, read by Spark's binary reader and parted by workbook."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from functools import cached_property
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE = re.compile(r"([A-Z]+)(\d+)")
#: What a workbook that is damaged raises.
UNREADABLE = (zipfile.BadZipFile, zlib.error, ElementTree.ParseError, LookupError, ValueError, AttributeError, TypeError, EOFError, RuntimeError)
SIDES = ("top", "bottom", "left", "right")
CELL_FIELDS = "path string, sheet_index int, sheet_name string, row_idx int, col_idx int, value string, b_top string, b_bottom string, b_left string, b_right string, error string"
SHEET_FIELDS = "path string, sheet_index int, sheet_name string, error string"
RANGE_FIELDS = "path string, sheet_index int, r0 int, c0 int, r1 int, c1 int"


def place(name: str) -> tuple[int, int]:
    """Row and column from 0 of a cell name such as B7."""
    letters, digits = PLACE.match(name).groups()
    column = 0
    for c in letters:
        column = column * 26 + ord(c) - 64
    return int(digits) - 1, column - 1


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _all(root: ElementTree.Element, name: str) -> Iterator[ElementTree.Element]:
    return (e for e in root.iter() if _local(e.tag) == name)


class Strings:
    """A workbook's shared texts, read as far as they are asked for."""

    def __init__(self, stream: io.BufferedIOBase | None) -> None:
        self.known: list[str] = []
        self.events = ElementTree.iterparse(stream) if stream else iter(())

    def __getitem__(self, k: int) -> str:
        while len(self.known) <= k:
            e = next((e for _, e in self.events if _local(e.tag) == "si"), None)
            if e is None:
                raise IndexError("a shared text that isn't there")
            self.known.append("".join(t.text or "" for t in _all(e, "t")))
            e.clear()
        return self.known[k]


class Workbook:
    """The parts of a workbook that cells refer to, each read when it is first needed."""

    def __init__(self, content: bytes) -> None:
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.names = set(self.zip.namelist())
        links = {e.get("Id"): e.get("Target") for e in _all(self._part("xl/_rels/workbook.xml.rels"), "Relationship")}
        relation = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
        self.sheets = [(e.get("name"), "xl/" + links[e.get(relation)].removeprefix("/xl/")) for e in _all(self._part("xl/workbook.xml"), "sheet")]
        texts = "xl/sharedStrings.xml"
        self.strings = Strings(self.zip.open(texts) if texts in self.names else None)
        self.rows_read = 0

    def _part(self, name: str) -> ElementTree.Element:
        return ElementTree.fromstring(self.zip.read(name)) if name in self.names else ElementTree.Element("none")

    @cached_property
    def edges(self) -> list[dict[str, str | None]]:
        """The edges of each cell format."""
        styles = self._part("xl/styles.xml")
        edges = [{_local(s.tag): s.get("style") for s in e} for e in _all(styles, "border")]
        return [edges[int(x.get("borderId", 0))] if edges else {} for x in next(_all(styles, "cellXfs"), ())]

    def _rows(self, target: str) -> Iterator[tuple[int, list[ElementTree.Element]]]:
        """The rows of a sheet with their cells, as they are parsed; what has been read is let go."""
        data, number = None, -1
        for event, e in ElementTree.iterparse(self.zip.open(target), ("start", "end")):
            name = _local(e.tag)
            if event == "start":
                data = e if name == "sheetData" else data
            elif name == "row":
                number = int(e.get("r", number + 2)) - 1
                self.rows_read += 1
                yield number, [c for c in e if _local(c.tag) == "c"]
                if data is not None:
                    data.clear()

    def _value(self, e: ElementTree.Element) -> str | None:
        kind, value = e.get("t"), next((v.text for v in e if _local(v.tag) == "v"), None)
        if kind == "s" and value is not None:
            return self.strings[int(value)]
        if kind == "inlineStr":
            return "".join(t.text or "" for t in _all(e, "t"))
        if kind == "b" and value is not None:
            return "True" if value == "1" else "False"
        return value

    def cells(self, target: str) -> Iterator[tuple]:
        """(row, column, value, edges of the four sides), of cells that hold something or have an edge."""
        for _, row in self._rows(target):
            for e in row:
                value, style = self._value(e), int(e.get("s", 0))
                own = self.edges[style] if style < len(self.edges) else {}
                sides = [own.get(s) for s in SIDES]
                if value is not None or any(sides):
                    yield (*place(e.get("r")), value, *sides)

    def rows(self, target: str, limit: int | None = None, columns: int | None = None) -> Iterator[tuple[int, list[str | None]]]:
        """(row, cells) of the rows before ``limit``, in the first ``columns``; nothing beyond the limit is parsed."""
        for number, row in self._rows(target):
            if limit is not None and number >= limit:
                return
            cells: list[str | None] = []
            for e in row:
                column = place(e.get("r"))[1]
                if columns is not None and column >= columns:
                    break
                if (value := self._value(e)) is not None:
                    cells += [None] * (column - len(cells)) + [value]
            yield number, cells
            if limit is not None and number + 1 >= limit:
                return

    def merges(self, target: str) -> Iterator[tuple[int, int, int, int]]:
        for _, e in ElementTree.iterparse(self.zip.open(target)):
            if _local(e.tag) == "row":
                e.clear()
            elif _local(e.tag) == "mergeCell":
                a, _, b = e.get("ref").partition(":")
                yield (*place(a), *place(b or a))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


TYPES = {"string": pa.string(), "int": pa.int32()}


def _schema(fields: str) -> pa.Schema:
    return pa.schema([(n, TYPES[k]) for n, k in (f.split() for f in fields.split(", "))])


def sheets(files: DataFrame) -> DataFrame:
    """A row a sheet of (path, content), no cell of which is read; a workbook that can't be read is one row with its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(SHEET_FIELDS)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows = [(path, k, name, None) for k, (name, _) in enumerate(Workbook(content).sheets)]
                except UNREADABLE as e:
                    rows = [(path, None, None, f"{type(e).__name__}: {e}")]
                if rows:
                    yield _batch(rows, schema)

    return files.select("path", "content").mapInArrow(run, SHEET_FIELDS)


CONTENT_FIELDS = f"kind string, {CELL_FIELDS}, r1 int, c1 int"
ROW_FIELDS = "path string, sheet_index int, sheet_name string, row_idx int, cells array<string>, error string"


def contents(files: DataFrame) -> DataFrame:
    """All of the workbooks of (path, content), each opened once: rows of kind ``sheet``, ``cell``, ``merge`` (from row_idx and
    col_idx to r1 and c1) and ``error``, which tells what stopped the reading of a workbook, after what was read before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(CONTENT_FIELDS)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple] = []
                try:
                    book = Workbook(content)
                    for k, (name, target) in enumerate(book.sheets):
                        rows.append(("sheet", path, k, name, *[None] * 10))
                        for cell in book.cells(target):
                            rows.append(("cell", path, k, name, *cell, None, None, None))
                            if len(rows) == 20_000:
                                yield _batch(rows, schema)
                                rows = []
                        rows += [("merge", path, k, name, r0, c0, *[None] * 6, r1, c1) for r0, c0, r1, c1 in book.merges(target)]
                except UNREADABLE as e:
                    rows.append(("error", path, *[None] * 9, f"{type(e).__name__}: {e}", None, None))
                if rows:
                    yield _batch(rows, schema)

    return files.select("path", "content").mapInArrow(run, CONTENT_FIELDS)


def cells(files: DataFrame) -> DataFrame:
    """A row a cell of (path, content); a workbook that can't be read has a row with its error, after the cells before it."""
    return contents(files).where(F.col("kind").isin("cell", "error")).select(*(f.split()[0] for f in CELL_FIELDS.split(", ")))


def merges(files: DataFrame) -> DataFrame:
    """A row a merged range of (path, content)."""
    return contents(files).where("kind = 'merge'").select("path", "sheet_index", F.col("row_idx").alias("r0"), F.col("col_idx").alias("c0"), "r1", "c1")


def rows(files: DataFrame, limit: int | None = None, columns: int | None = None, sheet: str | int | None = None) -> DataFrame:
    """A row a row of (path, content), as it stands in the sheet: of one sheet by name or number, or of all of them.

    The limit and the columns reach the scan: rows beyond the limit are not parsed, nor shared texts that none of the rows
    asks for.  A workbook that can't be read, or has no such sheet, is one row with its error; merged ranges aren't filled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out: list[tuple] = []
                try:
                    book = Workbook(content)
                    wanted = [(k, n, x) for k, (n, x) in enumerate(book.sheets) if sheet is None or sheet in (k, n)]
                    if not wanted:
                        raise LookupError(f"no sheet {sheet!r}")
                    for k, name, target in wanted:
                        out += [(path, k, name, r, c, None) for r, c in book.rows(target, limit, columns)]
                except UNREADABLE as e:
                    out.append((path, None, None, None, None, f"{type(e).__name__}: {e}"))
                for at in range(0, len(out), 5_000):
                    part = out[at : at + 5_000]
                    kinds = (pa.string(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], k) for i, k in enumerate(kinds)], ["path", "sheet_index", "sheet_name", "row_idx", "cells", "error"])

    return files.select("path", "content").mapInArrow(run, ROW_FIELDS)


def sheet_key() -> Column:
    """The key of a sheet in a grid."""
    return F.concat_ws("#", "path", F.col("sheet_index").cast("string"))
