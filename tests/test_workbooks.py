from __future__ import annotations

import json
import time
import zipfile

from pyspark.sql import functions as F

from gridloom import ingest
from gridloom.operators import ingest_log
from gridloom.sinks import tables
from gridloom.sources import files, xlsx
from gridloom.streaming import workbooks


def book(path, sheets: dict[str, list[list]], merges=(), edge_rows=()):
    """A small workbook: inline strings and numbers, one style with a dashed bottom edge."""

    def name(r, c):
        return f"{chr(65 + c)}{r + 1}"

    with zipfile.ZipFile(path, "w") as z:
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("xl/workbook.xml", f'<workbook xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{k + 1}" r:id="rId{k + 1}"/>' for k, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="rId{k + 1}" Target="worksheets/sheet{k + 1}.xml"/>' for k in range(len(sheets))) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", "<sst><si><t>shared</t></si></sst>")
        z.writestr("xl/styles.xml", '<styleSheet><borders><border/><border><bottom style="dashed"/></border></borders><cellXfs><xf borderId="0"/><xf borderId="1"/></cellXfs></styleSheet>')
        for k, rows in enumerate(sheets.values()):
            body = ""
            for r, row in enumerate(rows):
                body += f'<row r="{r + 1}">'
                for c, v in enumerate(row):
                    style = ' s="1"' if r in edge_rows else ""
                    if v is not None:
                        body += f'<c r="{name(r, c)}"{style}><v>{v}</v></c>' if isinstance(v, (int, float)) else f'<c r="{name(r, c)}" t="inlineStr"{style}><is><t>{v}</t></is></c>'
                body += "</row>"
            spans = "".join(f'<mergeCell ref="{m}"/>' for m in merges)
            z.writestr(f"xl/worksheets/sheet{k + 1}.xml", f"<worksheet><sheetData>{body}</sheetData><mergeCells>{spans}</mergeCells></worksheet>")


BASIC = [["年份", "地区", "产量"], [2020, "北京", 1234.5], [2021, "上海", 5678.5], [2022, "广州", 999.5]]


def test_scan_and_read(spark, tmp_path):
    book(tmp_path / "a.XLSX", {"Data": BASIC, "空表": []}, edge_rows=(0,))
    (tmp_path / "~$a.xlsx").write_bytes(b"x")
    (tmp_path / "bad.xlsx").write_bytes(b"no zip")
    found = files.scan(spark, str(tmp_path))
    assert sorted(r["file"] for r in found.select("file").collect()) == ["a.XLSX", "bad.xlsx"]
    cells = xlsx.cells(found).cache()
    assert cells.where(F.col("error").isNotNull()).count() == 1
    first = {(r["row_idx"], r["col_idx"]): r["value"] for r in cells.where("sheet_index = 0").collect()}
    assert first[(0, 1)] == "地区" and first[(1, 2)] == "1234.5" and len(first) == 12
    assert {r["b_bottom"] for r in cells.where("row_idx = 0 and error is null").collect()} == {"dashed"}


def test_ingest(spark, tmp_path):
    book(tmp_path / "merged.xlsx", {"M": [["测试报表标题", None, None], ["年份", "地区", "产量"], [2020, "北京", 1.5], [2021, "上海", 2.5]]}, merges=["A1:C1"])
    rows, _, _ = ingest.sheets(spark, str(tmp_path))
    assert rows.where("row_idx = 0").first()["cells"] == ["测试报表标题"] * 3
    log, relations, names = ingest.ingest(spark, str(tmp_path))
    assert [r["status"] for r in log.collect()] == ["SUCCESS"]
    (relation,) = relations.values()
    assert [r["cells"] for r in relation.orderBy("row_no").collect()] == [["2020", "北京", "1.5"], ["2021", "上海", "2.5"]]
    assert [r["unique_name"] for r in names.orderBy("pos").collect()] == ["年份", "地区", "产量"]
    done, _, _ = ingest.ingest(spark, str(tmp_path), log)
    assert done.count() == 0


def test_ingest_logs_what_it_does_not_load(spark, tmp_path):
    book(tmp_path / "good.xlsx", {"Data": BASIC})
    (tmp_path / "bad.xlsx").write_bytes(b"no zip")
    book(tmp_path / "whole.xlsx", {"Data": BASIC})
    with zipfile.ZipFile(tmp_path / "whole.xlsx") as a, zipfile.ZipFile(tmp_path / "broken.xlsx", "w") as b:
        for n in a.namelist():
            b.writestr(n, a.read(n)[:-120] if "sheet1" in n else a.read(n))
    book(tmp_path / "wide.xlsx", {"Data": BASIC})
    with zipfile.ZipFile(tmp_path / "wide.xlsx") as a, zipfile.ZipFile(tmp_path / "wider.xlsx", "w") as b:
        for n in a.namelist():
            b.writestr(n, a.read(n).replace(b"</row>", b'<c r="IQ1"><v>5</v></c></row>', 1))
    log, relations, _ = ingest.ingest(spark, str(tmp_path))
    got = {r["sheet"].rsplit("/", 1)[-1]: (r["status"], r["column_count"]) for r in log.collect()}
    expected = {f"{n}.xlsx#0": ("SUCCESS", 3) for n in ("good", "whole", "wide")} | {"bad.xlsx": ("ERROR", None), "broken.xlsx": ("ERROR", None), "wider.xlsx#0": ("SKIP", 251)}
    assert got == expected
    loaded = {r["sheet"].rsplit("/", 1)[-1] for x in relations.values() for r in x.collect()}
    assert loaded == {"good.xlsx#0", "whole.xlsx#0", "wide.xlsx#0"}


def test_merged_range_beyond_the_content(spark, tmp_path):
    """A range over all rows of a sheet costs what the sheet holds."""
    book(tmp_path / "a.xlsx", {"M": [["标题", None, None], *BASIC]}, merges=["A1:C1", "E1:G1048576"])
    began = time.time()
    rows, _, _ = ingest.sheets(spark, str(tmp_path))
    assert rows.count() == 5 and rows.where("row_idx = 0").first()["cells"][:3] == ["标题"] * 3
    assert time.time() - began < 90


def test_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    book(tmp_path / "in" / "a.xlsx", {"Data": BASIC, "空表": []})
    (tmp_path / "in" / "bad.xlsx").write_bytes(b"no zip")
    out = str(tmp_path / "out")
    log = ingest.load(spark, str(tmp_path / "in"), out)
    assert log.columns == list(ingest_log.LOG)
    assert sorted((r["source_filename"], r["sheet_index"], r["status"]) for r in log.collect()) == [("a.xlsx", 0, "SUCCESS"), ("a.xlsx", 1, "SKIP"), ("bad.xlsx", None, "ERROR")]
    assert spark.read.parquet(f"{out}/relations").count() == 3
    book(tmp_path / "in" / "b.xlsx", {"Data": BASIC})
    log = ingest.load(spark, str(tmp_path / "in"), out)
    assert sorted(r["status"] for r in log.collect()) == ["ERROR", "SKIP", "SUCCESS", "SUCCESS"]
    held = spark.read.parquet(f"{out}/relations").groupBy("sheet").count().collect()
    assert sorted(r["count"] for r in held) == [3, 3]


BOOKS = {
    "WB1": ([["年份", "地区", "产量"], [2020, "北京", 1234.5], [2021, "上海", 5678.5], [2022, "广州", 999.5]], (), [("p1", ["年份", "地区", "产量"], 3)]),
    "WB2": ([["测试报表标题", None, None], ["年份", "地区", "产量"], [2020, "北京", 1.5], [2021, "上海", 2.5]], ("A1:C1",), [("p1", ["年份", "地区", "产量"], 2)]),
    "WB3": ([[None, None], ["年份", "GDP"], [2020, 1000.5], [2021, 1100.7], [None, None], ["资料来源：国家统计局", None], [None, None]], (), [("p1", ["年份", "GDP"], 2)]),
    "WB4": ([["指标", "1990", "2000"], [None, "万人", "万人"], ["人口", 1100.5, 1200.7], ["GDP", 5000.2, 6000.1], ["农业", 1000.3, 1100.4]], (), [("p1", ["指标", "1990万人", "2000万人"], 3)]),
    "WB5": ([["年份", "GDP", "人口"], [2020, 1000.5, 14.1], [2021, 1100.7, 14.2], [2022, 1200.5, 14.3]], (), [("p1", ["年份", "GDP", "人口"], 3)]),
    "WB6": (
        [["指标A", "1990", "2000", None, "指标B", "1990", "2000"], ["人口", 1100.5, 1200.7, None, "GDP", 5000.5, 6000.7], ["农业", 1000.5, 1100.7, None, "工业", 7000.5, 8000.7], ["服务", 1500.5, 1700.7, None, "建筑", 3000.5, 3200.7]],
        (), [("left", ["指标A", "y_1990", "y_2000"], 3), ("right", ["指标B", "y_1990", "y_2000"], 3)],
    ),
    "WB7": ([["对应表号", "内地名词", "香港名词"], ["1,8,12", "建筑业", "建造业"], [None, None, "Construction"], ["2,3", "工业", "工業"], [None, None, "Industry"]], (), [("p1", ["对应表号", "内地名词", "香港名词", "对应表号_续", "香港名词_续"], 2)]),
    "WB8": ([["年份", "GDP"], [2020, 1000.5], [2021, 1100.5]], (), [("p1", ["年份", "GDP"], 2)]),
    "stacked": (
        [["人口统计", None, None], ["指标", "1990", "2000"], ["人口", 1100.5, 1200.7], ["农业", 1000.5, 1100.7], [None] * 3, ["工业统计", None, None], ["项目", "2001", "2002"], [None, "万元", "万元"], ["钢", 5.5, 6.5], ["煤", 7.5, 8.5]],
        (), [("人口统计", ["指标", "y_1990", "y_2000"], 2), ("工业统计", ["项目", "2001万元", "2002万元"], 2)],
    ),
}


def test_workbooks_become_tables(spark, tmp_path):
    """The fixtures end to end: named tables with comments, rows, and a log that says all of it; then a second run."""
    (tmp_path / "in").mkdir()
    for name, (rows, merges, _) in BOOKS.items():
        book(tmp_path / "in" / f"{name}.xlsx", {"S1": rows}, merges)
    paths = {r["file"].removesuffix(".xlsx"): r["path"] for r in files.scan(spark, str(tmp_path / "in")).select("file", "path").collect()}
    region = '{"label": "%s", "col_start": %d, "col_end": %d, "header_start": 0, "header_end": 0, "data_start": 1}'
    raw = '{"strategy": "horizontal_split", "confidence": 0.95, "regions": [%s, %s]}' % (region % ("left", 0, 2), region % ("right", 4, 6))
    unsure = '{"strategy": "standard", "confidence": 0.5}'
    paired = '{"strategy": "paired_row_bilingual", "confidence": 0.9, "table_name_hint": "Terms of both"}'
    advice = spark.createDataFrame([(f"{paths['WB6']}#0", raw), (f"{paths['WB4']}#0", unsure), (f"{paths['WB7']}#0", paired)], "sheet string, raw string")
    log = ingest.load(spark, str(tmp_path / "in"), str(tmp_path / "out"), advice).collect()
    by = {(r["source_filename"].removesuffix(".xlsx"), r["subtable_label"]): r for r in log}
    assert set(by) == {(name, label) for name, (_, _, found) in BOOKS.items() for label, _, _ in found}
    for name, (rows, merges, found) in BOOKS.items():
        for k, (label, columns, n) in enumerate(found):
            r = by[name, label]
            said = spark.sql(f"DESCRIBE `{r['table_name']}`").collect()
            assert [x["comment"] for x in said[: len(columns)]] == columns, name
            assert [x["col_name"] for x in said[len(columns) :]] == ["_source_file", "_sheet_name", "_row_number", "_created_at", "_table_description"]
            assert spark.table(r["table_name"]).count() == r["actual_row_count"] == n
            assert (r["status"], r["sheet_name"], r["sheet_index"], r["subtable_index"], r["column_count"]) == ("SUCCESS", "S1", 0, k, len(columns))
            assert json.loads(r["column_names"]) == dict(zip([x["col_name"] for x in said], columns, strict=False))
            assert r["original_row_count"] <= len(rows) and r["merged_cells_count"] == len(merges) and r["file_size_bytes"] > 0 and r["parse_time_ms"] > 0
            assert r["table_description"].endswith(f"{name}.xlsx") and r["agent"] == ("advisor" if name in ("WB6", "WB7") else "rules")
    assert len({r["table_name"] for r in log}) == len(log)
    assert by["WB7", "p1"]["table_name"] == "terms_of_both" and by["WB6", "right"]["table_name"].endswith("_p2")
    first = spark.table(by["WB1", "p1"]["table_name"])
    assert first.columns[:3] == ["year", "region", "output"] and first.orderBy("_row_number").first()[:3] == ("2020", "北京", "1234.5")
    book(tmp_path / "in" / "more.xlsx", {"S1": BOOKS["WB8"][0]})
    again = ingest.load(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()
    assert len(again) == len(log) + 1 and {r["table_name"] for r in log} < {r["table_name"] for r in again}


def test_limits_reach_the_scan(spark, tmp_path):
    """A preview of 20 rows parses 20 rows, and the shared texts that they ask for."""
    path = tmp_path / "long.xlsx"
    book(path, {"first": [["x"]], "long": [[f"t{k}", k, k + 1, k + 2] for k in range(100_000)]})
    texts = "".join(f"<si><t>text {k}</t></si>" for k in range(50_000))
    with zipfile.ZipFile(path) as a, zipfile.ZipFile(tmp_path / "shared.xlsx", "w") as b:
        for n in a.namelist():
            data = a.read(n) if "shared" not in n else f"<sst>{texts}</sst>".encode()
            b.writestr(n, data.replace(b'<c r="B3"><v>2</v></c>', b'<c r="B3" t="s"><v>7</v></c>'))
    held = xlsx.Workbook((tmp_path / "shared.xlsx").read_bytes())
    target = held.sheets[1][1]
    got = list(held.rows(target, 20, 2))
    assert [r for r, _ in got] == list(range(20)) and got[2][1] == ["t2", "text 7"] and got[5][1] == ["t5", "5"]
    assert held.rows_read == 20 and len(held.strings.known) == 8
    assert sum(1 for _ in held.rows(target)) == 100_000
    found = files.scan(spark, str(tmp_path)).where("file = 'long.xlsx'")
    named, numbered = (xlsx.rows(found, 3, 1, sheet).select("row_idx", "cells").orderBy("row_idx").collect() for sheet in ("long", 1))
    assert named == numbered == [(k, [f"t{k}"]) for k in range(3)]
    assert xlsx.rows(found, 5).count() == 6
    assert xlsx.rows(found, sheet="none").first()["error"].startswith("LookupError")


def test_a_table_is_replaced_whole(spark):
    df = spark.range(3).select(F.col("id").alias("年份", metadata={"comment": "it's"}))
    tables.publish_table(df, "replaced", "it's \\ here")
    tables.publish_table(df.limit(1), "replaced")
    assert spark.table("replaced").count() == 1 and not spark.catalog.tableExists("replaced__new")
    tables.publish_table(df, "replaced", "it's \\ here")
    assert spark.sql("DESCRIBE replaced").first()["comment"] == "it's"
    said = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED replaced").collect()}
    assert said["Comment"] == "it's \\ here"


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    book(tmp_path / "in" / "a.xlsx", {"Data": BASIC})
    seen = []

    def load(batch):
        rows = batch.select("path", F.lit("SUCCESS").alias("status"))
        seen.extend(r["path"] for r in rows.collect())
        return rows

    def once():
        stream = workbooks.arrivals(spark, str(tmp_path / "in"))
        workbooks.run(stream, str(tmp_path / "checkpoint"), str(tmp_path / "log"), load).trigger(availableNow=True).start().awaitTermination(120)

    once()
    book(tmp_path / "in" / "b.xlsx", {"Data": BASIC})
    once()
    assert sorted(s.rsplit("/", 1)[-1] for s in seen) == ["a.xlsx", "b.xlsx"]
