from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridloom.operators import borders, fill, grid, ingest_log, naming, pairs, ranges, regions
from gridloom.operators import predicates as p
from gridloom.plans import decision, strategies, table_function
from gridloom.sinks import tables

FIELDS = "sheet string, row_idx int, cells array<string>"


def sheet(spark, *rows, name="s"):
    return spark.createDataFrame([(name, i, list(r)) for i, r in enumerate(rows)], FIELDS)


def cells(df, *order):
    return [r["cells"] for r in df.orderBy(*(order or ["row_idx"])).collect()]


def flags(spark, f, *rows):
    return [r[0] for r in sheet(spark, *rows).orderBy("row_idx").select(f(F.col("cells"))).collect()]


def test_row_predicates(spark):
    assert flags(spark, p.is_blank, [None, " "], ["　"], ["0"], []) == [True, True, False, True]
    assert flags(spark, p.is_title, ["a", "a"], ["a", None], ["a", "b"]) == [True, False, False]
    assert flags(spark, p.is_header_like, ["年份", "GDP"], ["1990", "2000"], ["x"], ["abc", "def"], ["1", "2"]) == [True, False, False, True, False]
    assert flags(spark, p.has_numeric_data, ["北京", "1234"], ["上海", "1,234.5"], ["a", "b"], [None, None]) == [True, True, False, False]
    assert flags(spark, p.is_data_like, ["2020", "北京", "1234"], ["北京", "1234.5"], ["单位", "万元", "亿元"], ["北京", "1,234"]) == [False, True, False, True]
    assert flags(spark, p.numeric_names, ["地区", "1990", "2000", "2010"], ["地区", "总人口", "GDP"]) == [True, False]


def test_rows_of_blank_and_null_cells(spark):
    rows = ([None, None], [" ", "\u3000"], [None, "x", " x "], ["x", "y"], [None, "7"], ["7", None], ["指", "标"], ["19", "99"], ["a\n7", "b"])
    assert flags(spark, p.is_blank, *rows) == [True, True, False, False, False, False, False, False, False]
    assert flags(spark, p.is_title, *rows) == [False, False, True, False, False, False, False, False, False]
    assert flags(spark, p.has_numeric_data, *rows) == [False, False, False, False, True, False, False, True, False]
    assert flags(spark, p.is_header_like, *rows) == [False, False, True, True, False, False, True, False, True]


def test_thousands(spark):
    df = sheet(spark, ["a", "1", "234"], ["a", "1,234"], ["a", "b"]).withColumn("cells", p.merge_thousands(F.col("cells"), F.lit(2)))
    assert cells(df) == [["a", "1234"], ["a", "1,234"], ["a", "b"]]


def test_footnotes_and_trims(spark):
    rows = sheet(spark, ["h", "v"], ["a", "1"], ["b", "2"], [None, None], ["资料来源：x", None], ["注：含港澳", None])
    assert len(cells(ranges.truncate_footnotes(rows))) == 3
    again = ranges.truncate_footnotes(ranges.truncate_footnotes(rows))
    assert len(cells(again)) == 3
    assert len(cells(ranges.stop_at_footnote(rows))) == 4
    assert cells(grid.trim_blank_columns(sheet(spark, ["a", "b", "c", None, ""], ["d", "e", None, None, ""]))) == [["a", "b", "c"], ["d", "e", None]]
    trimmed = grid.trim_blank_rows(sheet(spark, [None], ["x"], [None], ["y"], [" "])).orderBy("row_idx").collect()
    assert [(r["row_idx"], r["trim_start"]) for r in trimmed] == [(1, 1), (2, 1), (3, 1)]


def test_data_and_header(spark):
    start = lambda *rows: ranges.data_start(sheet(spark, *rows)).first()["data_start"]
    assert start(["年份", "GDP", "人口"], ["2020", "1000.5", "3.5"]) == 1
    assert start(["标题", None, None], ["年份", "GDP", "人口"], ["2020", "1000.5", "3.5"]) == 2
    assert start(["a", "b"], ["c", "d"]) == -1
    rows = sheet(spark, ["A long title", None], ["年份", "GDP"], ["2020", "12345.6"])
    end = spark.createDataFrame([("s", 1)], "sheet string, header_end int")
    assert ranges.header_start_from_end(rows, end).first()["header_start"] == 1
    data = sheet(spark, ["年份", "GDP", "x"], ["2020", "12345.6", "14000.2"])
    assert ranges.retreat_header(data, end).first()["header_end"] == 0


def test_fills(spark):
    rows = sheet(spark, ["总人口", "1000"], [None, "200"], [None, None])
    assert cells(fill.forward_fill(rows)) == [["总人口", "1000"], ["总人口", "200"], [None, None]]
    bordered = sheet(spark, ["指标", "1990"], ["A", "1"], [None, "2"], [None, "3"], ["B", "4"], [None, "5"]).withColumn("border", F.col("row_idx").isin(0, 3, 5))
    assert [c[0] for c in cells(fill.group_fill(fill.bordered_groups(bordered)))] == ["指标", "A", "A", "A", "B", "B"]
    pushed = fill.push_down_categories(sheet(spark, ["农业", None], [None, "1"], [None, "2"]))
    assert cells(pushed) == [["农业", None], ["农业", "1"], [None, "2"]]


@pytest.mark.parametrize(("extra", "span"), [(1, 2), (2, 3), (0, 2)])
def test_record_span(spark, extra, span):
    rows = [r for _ in range(8) for r in (["a", "b", "c"], *[[None, "x", None]] * extra)]
    assert pairs.record_span(pairs.record_span_scores(sheet(spark, *rows))).first()["span"] == span


def test_fold(spark):
    folded = pairs.fold(sheet(spark, ["1", "建筑业", "建造业"], [None, None, "Construction"], [None] * 3, [None] * 3))
    assert cells(folded, "rec") == [["1", "建筑业", "建造业", "", "", "Construction"]]


def test_merged_ranges(spark):
    c = spark.createDataFrame([("s", 0, 0, "T"), ("s", 0, 1, None), ("s", 1, 0, "x"), ("s", 1, 1, "y"), ("s", 2, 0, "z")], "sheet string, row_idx int, col_idx int, value string")
    m = spark.createDataFrame([("s", 0, 0, 0, 1), ("s", 2, 1, 3, 1)], "sheet string, r0 int, c0 int, r1 int, c1 int")
    got = {(r[1], r[2]): r[3] for r in grid.fill_merged(c, m).collect()}
    assert got == {(0, 0): "T", (0, 1): "T", (1, 0): "x", (1, 1): "y", (2, 0): "z"}


def test_splits(spark):
    rows = sheet(spark, ["年份", "GDP"], ["2020", "1.5"], [None, None], ["Second", None], [None, None], ["年份", "GDP"], ["2021", "2.5"], [None, None], ["x", "3.5"])
    assert [r["split"] for r in ranges.vertical_splits(rows).collect()] == [2]
    wide = grid.to_cells(sheet(spark, *[["a", "b", None, None, "c"]] * 5))
    columns = ranges.blank_columns(wide)
    assert ranges.split_column(columns).first()["split_col"] == 2
    assert sorted((r["start"], r["end"]) for r in ranges.column_islands(columns).collect()) == [(0, 1), (4, 4)]


def test_begins_of_subtables(spark):
    data, head = ["北京", "1.5"], ["指标", "年份"]
    made = {"a": {0: data, 1: data, 2: head, 3: data, 5: head, 6: ["单位", None], 7: data, 8: data}, "b": {0: data, 1: data, 2: head}, None: {0: head, 1: head, 2: data}}
    rows = spark.createDataFrame([(s, i, c) for s, sheet in made.items() for i, c in sheet.items()], FIELDS)
    # the row 4 is missing; a split row belongs to what stands over it; nothing follows the last one of b
    splits = spark.createDataFrame([("a", 1), ("a", 1), ("a", 4), ("b", 0), ("b", 1), ("b", 2), (None, 0), ("c", 0)], "sheet string, split int")
    out = regions.begins_of_subtables(rows, splits)
    assert sorted((tuple(r) for r in out.collect()), key=str) == [("a", 1, 3), ("a", 4, 7), ("b", 0, 1), ("b", 1, None), (None, 0, 2)]


def test_borders(spark):
    c = spark.createDataFrame([("s", 0, i, e) for i, e in enumerate(["thin", "dashed", "dashed", None])], "sheet string, row_idx int, col_idx int, edge string")
    row = borders.edge_stats(c, "row_idx", "edge").first()
    assert (row["style"], row["ratio"], row["is_dash"], row["is_solid"]) == ("dashed", 0.75, True, False)
    rows = spark.createDataFrame([("s", i, i in (0, 1, 5)) for i in range(8)], "sheet string, row_idx int, boundary boolean")
    got = borders.header_end_by_border(rows).first()
    assert (got["header_end"], got["gap"]) == (1, 3)


def test_names(spark):
    n = spark.createDataFrame([("s", i, v) for i, v in enumerate(["a", "a", "b", "a"])], "sheet string, pos int, name string")
    assert [r["unique_name"] for r in naming.unique_names(n).orderBy("pos").collect()] == ["a", "a_1", "b", "a_2"]
    head = grid.to_cells(sheet(spark, ["指标", "1990", "1990", None], [None, "万人", "1990", " "]))
    assert [r["name"] for r in naming.merged_header(head).orderBy("col_idx").collect()] == ["指标", "1990万人", "y_1990", "col_3"]
    assert tables.column_names(["a", "A", "id", "row_id", "a_1"]) == ["a", "A_1", "row_id", "row_id_1", "a_1_1"]
    assert tables.comment("中" * 100, 10) == "中中中"


def test_names_of_one_large_group(spark):
    n = spark.createDataFrame([("s", k, v) for k, v in [(i * 7 % 101 - 50, "ab"[i % 3 == 0]) for i in range(101)] + [(None, "a"), (60, None), (70, None)]], "sheet string, pos int, name string")
    got = naming.unique_names_of_one(n, bucket=8)
    assert sorted(map(str, got.collect())) == sorted(map(str, naming.unique_names(n).collect()))


def test_decisions(spark):
    df = spark.createDataFrame([("standard", "0.5"), ("nonsense", "2"), (None, "x"), ("SKIP", "-1")], "s string, c string")
    got = [tuple(r[0]) for r in df.select(decision.validated(F.col("s"), F.col("c"))).collect()]
    assert got == [("standard", 0.5), ("UNKNOWN", 1.0), ("UNKNOWN", 0.0), ("SKIP", 0.0)]
    with pytest.raises(ValueError, match="available"):
        strategies.get("none")


def test_strategies(spark):
    basic = sheet(spark, ["年份", "地区", "产量"], ["2020", "北京", "1,234.5"], ["2021", "上海", "5678.1"], ["注：x", None, None])
    assert cells(strategies.standard(basic)) == [["2020", "北京", "1234.5"], ["2021", "上海", "5678.1"]]
    assert cells(strategies.simple_header(basic)) == [["2020", "北京", "1234.5"], ["2021", "上海", "5678.1"]]
    two = sheet(spark, ["指标", "1990", "2000"], [None, "万人", "万人"], ["人口", "1100.5", "1200.7"], ["GDP", "5000.2", "6000.1"])
    assert cells(strategies.multi_header(two)) == [["人口", "1100.5", "1200.7"], ["GDP", "5000.2", "6000.1"]]
    assert [r["unique_name"] for r in strategies.header_names(two).orderBy("pos").collect()] == ["指标", "1990万人", "2000万人"]
    side = sheet(spark, ["A", "1990", None, None, "B", "2000"], ["x", "1", None, None, "y", "2"], ["z", "3", None, None, "w", "4"])
    got = strategies.horizontal_split(side)
    assert got.groupBy("sub_idx").count().orderBy("sub_idx").collect() == [(0, 2), (1, 2)]
    stacked = sheet(spark, ["年份", "GDP"], ["2020", "1.5"], [None, None], ["年份", "GDP"], ["2021", "2.5"])
    assert [(r["sub_idx"], r["cells"]) for r in strategies.vertical_subtable(stacked).orderBy("sub_idx").collect()] == [(0, ["2020", "1.5"]), (1, ["2021", "2.5"])]


def test_stacked_tables_keep_their_rows(spark):
    head, note = ["City", "State", "Count"], ["注：x", None, None]
    data = [["Beijing", "good", "12"], ["Total", "Total", None], ["Part two", None, None], ["Xian", "bad", "7"]]
    stacked = sheet(spark, ["Report one", None, None], head, *data, note, [None] * 3, ["Report two", None, None], head, *data[::-1][:1], *data)
    got = strategies.vertical_subtable(stacked).orderBy("sub_idx", "row_no").collect()
    assert [r["cells"] for r in got if r["sub_idx"] == 0] == data
    assert [r["cells"] for r in got if r["sub_idx"] == 1] == [data[3], *data]


@pytest.mark.parametrize("span", [2, 3, 4])
def test_records_are_folded_by_their_span_and_width(spark, span):
    rows = [["a", "b", "c", "d", "e"]]
    for k in range(6):
        rows += [[f"n{k}", "1", "2", "3", f"x{k}"], *([None, None, None, None, f"y{k}{j}"] for j in range(1, span))]
    df = sheet(spark, *rows)
    found = strategies.run_all(df, spark.createDataFrame([(df.first()["sheet"], "paired_row_bilingual")], "sheet string, strategy string"))
    got = cells(found["paired_row_bilingual"].orderBy("row_no"))
    assert [r[:5] for r in got] == [[f"n{k}", "1", "2", "3", f"x{k}"] for k in range(6)]
    names = found["paired_row_bilingual"].first()["names"]
    assert names == ["a", "b", "c", "d", "e", "a_续", "e_续"]  # the first cell is filled down before
    assert [r[6] for r in got] == [" ".join(f"y{k}{j}" for j in range(1, span)) for k in range(6)]


def test_log(spark, tmp_path):
    log = spark.createDataFrame([("a", "SUCCESS"), ("b", "ERROR")], "sheet string, status string")
    todo = spark.createDataFrame([("a",), ("b",), ("c",)], "sheet string")
    assert sorted(r[0] for r in ingest_log.unprocessed(todo, log, ["sheet"]).collect()) == ["b", "c"]
    rel = tables.relation(strategies.standard(sheet(spark, ["x"], ["1"], ["2"])), ["x"], "a\\b.xlsx", "S")
    tables.publish(rel, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.columns == ["x", "_source_file", "_sheet_name", "_row_number", "_created_at", "_table_description"]
    assert sorted(r["x"] for r in back.collect()) == ["1", "2"]
    with pytest.raises(ValueError, match="columns"):
        tables.relation(rel, [f"c{i}" for i in range(101)], "f", "s")


def test_table_function(spark):
    table_function.register(spark)
    sheet(spark, ["年份", "产量"], ["2020", "1.5"], [None, None], ["2021"]).createOrReplaceTempView("one_sheet")
    got = spark.sql("SELECT `产量`, `年份`, row_no FROM sheet_table(TABLE(one_sheet) PARTITION BY sheet ORDER BY (row_idx), array('产量', '年份', 'x')) ORDER BY row_no").collect()
    assert [tuple(r) for r in got] == [("1.5", "2020", 1), (None, "2021", 2)]
    with pytest.raises(Exception, match="constant array"):
        spark.sql("SELECT * FROM sheet_table(TABLE(one_sheet), array())")
