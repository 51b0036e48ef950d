"""Plans and parts of steps that ran out of time or memory on larger tables."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from gridloom.functions import text as t
from gridloom.operators import pairs
from gridloom.plans import strategies
from gridloom.session import dealt


def counted(rows):
    """The rows, and a count of how many of them were made, however often."""
    seen = rows.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(count, rows.schema), seen


def plan(df):
    with contextlib.redirect_stdout(out := io.StringIO()):
        df.explain()
    return out.getvalue()


def test_paired_records_meet_no_second_pass(spark):
    rows = spark.createDataFrame([(1, 0, ["a", "b", "c"]), (1, 1, ["x", "y", "1"]), (1, 2, [None, "z", None])], "sheet int, row_idx int, cells array<string>")
    out = strategies.paired_row_bilingual(rows)
    assert "Join" not in plan(out) and plan(out).count("Exchange hashpartitioning") == 1
    assert [(r.names, r.cells) for r in out.collect()] == [(["a", "b", "c", "a_续", "b_续"], ["x", "y", "1", "x", "z"])]


def test_span_by_windows_is_span_by_groups(spark):
    cells = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.when(i <= F.pmod(F.xxhash64("sheet", "row_idx", F.lit(3)), F.lit(5)), "x"))
    shaped = F.when((F.col("sheet") % 2 == 0) & (F.pmod(F.col("row_idx"), F.col("sheet") % 3 + 2) == 0), F.array(*[F.lit("x")] * 4)).when(F.col("sheet") % 2 == 0, F.array(F.lit("x"))).otherwise(cells)
    rows = spark.range(40).select(F.col("id").cast("int").alias("sheet"), F.explode(F.sequence(F.lit(0), F.lit(119))).alias("row_idx")).where("(sheet * 7 + row_idx) % 11 > 0 or sheet < 20").withColumn("cells", shaped)
    expected = {tuple(r) for r in pairs.record_span(pairs.record_span_scores(rows)).collect()}
    assert {tuple(r) for r in pairs.with_record_span(rows).select("sheet", "span").distinct().collect()} == expected
    assert len({span for _, span in expected}) == 3


def test_numeric_text_is_what_the_parser_takes(spark):
    texts = ["1", "-1.5", ".5", "5.", "1e3", "1E-3", "1d", "2.5F", " 7 ", "\t8\n", "NaN", "nan", "Infinity", "-inf", "+INF", "0x1p3", "0x1.8P-1", "F1", "1-URGENT", "", " ", ".", "-", "1,000", "1 2", "e3", "１", "infinit", "0x1", "1_0", None]
    df = spark.createDataFrame([(x,) for x in texts], "c string")
    assert [r.a for r in df.select(t.is_numeric_text(F.col("c")).alias("a")).collect()] == [r.a for r in df.select(F.col("c").try_cast("double").isNotNull().alias("a")).collect()]


def test_parts_grow_with_rows(spark):
    assert [dealt(spark.range(n), "id", each=10).rdd.getNumPartitions() for n in (0, 100, 1000)] == [spark.sparkContext.defaultParallelism, 10, 100]


def test_lines_are_dealt_once(spark):
    import __spark_entry__

    for name in ("enclosed_runs", "repeated_by_merge", "merged_header_names"):
        found = plan(__spark_entry__.queries()[name](spark, "/root/testdata/sf0.001"))
        assert found.count("Exchange hashpartitioning") == found.count("REPARTITION_BY_NUM") == 1, name


def test_sheets_of_orders_are_dealt_by_number(spark):
    from gridloom import queries_tables

    rows = queries_tables.numbered(queries_tables.orders(spark, "/root/testdata/sf0.001").withColumn("rows", F.array(queries_tables.row("a"))), ["n"])
    found = plan(rows)
    assert found.count("Exchange hashpartitioning") == found.count("REPARTITION_BY_NUM") == 1


def test_side_by_side_tables_are_prepared_once(spark):
    made = [["指标A", "1990", None, None, "指标B", "类别"], ["a", "1.5", None, None, "b", "2.5"], ["c", "3.5", None, None, "d", "4.5"]]
    rows, seen = counted(spark.createDataFrame([(s, i, cells) for s in range(4) for i, cells in enumerate(made)], "sheet int, row_idx int, cells array<string>"))
    hints = spark.createDataFrame([(0, 0, "left", 0, 1), (0, 1, "right", 4, 5)], "sheet int, sub_idx int, label string, col_start int, col_end int")
    told = hints.select("*", *(F.lit(None).cast("int").alias(c) for c in ("header_start", "header_end", "data_start", "data_end")))
    out = strategies.horizontal_split(rows, strategies.Extras(hints=told))
    assert {(r.sheet, r.sub_idx, r.label, r.row_no, tuple(r.cells)) for r in out.collect()} == {
        (s, k, ("left", "right")[k] if s == 0 else f"p{k + 1}", n, cells) for s in range(4) for k, n, cells in ((0, 1, ("a", "1.5")), (0, 2, ("c", "3.5")), (1, 1, ("b", "2.5")), (1, 2, ("d", "4.5")))
    }
    assert seen.value == 12


def test_names_of_side_by_side_tables_are_made_in_dealt_tasks(spark):
    import __spark_entry__

    found = plan(__spark_entry__.queries()["side_by_side_tables"](spark, "/root/testdata/sf0.001"))
    assert found.count("Exchange hashpartitioning") == found.count("REPARTITION_BY_NUM") > 0


def test_sheets_under_headers_of_several_rows_are_prepared_once(spark):
    stacked = [["指标", "1990"], ["a", "1.5"], ["b", "2.5"], [None, None], ["来源类", None], ["项目", "年份"], ["c", "3.5"]]
    late = [[None, None], [None, None], ["x", "1.5"], ["y", "2.5"]]  # data at once, under blank rows: its first row is header and data
    made = [(s, i, cells) for s, sheet in ((0, stacked), (1, stacked), (2, late)) for i, cells in enumerate(sheet)]
    rows, seen = counted(spark.createDataFrame(made, "sheet int, row_idx int, cells array<string>"))
    out = {(r.sheet, r.sub_idx, r.label, tuple(r.names), r.row_no, tuple(r.cells)) for r in strategies.multi_header(rows).collect()}
    both = [(0, "p1", ("指标", "y_1990"), 1, ("a", "1.5")), (0, "p1", ("指标", "y_1990"), 2, ("b", "2.5")), (1, "p2", ("项目", "年份"), 1, ("c", "3.5"))]
    assert {r for r in out if r[0] < 2} == {(s, *r) for s in (0, 1) for r in both}
    assert {r[5] for r in out if r[0] == 2} == {("x", "1.5"), ("y", "2.5")}
    assert seen.value == len(made)


def test_splits_meet_their_rows_without_a_join(spark):
    import __spark_entry__

    assert "Join" not in plan(__spark_entry__.queries()["begins_of_subtables"](spark, "/root/testdata/sf0.001"))
