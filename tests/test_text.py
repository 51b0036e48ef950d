from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridloom.functions import text as t


def values(spark, f, cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("c"))).collect()]


def check(spark, f, expected: dict):
    assert values(spark, f, list(expected)) == list(expected.values())


def test_clean(spark):
    check(spark, t.clean, {None: None, "": None, "  ": None, "nan": None, "NaN": None, "1,234": "1234", "1,234.56": "1234.56", "1 234": "1234", "a,b": "a,b", "北京": "北京", "hello world": "hello world", "1,2,3": "1,2,3", "34 5": "34.5", "　12　": "12", "1,234,567": "1234567"})


def test_clean_is_idempotent(spark):
    cases = ["1,234", " 12 345.6 ", "3 4", "x  y", "1,2,3", "-1,000", "１２", "12,34,56.7"]
    once = values(spark, t.clean, cases)
    assert values(spark, t.clean, once) == once


def test_spaces(spark):
    check(spark, t.normalise, {" a   b ": "a b", "  ": None, None: None})
    check(spark, t.leading_spaces, {"a": 0, "  a": 2, "    b": 4})
    check(spark, t.header_spaces, {"1 9 8 6年": "1986年", "2 0 6 7": "2067"})


@pytest.mark.parametrize("text", ["注：含港澳", "备注", "说明 1", "附注", "数据来源：局", "资料来源：国家统计局", "Note: x", "Source: y", "* star", "① one", "(1)说明"])
def test_footnotes(spark, text):
    assert values(spark, t.is_footnote_text, [text]) == [True]


@pytest.mark.parametrize("text", ["北京", "总计", "1234", "注册资本", None])
def test_no_footnotes(spark, text):
    assert values(spark, t.is_footnote_text, [text]) == [False]


def test_categories_and_supplements(spark):
    check(spark, t.is_category_title, {"一、综合": True, "（一）人口": True, "(二) 产业": True, "1. 农业": True, "1.": False, "总计": False, "北京": False})
    check(spark, t.is_header_supplement, {"以1990年为100": True, "2000年": False, "占比%": False, None: False})
    check(spark, t.is_numeric_text, {"1e3": True, "x": False, "-2.5": True})


def test_sanitise(spark):
    check(spark, t.sanitise, {"a/b c-d": "a_b_c_d", "(总计)": "总计", "a__b": "a_b", None: "col_unknown", "": "col_empty", "  ": "col_empty", "---": "col_empty", "1990": "y_1990", "é1": "é1", "x" * 80: "x" * 64})
    check(spark, t.reserve_id, {"ID": "row_id", "user_id": "user_id"})


def test_paths_and_tables(spark):
    long = "/".join(["dir"] * 80) + "/f.xlsx"
    check(spark, t.source_file, {"a\\b\\c.xlsx": "a/b/c.xlsx", long: "dir/dir/f.xlsx"})
    one = spark.range(1).select(t.placeholder_table(F.lit("ERROR"), F.lit("a b.xls"), F.lit(""), F.lit(2)), t.fallback_table(F.lit("in/年 报.xlsx"), F.lit("S 1"), F.lit(0))).first()
    assert tuple(one) == ("ERROR_a_b_xls_s2", "ods_年_报_S_1_s0")


def test_types_and_json(spark):
    df = spark.createDataFrame([(10,), (600,), (20_000,), (70_000,)], "n long")
    assert [r[0] for r in df.select(t.column_type(F.col("n"))).collect()] == ["VARCHAR(512)", "VARCHAR(1024)", "TEXT", "MEDIUMTEXT"]
    check(spark, lambda c: F.get_json_object(t.recovered_json(c), "$.k"), {'{"k": 1}': "1", 'so:\n```json\n{"k": 2}\n```': "2", 'it is {"k": 3} I say': "3", "{no": None, None: None})


def test_white_space_at_the_ends(spark):
    check(spark, t.uni_trim, {None: None, "": "", "\u3000 a b\u00a0\t": "a b", "\u2028\x85北京\u205f": "北京", "\u200b": "\u200b", "\u1680\u2009": ""})
    check(spark, t.bare_number, {None: "", "1, 2\u30003": "123", "a": "a"})
