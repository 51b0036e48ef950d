"""Column and table names over tables of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t


def unique_names(names: DataFrame, group: str = "sheet", order: str = "pos", name: str = "name") -> DataFrame:
    """The k-th repeat of a name in its group gets ``_k``; the first stays."""
    seen = F.row_number().over(W.partitionBy(group, name).orderBy(order)) - 1
    return names.withColumn("seen", seen).withColumn("unique_name", t.numbered(F.col(name), F.col("seen"))).drop("seen")


def unique_names_of_one(names: DataFrame, order: str = "pos", name: str = "name", bucket: int = 8192) -> DataFrame:
    """As unique_names, for one large group in the order of an integer key: no window holds more than a bucket of keys, or a row a bucket."""
    dealt = names.withColumn("bucket", F.floor(F.col(order) / bucket))
    counts = dealt.groupBy(F.col(name).alias("n"), F.col("bucket").alias("b")).agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(W.partitionBy("n").orderBy("b").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select("n", "b", F.coalesce(before, F.lit(0)).alias("before"))
    here = F.row_number().over(W.partitionBy(name, "bucket").orderBy(order)) - 1
    joined = dealt.withColumn("here", here).join(counts, F.col(name).eqNullSafe(F.col("n")) & F.col("bucket").eqNullSafe(F.col("b")))
    return joined.withColumn("unique_name", t.numbered(F.col(name), F.col("before") + F.col("here"))).drop("bucket", "here", "n", "b", "before")


def merged_header(cells: DataFrame) -> DataFrame:
    """(sheet, col_idx, name) from header cells (sheet, row_idx, col_idx, value): non-blank texts from top to bottom, no text
    twice in a row; a short Chinese name stays as it is, any other is sanitised; an empty column is ``col_<i>``."""
    kept = F.collect_list(F.when(~t.blank(F.col("value")), F.struct("row_idx", t.uni_trim(F.col("value")).alias("v"))))
    parts = F.transform(F.array_sort(kept), lambda x: x.v)
    distinct = F.filter(parts, lambda v, i: (i == 0) | (v != F.get(parts, i - 1)))
    by = cells.groupBy("sheet", "col_idx").agg(distinct.alias("parts"))
    joined = F.array_join("parts", "")
    bare = F.regexp_replace(joined, t.NOISE, "")
    name = F.when(joined == "", F.concat(F.lit("col_"), F.col("col_idx").cast("string"))).when(bare.rlike(f"^{t.CJK}{{2,12}}$"), bare).otherwise(t.sanitise(joined))
    return by.select("sheet", "col_idx", name.alias("name"))


def fuse(code: Column, advised: Column, confidence: Column) -> Column:
    """The names from the cells or the advisor's, by its confidence: all from 0.8 up if none is a placeholder; one by one
    from 0.6 up; the advisor's only where the own name is a placeholder below that.  Widths must agree."""
    bad = lambda n: n.isNull() | n.rlike(r"^col_(\d+|empty|unknown)$")
    one = F.zip_with(code, advised, lambda c, a: F.when(bad(a), c).when(bad(c) | (confidence >= 0.6), a).otherwise(c))
    whole = (confidence >= 0.8) & ~F.exists(advised, bad)
    return F.when(advised.isNull() | (F.size(code) != F.size(advised)), code).when(whole, advised).otherwise(one)


# Words of headers and what they are in English.
PARTS = {
    "指标": "indicator", "单位": "unit", "项目": "item", "地区": "region", "类别": "category", "名称": "name", "年份": "year",
    "产量": "output", "面积": "area", "数量": "count", "金额": "amount", "比例": "ratio", "百分比": "pct", "增长率": "growth_rate",
    "合计": "total", "总计": "total", "小计": "subtotal", "平均值": "avg", "产品": "product", "价格": "price", "成本": "cost",
    "收入": "income", "支出": "expenditure", "消费": "consumption", "年": "year", "月": "month", "日": "day",
}


def english_part(c: Column) -> Column:
    """A header word in English; of one with marks or spaces in it, without these; ``col`` if it isn't known."""
    known = F.create_map(*(F.lit(x) for pair in PARTS.items() for x in pair))
    bare = F.regexp_replace(c, "[，。、；：“”‘’（）\\s]+", "")
    return F.coalesce(F.try_element_at(known, F.trim(c)), F.try_element_at(known, bare), F.lit("col"))


#: Words in a source's name and what stands for them in English.
KEYWORDS = {
    "指标": "indicator", "单位": "unit", "项目": "item", "地区": "region", "类别": "category", "名称": "name", "年份": "year", "产量": "output",
    "面积": "area", "数量": "count", "合计": "total", "总计": "total", "序号": "seq", "编号": "code", "代码": "code", "月份": "month",
    "省份": "province", "城市": "city", "县": "county", "产品": "product", "价格": "price", "成本": "cost", "收入": "income", "消费": "consumption",
    "指数": "index", "比例": "ratio", "百分比": "pct", "增长率": "growth", "值": "value", "数": "count", "量": "qty",
}
DIGITS = r"(\d+)"


def _appended(name: Column, numbers: Column, always: bool) -> Column:
    def add(out: Column, n: Column) -> Column:
        longer = F.concat(F.rtrim(out, F.lit("_")), F.lit("_"), n)
        return longer if always else F.when(F.contains(out, n), out).otherwise(longer)

    return F.aggregate(numbers, name, add)


def repair_digits(source: Column, english: Column) -> Column:
    """The English name with the source's numbers, by what it has of them.

    A year (four digits) in the source, but none of its years in the name: the name's letters up to its first number, or the
    source's text in English, and then all its numbers.  No number in the name: they follow it.  As many as the source has,
    or more: they are replaced one by one, from the left.  Fewer: those that it lacks follow it.
    """
    wanted, found = F.regexp_extract_all(source, F.lit(DIGITS), 1), F.regexp_extract_all(english, F.lit(DIGITS), 1)

    def rebuilt(w: Column) -> Column:
        bare = F.trim(F.regexp_replace(source, r"\d+", ""))
        letters = F.regexp_extract(english, r"^([a-z_]+?)_?\d", 1)
        prefix = F.when(letters == "", english_part(bare)).otherwise(F.rtrim(letters, F.lit("_")))
        return F.array_join(F.concat(F.when(prefix == "", F.array().cast("array<string>")).otherwise(F.array(prefix)), w), "_")

    def replaced(w: Column, f: Column) -> Column:
        gaps = F.split(english, r"\d+", -1)
        return F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(w, i), F.get(f, i), F.lit("")))), "")

    def by_branch(w: Column, f: Column) -> Column:
        years = F.filter(w, lambda n: F.length(n) == 4)
        return (
            F.when(F.size(w) == 0, english)
            .when((F.size(years) > 0) & ~F.exists(years, lambda y: F.contains(english, y)), rebuilt(w))
            .when(F.size(f) == 0, _appended(english, w, True))
            .when(F.size(f) >= F.size(w), replaced(w, f))
            .otherwise(_appended(english, w, False))
        )

    return t.let(wanted, lambda w: t.let(found, lambda f: by_branch(w, f)))


def repair_meaning(source: Column, english: Column, words: dict[str, str] | None = None) -> Column:
    """The English name, or the source's known words (KEYWORDS, if none are given) joined, where none of them is in it and it is not long and detailed.

    A source with numbers is left alone if the name has one of them; else those that it lacks follow the words.
    """
    pairs = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in (words or KEYWORDS).items()))
    bare = F.replace(source, F.lit("_"), F.lit(""))
    numbers = F.regexp_extract_all(source, F.lit(DIGITS), 1)
    parts = F.transform(F.filter(pairs, lambda x: F.contains(source, x.k) | F.contains(bare, x.k)), lambda x: x.v)
    detailed = (F.length(english) >= 15) & (F.length(english) - F.length(F.replace(english, F.lit("_"), F.lit(""))) >= 2)

    def judged(held: Column) -> Column:
        known = F.exists(numbers, lambda n: F.contains(english, n))
        off = (F.size(held) > 0) & ~F.exists(held, lambda v: F.contains(F.lower(english), v))
        lacking = F.filter(numbers, lambda n: ~F.contains(english, n))
        return F.when(off & ~known & ~detailed, F.array_join(F.concat(held, lacking), "_")).otherwise(english)

    return t.let(parts, judged)


def repaired(sources: Column, english: Column) -> Column:
    """English names repaired one by one (digits, then meaning); as they are where they are not as many as their sources."""
    each = F.zip_with(sources, english, lambda s, e: t.let(repair_digits(s, e), lambda d: repair_meaning(s, d)))
    return F.when(F.size(sources) == F.size(english), each).otherwise(english)


def english_names(names: Column) -> Column:
    """Names in English where their text is a known word, with their numbers after it; else as they are."""

    def one(name: Column) -> Column:
        part = english_part(F.regexp_replace(F.regexp_replace(name, "^y_", ""), r"[\d_]+", ""))
        return F.when(part == "col", name).otherwise(F.array_join(F.concat(F.array(part), F.regexp_extract_all(name, F.lit(DIGITS), 1)), "_"))

    return F.transform(names, one)
