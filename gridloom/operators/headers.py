"""Header rows and their names: where they are, values that merged cells repeat, and names for columns without any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t
from gridloom.operators import layout, naming, ranges
from gridloom.operators import predicates as p


def header_end_by_content(rows: DataFrame) -> DataFrame:
    """(sheet, header_end): the last header-like row of several cells above the data; no row for a sheet without one."""
    cells = F.col("cells")
    above = rows.join(ranges.data_start(rows), "sheet").where(F.col("row_idx") < F.col("data_start"))
    return above.where(p.is_header_like(cells) & (p.n_filled(cells) > 1)).groupBy("sheet").agg(F.max("row_idx").alias("header_end"))


def paired_header(rows: DataFrame) -> DataFrame:
    """(sheet, header_row, title_row): the first row, neither blank nor a title, of which half or more is text; else the first such row.

    title_row is the nearest title or lone text above it, 0 if there is none.
    """
    cells = F.col("cells")
    full = rows.where(~p.is_blank(cells))
    texts = F.size(F.filter(p.filled(cells), lambda c: ~t.is_numeric_text(c)))
    first = F.min(F.when(~p.is_title(cells) & (texts >= 0.5 * p.n_filled(cells)), F.col("row_idx")))
    heads = full.groupBy("sheet").agg(F.coalesce(first, F.min(F.when(~p.is_title(cells), F.col("row_idx")))).alias("header_row")).where(F.col("header_row").isNotNull())
    title = F.max(F.when((F.col("row_idx") < F.col("header_row")) & (p.is_title(cells) | (p.n_filled(cells) == 1)), F.col("row_idx")))
    return full.join(heads, "sheet").groupBy("sheet", "header_row").agg(F.coalesce(title, F.lit(0)).alias("title_row"))


def with_paired_header(rows: DataFrame) -> DataFrame:
    """Rows with ``header_row``, told by windows: as paired_header finds it; NULL for a sheet without one."""
    looked = t.let(p.filled(F.col("cells")), lambda f: F.struct(((F.size(f) > 0) & ~p.is_title(f)).alias("plain"), (F.size(F.filter(f, lambda c: ~t.is_numeric_text(c))) >= 0.5 * F.size(f)).alias("texts")))
    marked = rows.withColumn("looked", looked)
    first = F.min(F.when(F.col("looked.plain") & F.col("looked.texts"), F.col("row_idx"))).over(layout.whole())
    return marked.withColumn("header_row", F.coalesce(first, F.min(F.when(F.col("looked.plain"), F.col("row_idx"))).over(layout.whole()))).drop("looked")


def repeated_by_merge(cells: DataFrame) -> DataFrame:
    """Header cells (sheet, row_idx, col_idx, value) with ``repeats``: a value that its left neighbour has too, in a column
    that lower header rows tell from that neighbour's (they have a value here that the left lacks, or another one)."""
    value = F.when(~t.blank(F.col("value")), t.uni_trim(F.col("value")))
    across = W.partitionBy("sheet", "row_idx").orderBy("col_idx")
    beside = cells.withColumn("v", value)
    near = F.lag("col_idx").over(across) == F.col("col_idx") - 1
    beside = beside.withColumn("left", F.when(near, F.lag("v").over(across)))
    apart = F.col("v").isNotNull() & (F.col("left").isNull() | (F.col("left") != F.col("v")))
    below = W.partitionBy("sheet", "col_idx").orderBy("row_idx").rowsBetween(1, W.unboundedFollowing)
    repeats = (F.col("v") == F.col("left")) & (F.max(apart.cast("int")).over(below) == 1)
    return beside.withColumn("repeats", F.coalesce(repeats, F.lit(False))).drop("v", "left")


def merged_names(cells: DataFrame, first_texts: DataFrame | None = None) -> DataFrame:
    """(sheet, col_idx, name) as naming.merged_header, but a value that a merged cell repeats counts only at a column's top.

    first_texts: sheets whose first column holds texts; without a header it is called 项目.
    """
    marked = repeated_by_merge(cells)
    above = W.partitionBy("sheet", "col_idx").orderBy("row_idx").rowsBetween(W.unboundedPreceding, -1)
    begun = F.coalesce(F.max((~t.blank(F.col("value"))).cast("int")).over(above), F.lit(0)) == 1
    named = naming.merged_header(marked.withColumn("begun", begun).withColumn("value", F.when(~(F.col("repeats") & F.col("begun")), F.col("value"))).select("sheet", "row_idx", "col_idx", "value"))
    if first_texts is None:
        return named
    known = first_texts.select("sheet", F.lit(True).alias("texts")).distinct()
    unnamed = (F.col("col_idx") == 0) & (F.col("name") == "col_0") & F.col("texts")
    return named.join(known, "sheet", "left").withColumn("name", F.when(unnamed, "项目").otherwise(F.col("name"))).drop("texts")


def first_column_texts(rows: DataFrame, header_end: DataFrame, n: int = 10) -> DataFrame:
    """(sheet): where, in the ``n`` rows under the header, the first column has two values or more, most of them texts."""
    first = F.get("cells", F.lit(0))
    under = rows.join(header_end, "sheet").where((F.col("row_idx") > F.col("header_end")) & (F.col("row_idx") <= F.col("header_end") + n) & ~t.blank(first))
    text = ~F.replace(t.uni_trim(first), F.lit(" "), F.lit("")).rlike(r"^-?[\d,]+\.?\d*$")
    counts = under.groupBy("sheet").agg(F.count(F.lit(1)).alias("n"), F.count_if(text).alias("texts"))
    return counts.where((F.col("n") >= 2) & (F.col("texts") > 0.5 * F.col("n"))).select("sheet")


def from_left(left: Column, own: Column) -> Column:
    """The name of a column without one of its own, by the name on its left: what both begin with, else that name's leading
    year, else the longest beginning of it that ``own`` holds, and then ``own`` (the texts that its left neighbour lacks).

    NULL if there is nothing of its own or in common, or the left name is a placeholder or in common as a whole.
    """
    upto = F.sequence(F.lit(1), F.greatest(F.least(F.length(left), F.length(own)), F.lit(1)))
    common = F.array_max(F.filter(upto, lambda k: F.substring(left, F.lit(1), k) == F.substring(own, F.lit(1), k)))
    held = F.array_max(F.filter(upto, lambda k: own.contains(F.substring(left, F.lit(1), k))))
    year = F.nullif(F.regexp_extract(left, r"^(\d{4}年?)", 1), F.lit(""))
    prefix = F.coalesce(F.substring(left, F.lit(1), common), year, F.substring(left, F.lit(1), held))
    made = t.sanitise(F.concat(prefix, own))
    usable = (own != "") & ~left.startswith("col_") & (prefix != left) & ~made.startswith("col_")
    return F.when(F.coalesce(usable, F.lit(False)), made)


def block_names(block: Column, first_texts: Column, gaps: bool = False) -> Column:
    """Names of the columns of a header block (array of rows of cells), made from left to right in one fold.

    A block of one row gives its texts.  Of several rows, a column's texts count from top to bottom: none twice in a row;
    one that a merged cell repeats (its left neighbour has it too, and a lower row tells the two columns apart) only while
    the column has no other; digits without spaces between them.  They are joined, or, if that is a placeholder, joined by ``_``; a short
    Chinese name loses marks and spaces.  A column without texts is 项目 if it is the first and holds texts, else col_<i>.

    gaps: a column whose top row is blank, beside one that has a name, is named from_left, by the name just made.
    """
    trimmed = F.transform(block, lambda row: F.transform(row, lambda c: F.nullif(t.uni_trim(c), F.lit(""))))
    none = F.array().cast("array<string>")

    def of(rows: Column) -> Column:
        width = F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))
        columns = F.when(width > 0, F.sequence(F.lit(0), width - 1)).otherwise(F.array().cast("array<int>"))
        return F.when(F.size(rows) == 1, F.transform(F.get(rows, F.lit(0)), lambda c, j: one(c, j))).otherwise(
            F.aggregate(columns, none, lambda made, j: F.concat(made, F.array(several(rows, made, j))))
        )

    def one(c: Column, j: Column) -> Column:
        return F.when(c.isNull(), F.when((j == 0) & first_texts, "项目").otherwise("col_empty")).otherwise(t.sanitise(c))

    def several(rows: Column, made: Column, j: Column) -> Column:
        here, left = F.transform(rows, lambda row: F.get(row, j)), F.transform(rows, lambda row: F.when(j > 0, F.get(row, j - 1)))
        both = F.zip_with(here, left, lambda v, b: F.struct(v.alias("v"), F.coalesce(v == b, F.lit(False)).alias("same"), (v.isNotNull() & ~F.coalesce(v == b, F.lit(False))).alias("apart")))

        def marked(x: Column) -> Column:
            return F.transform(x, lambda r, i: F.struct(t.header_spaces(F.regexp_replace(r.v, " {2,}", " ")).alias("v"), (r.same & F.exists(F.slice(x, i + 2, F.size(x)), lambda y: y.apart)).alias("repeats"), r.same.alias("same")))

        def add(parts: Column, r: Column) -> Column:
            return F.when(r.v.isNull() | (F.size(parts) > 0) & (r.repeats | (F.element_at(parts, -1) == r.v)), parts).otherwise(F.concat(parts, F.array(r.v)))

        def named(x: Column) -> Column:
            context = F.lit(None).cast("string")
            if gaps:
                own = F.array_join(F.transform(F.filter(x, lambda r: ~r.same), lambda r: r.v), "")
                context = F.when(F.get(x, F.lit(0)).v.isNull() & (j > 0), t.let(F.element_at(made, -1), lambda name: from_left(name, own)))
            parts = F.aggregate(F.filter(x, lambda r: r.v.isNotNull()), none, add)
            blank = F.when((j == 0) & first_texts, "项目").otherwise(F.concat(F.lit("col_"), j.cast("string")))
            return F.coalesce(context, t.let(parts, lambda y: F.when(F.size(y) == 0, blank).otherwise(joined(y))))

        return t.let(t.let(both, marked), named)

    def joined(parts: Column) -> Column:
        direct = F.array_join(parts, "")
        bare = F.regexp_replace(F.replace(direct, F.lit(" "), F.lit("")), t.NOISE, "")
        plain = t.sanitise(direct)
        return F.when(bare.rlike(f"^{t.CJK}{{2,12}}$"), bare).when(~plain.startswith("col_"), plain).otherwise(t.sanitise(F.array_join(parts, "_")))

    return t.let(trimmed, of)


def distinct_names(names: Column) -> Column:
    """The k-th repeat of a name gets ``_k``, and none is called id."""

    def numbered(held: Column) -> Column:
        return F.transform(held, lambda x, i: t.reserve_id(t.numbered(x, F.size(F.filter(F.slice(held, F.lit(1), i), lambda y: y == x)))))

    return t.let(names, numbered)


def block_header(block: Column, first_texts: Column, advised: Column | None = None, confidence: Column | None = None, gaps: bool = False) -> Column:
    """A struct of ``names``, unique and safe, and ``rows``, how many rows of the block they come from.

    A block of several rows whose names are numbers is taken for one that ends with data, and loses its last row.  An
    advisor's names, of a block of several rows, are merged in (naming.fuse) and made unique again.
    """

    n = F.size(block)
    made = lambda rows: distinct_names(block_names(rows, first_texts, gaps))

    def chosen(names: Column) -> Column:
        """The shorter block's names are made only where they are asked for."""
        less = F.coalesce(p.numeric_names(names) & (n > 1), F.lit(False))
        shorter = F.when(less, made(F.slice(block, F.lit(1), F.greatest(n - 1, F.lit(1)))))
        return F.struct(F.when(less, shorter).otherwise(names).alias("names"), (n - less.cast("int")).alias("rows"))

    def fused(x: Column) -> Column:
        names = F.when(x.rows > 1, distinct_names(naming.fuse(x.names, advised, confidence))).otherwise(x.names)
        return F.struct(names.alias("names"), x.rows.alias("rows"))

    out = t.let(made(block), chosen)
    return out if advised is None else t.let(out, fused)


def subtable_name(name: Column, index: Column, count: Column, limit: int = 64) -> Column:
    """The table's name, with ``_p<k>`` for the k-th of several sub-tables, cut so that it all fits."""
    suffix = F.concat(F.lit("_p"), (index + 1).cast("string"))
    return F.when(count <= 1, name).otherwise(F.concat(F.substr(name, F.lit(1), (F.lit(limit) - F.length(suffix)).cast("int")), suffix))


def overridden(names: Column, given: Column) -> Column:
    """The given names, if they are as many."""
    return F.when(F.size(names) == F.size(given), given).otherwise(names)


def merged_descriptions(described: DataFrame) -> DataFrame:
    """(sheet, key, description) of (sheet, sub_idx, key, description): a key of several sub-tables gets ``_p<k>`` after its first."""
    first = F.row_number().over(W.partitionBy("sheet", "key").orderBy("sub_idx")) == 1
    key = F.when(F.col("first"), F.col("key")).otherwise(F.concat("key", F.lit("_p"), (F.col("sub_idx") + 1).cast("string")))
    return described.withColumn("first", first).select("sheet", key.alias("key"), "description")
