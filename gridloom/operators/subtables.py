"""Sub-tables stacked in a sheet: where they split, where each one's header and data are, and reading regions out.

Rows are (sheet, row_idx, cells), with the edge columns ``bottom_ratio``, ``top_ratio``, ``is_solid`` and ``is_dash`` where
borders are known (borders.row_edges), and ``border`` where a row's lower edge closes a group of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t
from gridloom.operators import borders, fill, headers, layout, ranges
from gridloom.operators import predicates as p
from gridloom.operators.layout import above, at, below, down, whole
from gridloom.session import cut

EDGES = ("bottom_ratio", "top_ratio", "is_solid", "is_dash")
#: Rows after a split in which a border can end the new header; rows in which a border's split must show a new table.
LOCAL, NEAR = 15, 5


def spaced(splits: Column, least: int = 3) -> Column:
    """Of split rows in ascending order those that are ``least`` or more from the last one kept."""
    none = F.array().cast("array<int>")
    return F.aggregate(splits, none, lambda kept, s: F.when((F.size(kept) == 0) | (s - F.element_at(kept, -1) >= least), F.concat(kept, F.array(s))).otherwise(kept))


def marks(rows: DataFrame) -> DataFrame:
    """What rows are, without their cells: blank, note, lone (one cell), header (header-like), data, heavy (with numbers), text (the first)."""
    cells = F.col("cells")
    told = layout.with_data_start(rows)
    edges = [c for c in EDGES if c in rows.columns]
    looked = told.select("sheet", "row_idx", "data_start", *edges, p.kinds(cells).alias("k"), p.is_footnote(cells).alias("note"), layout.data_start(cells)[0].alias("data"), layout.numbers_in(cells).alias("heavy"), p.first_filled(cells).alias("text"))
    return looked.select("sheet", "row_idx", "data_start", *edges, (F.col("k.n_filled") == 0).alias("blank"), "note", (F.col("k.n_filled") == 1).alias("lone"), F.col("k.is_header_like").alias("header"), "data", "heavy", "text")


def with_header_end(marked: DataFrame) -> DataFrame:
    """With ``header_end``: what borders say or, if that is less or all there is, the last header-like row above the data; NULL for none."""
    content = F.max(F.when(F.col("header") & (at() < F.col("data_start")), at())).over(whole())
    if "is_solid" not in marked.columns:
        return marked.withColumn("header_end", content)
    bound = borders.is_boundary(F.col("bottom_ratio"), F.col("is_solid"), F.col("is_dash"))
    told = layout.with_border_header(marked.withColumn("boundary", bound), heavy=F.col("heavy"))
    return told.withColumn("header_end", F.least("border_end", content)).drop("border_end")


def with_splits(marked: DataFrame) -> DataFrame:
    """(sheet, row_idx, …) of rows with ``header_end``, with ``by_content`` and ``by_border``: whether a row is the last one before a further table.

    By content: a blank row, two or more under the header, begins a gap (footnotes may follow) after which comes a
    header-like row, or a lone text and then one.  By border: a boundary parted from the next one by a bare row and two
    open ones, if a blank row or a lone text over a header-like row is among the NEAR rows after it.
    """
    content = ~F.col("blank") & ~F.col("note")
    ahead = F.last(F.when(content, F.struct("row_idx", "header", "lone")), ignorenulls=True).over(below())
    gap = F.last(F.when(F.col("blank") & (at() >= F.col("header_end") + 2), at()), ignorenulls=True).over(below())
    seen = marked.withColumn("ahead", ahead).withColumn("gap", gap)
    seen = seen.withColumn("before", F.last(F.when(content, F.struct("row_idx", "lone", "gap")), ignorenulls=True).over(above()))
    parted = F.coalesce(F.col("before.gap") < at(), F.lit(False)) & content
    seen = seen.withColumn("parted", parted)
    title = F.col("parted") & F.col("lone") & F.coalesce(F.col("ahead.header"), F.lit(False))
    taken = F.coalesce(F.last(F.when(content, title), ignorenulls=True).over(above()), F.lit(False))  # as the header of the title above
    seen = seen.withColumn("title", title).withColumn("taken", taken)
    begins = F.col("title") | (F.col("parted") & F.col("header") & ~F.col("taken"))
    # the split stands before the gap's first blank row, which lies above the row that begins
    opened = F.last(F.when(begins, F.col("before.gap") - 1), ignorenulls=True).over(below())
    seen = seen.withColumn("by_content", F.coalesce(opened == at(), F.lit(False)))
    if "is_solid" not in marked.columns:
        return seen.withColumn("by_border", F.lit(False)).drop("ahead", "gap", "before", "parted", "title", "taken")
    under = at() > F.col("header_end")
    strong = F.col("is_solid") & (F.col("bottom_ratio") >= 0.7)
    few = F.coalesce(F.sum((strong & under).cast("int")).over(whole()), F.lit(0)) < 2
    seen = seen.withColumn("bound", under & (strong | (few & F.col("is_dash") & (F.col("bottom_ratio") >= 0.3))))
    is_open = (~F.col("boundary")).cast("int")
    bare = ((F.col("bottom_ratio") < 0.1) & (F.col("top_ratio") < 0.1)).cast("int")
    seen = seen.withColumn("opens", F.sum(is_open).over(down())).withColumn("bares", F.sum(bare).over(down()))
    later = F.last(F.when(F.col("bound"), F.struct((F.col("opens") - is_open).alias("o"), (F.col("bares") - bare).alias("b"))), ignorenulls=True).over(below())
    filled = F.last(F.when(~F.col("blank"), F.struct("row_idx", "header")), ignorenulls=True).over(below())
    seen = seen.withColumn("later", later).withColumn("filled", filled)
    shows = F.when(F.col("blank"), at()).when(F.col("lone") & F.col("filled.header"), F.col("filled.row_idx"))
    near = F.min(shows).over(W.partitionBy("sheet").orderBy("row_idx").rowsBetween(1, NEAR))
    apart = (F.col("later.o") - F.col("opens") >= 2) & (F.col("later.b") - F.col("bares") >= 1)
    by_border = F.coalesce(F.col("bound") & apart & (near <= at() + NEAR), F.lit(False))
    return seen.withColumn("by_border", by_border).drop("ahead", "gap", "before", "parted", "title", "taken", "bound", "opens", "bares", "later", "filled")


def vertical_splits(rows: DataFrame) -> DataFrame:
    """(sheet, splits): each sheet's split rows by border and content, in ascending order and three or more apart; of four rows at least."""
    return _kept(with_splits(with_header_end(marks(rows))))


def _kept(split: DataFrame) -> DataFrame:
    found = split.where(F.col("by_content") | F.col("by_border")).groupBy("sheet").agg(spaced(F.sort_array(F.collect_set("row_idx"))).alias("splits"))
    return found.join(split.groupBy("sheet").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 4).select("sheet"), "sheet", "left_semi")


def vertical_regions(rows: DataFrame) -> DataFrame:
    """(sheet, sub_idx, label, header_start, header_end, data_start, data_end) of sheets with two tables or more; data_end is not part of it.

    The first table has the sheet's header.  A further one begins after its split: with a lone text over a header-like
    row, which is its label, or with such a row; its header ends where these rows do or one is data, or at a border before
    that, or at a later one on a header-like row.  One that begins otherwise has no header of its own: the last one's holds for it, and
    it is data from its first row that is no lone text.  Labels are at most 30 characters, p<k> where there is no title.
    """
    split = cut(with_splits(with_header_end(marks(rows))))  # what rows are, without their cells
    begins = _kept(split).select("sheet", F.explode("splits").alias("split")).select("sheet", (F.col("split") + 1).alias("row_idx"), F.lit(1).alias("begin"))
    content = ~F.col("blank") & ~F.col("note")
    ends = F.coalesce(F.last(F.when(~F.col("header") | F.col("data"), at()), ignorenulls=True).over(below()), F.max(at()).over(whole()) + 1) - 1
    told = split.join(begins, ["sheet", "row_idx"], "left").withColumn("run_end", F.when(F.col("header"), ends).cast("int"))
    told = told.withColumn("sub_idx", F.sum(F.coalesce("begin", F.lit(0))).over(down()).cast("int"))
    told = told.withColumn("ahead", F.last(F.when(content, F.struct("row_idx", "header", "run_end")), ignorenulls=True).over(below()))
    told = told.withColumn("over", F.last(F.when(~F.col("blank"), F.struct("row_idx", "lone", "text")), ignorenulls=True).over(above()))
    told = told.withColumn("stop", F.max(F.when(F.col("lone") & (at() <= F.col("header_end")), at())).over(whole()))
    told = told.withColumn("start", F.min("row_idx").over(W.partitionBy("sheet", "sub_idx")))
    bound = F.col("boundary") if "boundary" in told.columns else F.lit(False)
    near = F.when(at() < F.col("start") + LOCAL, F.struct("row_idx", bound.alias("bound"), "heavy", "header", "lone", (~F.col("blank") & ~F.col("lone")).alias("multi")))
    inside = at() <= F.col("header_end")
    by = told.groupBy("sheet", "sub_idx").agg(
        F.min(F.when(content, F.struct("row_idx", "lone", "header", "text", "run_end", "ahead"))).alias("first"),
        F.array_sort(F.collect_list(near)).alias("near"),
        F.min("header_end").alias("sheet_end"),
        F.max(F.when((at() == F.col("header_end")) & F.col("over.lone"), F.col("over"))).alias("title"),
        F.min(F.when(inside & ~F.col("blank") & ~F.col("lone") & (at() > F.coalesce("stop", F.lit(-1))), at())).alias("top"),
        F.min(F.when(content & ~F.col("lone"), at())).alias("plain"),
        (F.max("row_idx") + 1).alias("data_end"),
    )
    titled = F.col("first.lone") & F.coalesce(F.col("first.ahead.header"), F.lit(False))
    begin = F.when(titled, F.col("first.ahead.row_idx")).when(F.col("first.header"), F.col("first.row_idx"))
    run = F.when(titled, F.col("first.ahead.run_end")).when(F.col("first.header"), F.col("first.run_end"))
    by = by.select("*", titled.alias("titled"), begin.alias("begin"), run.alias("run"), _local_end(F.col("near")).alias("edge"))
    on_header = F.exists("near", lambda r: (r.row_idx == F.col("edge")) & r.header)
    end = F.when(F.col("edge").isNull() | (F.col("edge") < F.col("begin")), F.col("run")).when((F.col("edge") <= F.col("run")) | on_header, F.col("edge")).otherwise(F.col("run"))
    by = by.withColumn("end", F.when(F.col("begin").isNotNull(), end))
    block = F.filter("near", lambda r: r.row_idx.between(F.col("begin"), F.col("end")))
    low = F.coalesce(F.array_max(F.transform(F.filter(block, lambda r: r.lone), lambda r: r.row_idx)), F.lit(-1))
    own_start = F.coalesce(t.let(low, lambda s: F.array_min(F.transform(F.filter(block, lambda r: r.multi & (r.row_idx > s)), lambda r: r.row_idx))), F.col("begin"))
    zero = F.col("sub_idx") == 0
    start = F.when(zero, F.coalesce("top", F.col("title.row_idx"), F.lit(0))).otherwise(F.when(F.col("end").isNotNull(), own_start))
    end = F.when(zero, F.col("sheet_end")).otherwise(F.col("end"))
    name = F.when(zero, F.col("title.text")).otherwise(F.when(F.col("titled") | (F.col("end").isNull() & F.col("first.lone")), F.col("first.text")))
    named = by.select("sheet", "sub_idx", F.coalesce(ranges.label(name), F.concat(F.lit("p"), (F.col("sub_idx") + 1).cast("string"))).alias("label"), start.cast("int").alias("header_start"), end.cast("int").alias("header_end"), "plain", "data_end")
    return inherited(named.withColumn("data_start", F.coalesce(F.col("header_end") + 1, F.col("plain"), F.col("data_end"))).drop("plain")).where(F.col("many")).drop("many")


def _local_end(near: Column) -> Column:
    """Where borders end a header among some rows: as layout.with_border_header, of an array of rows."""

    def found(bounds: Column) -> Column:
        gaps = F.transform(bounds, lambda x, k: F.struct((F.coalesce(F.get(bounds, k + 1), F.size(near)) - x - 1).alias("gap"), (-x).alias("at")))
        best = F.array_max(F.filter(gaps, lambda g: g.gap >= 2))
        other = F.array_min(F.filter(bounds, lambda x: F.size(F.filter(F.slice(near, x + 2, F.lit(4)), lambda r: ~r.bound)) >= 2))
        spot = F.coalesce(-best["at"], other)
        row = t.let(F.get(near, spot), lambda r: F.when(r.heavy & (r.row_idx > 0), r.row_idx - 1).otherwise(r.row_idx))
        return F.when((F.size(bounds) > 0) & (F.size(bounds) <= 0.7 * F.size(near)), row)

    return t.let(F.filter(F.transform(near, lambda r, i: F.when(r.bound, i)), lambda i: i.isNotNull()), found)


def inherited(regions: DataFrame) -> DataFrame:
    """Regions of a sheet, each with a header: without one of its own the last one's above; ``many`` tells if there are two or more."""
    w = W.partitionBy("sheet").orderBy("sub_idx").rowsBetween(W.unboundedPreceding, W.currentRow)
    own = F.when(F.col("header_start").isNotNull() & F.col("header_end").isNotNull(), F.struct("header_start", "header_end"))
    told = regions.withColumn("h", F.last(own, ignorenulls=True).over(w)).withColumn("many", F.count(F.lit(1)).over(whole()) >= 2)
    return told.withColumn("header_start", F.col("h.header_start")).withColumn("header_end", F.col("h.header_end")).drop("h")


def regions_of_rows(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """(sheet key, row_idx, cells, …, label, kind): each region's data rows, kind ``data``, and header rows, kind ``header``.

    A header may belong to several regions, where they inherit it; data rows are of one, and those after a region's last
    row that is neither blank nor a footnote go.  The key is (sheet, sub_idx).
    """
    heads = regions.where(F.col("header_start").isNotNull()).select("sheet", "sub_idx", F.explode(F.sequence("header_start", "header_end")).alias("row_idx"), "label")
    heads = rows.join(heads, ["sheet", "row_idx"]).withColumn("kind", F.lit("header"))
    facts = F.struct("sub_idx", "label", "data_end").alias("region")
    marked = rows.join(regions.select("sheet", F.col("data_start").alias("row_idx"), facts), ["sheet", "row_idx"], "left")
    held = marked.withColumn("region", F.last("region", ignorenulls=True).over(down())).where(at() < F.col("region.data_end"))
    data = held.select(*rows.columns, "region.sub_idx", "region.label").withColumn("kind", F.lit("data"))
    cells = F.col("cells")
    content = F.max(F.when(~p.is_blank(cells) & ~p.is_footnote(cells), at())).over(W.partitionBy("sheet", "sub_idx"))  # keeps to the sheets' exchange
    return layout.by_subtable(data.withColumn("content", content).where(at() <= F.col("content")).drop("content")).unionByName(layout.by_subtable(heads))


def named_rows(rows: DataFrame, gaps: bool = False, advised: DataFrame | None = None) -> DataFrame:
    """(sheet, label, names) of rows (sheet, row_idx, cells, label, kind): the names of each key's header rows.

    advised: (sheet, advised array<string>, confidence) of an advisor.
    """
    first = F.get("cells", F.lit(0))
    data = F.when((F.col("kind") == "data") & ~t.blank(first), F.struct("row_idx", (~F.replace(t.uni_trim(first), F.lit(" "), F.lit("")).rlike(r"^-?[\d,]+\.?\d*$")).alias("text")))
    numbered = rows.withColumn("spot", F.when(F.col("kind") == "data", F.row_number().over(W.partitionBy("sheet", "kind").orderBy("row_idx"))))
    by = numbered.where((F.col("kind") == "header") | (F.col("spot") <= 10)).groupBy("sheet", "label").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "header", F.struct("row_idx", "cells")))).alias("head"), F.collect_list(data).alias("firsts")
    )
    texts = F.size(F.filter("firsts", lambda x: x.text))
    known = (F.size("firsts") >= 2) & (texts > 0.5 * F.size("firsts"))
    block = F.transform("head", lambda r: r.cells)
    if advised is None:
        made = headers.block_header(block, known, gaps=gaps)
    else:
        by = by.join(advised, "sheet", "left")
        made = headers.block_header(block, known, F.col("advised"), F.coalesce("confidence", F.lit(0.0)), gaps)
    return by.select("sheet", "label", F.when(F.size("head") > 0, made).alias("made"), F.col("head.row_idx").alias("header_rows")).select("sheet", "label", "header_rows", "made.names", F.col("made.rows").alias("n_header"))


def read_out(rows: DataFrame, named: DataFrame, drop_blank: bool = False, judged: bool = False) -> DataFrame:
    """(sheet, sub_idx, label, names, row_no, cells) from rows (key, row_idx, cells, label, kind[, border, judged]) and their names.

    Categories go down to the next row, first cells down their bordered group (with ``border``) or to all below; blank
    rows go; cells are cleaned, and are as many as the names.  drop_blank: columns without name and content go.  judged:
    of the sub-tables marked so those worth keeping stay (regions.worth_keeping).
    """
    data = rows.where(F.col("kind") == "data")
    if "border" in rows.columns:
        data = fill.bordered_groups(data)
    body = fill.push_down_categories(data.where(~p.is_blank(F.col("cells"))), blanks=False)
    body = fill.fill_down(body) if "border" in rows.columns else fill.forward_fill(body)
    names = named.select("sheet", "names").where(F.size("names") > 0)
    if drop_blank:
        unnamed = lambda n: n.rlike(r"^(col_\d+|col_empty)$")
        # a column holds something as the sub-table stands if it does before first cells are filled: what fills comes from it
        spots = names.select("sheet", F.explode(F.filter(F.transform("names", lambda n, i: F.when(unnamed(n), i)), lambda i: i.isNotNull())).alias("i"))
        held = rows.where(F.col("kind") == "data").join(spots, "sheet").where(t.clean(F.get("cells", F.col("i"))).isNotNull()).select("sheet", "i").distinct()
        held = held.groupBy("sheet").agg(F.collect_set("i").alias("held"))  # no more than a row's columns
        stays = F.transform("names", lambda n, i: ~unnamed(n) | F.coalesce(F.array_contains("held", i), F.lit(False)))
        names = names.join(held, "sheet", "left").select("sheet", "names", stays.alias("stays"))
    kept = [*names.columns[1:], *(["judged"] if judged else [])]
    fitted = body.join(names, "sheet").select("sheet", "row_idx", "label", *kept, F.transform(F.sequence(F.lit(0), F.size("names") - 1), lambda i: t.clean(F.get("cells", i))).alias("cells"))
    if drop_blank:
        keep = lambda c: F.filter(F.col(c), lambda _, i: F.get("stays", i))
        fitted = fitted.select("sheet", "row_idx", "label", *kept[2:], keep("names").alias("names"), keep("cells").alias("cells"))
    row_no = F.row_number().over(W.partitionBy("sheet").orderBy("row_idx")).cast("long")
    out = fitted.withColumn("row_no", row_no)
    if judged:
        columns, own = F.size("names"), F.size(F.filter("names", lambda n: ~n.rlike(r"^col_\d+$")))
        worth = (F.count(F.lit(1)).over(whole()) >= 2) & (columns > 0) & ((columns <= 2) | (own >= 0.3 * columns))
        out = out.withColumn("worth", ~F.coalesce("judged", F.lit(False)) | worth).where("worth")
    return layout.of_sheet(out.select("sheet", "label", "names", "row_no", "cells")).select("sheet", "sub_idx", "label", "names", "row_no", "cells")
