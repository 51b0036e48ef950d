"""Strategies: grids of many sheets at once to relations in long form, (sheet, sub_idx, label, names, row_no, cells).

Rows are (sheet, row_idx, cells) and, where borders are known, ``border`` and the columns of borders.row_edges; split
columns and hints go with them in ``Extras``.  names are those of the cells of each row's own sub-table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t
from gridloom.operators import borders, fill, headers, layout, pairs, ranges, regions, subtables
from gridloom.operators import predicates as p
from gridloom.session import cut, dealt


@dataclass
class Extras:
    """What a decision or the borders add to a sheet's rows; each may be missing.

    split_cols: (sheet, col_idx), columns that a border says open a region.  hints: (sheet, sub_idx, label, col_start,
    col_end, header_start, header_end, data_start, data_end), regions of a decision, any of these NULL; col_end included,
    data_end not, rows counted in the sheet as it is.  advised: (sheet, sub_idx, advised array<string>, confidence).
    """

    split_cols: DataFrame | None = None
    hints: DataFrame | None = None
    advised: DataFrame | None = None

    def keyed_names(self) -> DataFrame | None:
        return None if self.advised is None else layout.by_subtable(self.advised)


Strategy = Callable[..., DataFrame]
OUT = ("sheet", "sub_idx", "label", "names", "row_no", "cells")


def _whole(rows: DataFrame, names: Column) -> DataFrame:
    """One relation a sheet, its rows numbered from 1."""
    row_no = F.row_number().over(W.partitionBy("sheet").orderBy("row_idx")).cast("long")
    return rows.select("sheet", F.lit(0).alias("sub_idx"), F.lit("p1").alias("label"), names.alias("names"), row_no.alias("row_no"), "cells")


def _header_names(condition: Column) -> Column:
    """The names of a sheet's one header row, told to all its rows (no work if nobody asks for them)."""
    return F.max(F.when(condition, headers.block_names(F.array("cells"), F.lit(False)))).over(layout.whole())


def standard(rows: DataFrame, extras: Extras | None = None) -> DataFrame:
    """Row 0 is the header; data up to the first footnote; cells as many as the header's."""
    named = rows.withColumn("names", _header_names(F.col("row_idx") == 0)).withColumn("width", F.max(F.when(F.col("row_idx") == 0, F.size("cells"))).over(layout.whole()))
    body = ranges.stop_at_footnote(named.where(F.col("row_idx") > 0))
    cells = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: t.clean(F.get("cells", i)))
    return _whole(body.where(F.col("width") > 0).withColumn("cells", cells), headers.distinct_names(F.col("names")))


def simple_header(rows: DataFrame, extras: Extras | None = None) -> DataFrame:
    """Blank ends and footnotes go; the row before the data is the header; first cells are filled down; blank rows go."""
    cells = F.col("cells")
    told = layout.with_data_start(layout.prepared(rows.select("sheet", "row_idx", "cells")))
    header = F.col("row_idx") == F.greatest(F.col("data_start") - 1, F.col("trim_start"))
    told = told.withColumn("is_header", header).withColumn("width", F.max(F.when(header, p.n_filled(cells))).over(layout.whole())).withColumn("names", _header_names(header))
    under = (F.col("row_idx") > F.greatest(F.col("data_start") - 1, F.col("trim_start"))) & ~p.is_blank(cells)
    body = fill.forward_fill(told.where(under))
    cleaned = body.withColumn("cells", F.transform("cells", t.clean))
    merged = cleaned.withColumn("cells", F.slice(p.merge_thousands(cells, F.col("width")), 1, F.col("width")))
    return _whole(merged, headers.distinct_names(F.slice("names", 1, F.greatest(F.col("width"), F.lit(0)))))


def multi_header(rows: DataFrame, extras: Extras | None = None) -> DataFrame:
    """A header of several rows over the data, and further tables under it.

    The header ends where borders say, else where its texts end, rows of units (several cells, none of them the first)
    under it included; data that begins before that cuts it short.  Tables after a gap have their own header, or the last
    one's.
    """
    extras = extras or Extras()
    told = layout.with_header_range(layout.with_data_start(layout.prepared(rows, columns=True)))
    if "is_solid" in rows.columns:
        told = layout.with_start_above(layout.with_border_header(_bounded(told)), "border_end", "border_start")
        told = told.withColumn("header_start", F.coalesce("border_start", "header_start")).withColumn("header_end", F.coalesce("border_end", "header_end"))
    units = (F.col("row_idx") > F.col("header_end")) & (F.col("row_idx") < F.col("data_start")) & t.blank(F.get("cells", F.lit(0))) & (p.n_filled(F.col("cells")) > 1)
    told = told.withColumn("header_end", F.coalesce(F.max(F.when(units, F.col("row_idx"))).over(layout.whole()), F.col("header_end")))
    early = (F.col("data_start") >= 0) & (F.col("data_start") <= F.col("header_end"))
    first = F.when(early, F.col("data_start")).otherwise(F.col("header_end") + 1)
    told = told.withColumn("data_start", F.greatest(first, F.lit(0))).withColumn("header_end", F.greatest(F.col("data_start") - 1, F.col("trim_start")))
    told = told.withColumn("header_start", F.greatest(F.least("header_start", "header_end"), F.col("trim_start")))
    keep = [c for c in ("border",) if c in rows.columns]
    return _stacked(told.select("sheet", "row_idx", "cells", *keep, "header_start", "header_end", "data_start"), extras)


def _bounded(rows: DataFrame) -> DataFrame:
    return rows.withColumn("boundary", borders.is_boundary(F.col("bottom_ratio"), F.col("is_solid"), F.col("is_dash")))


def _stacked(told: DataFrame, extras: Extras) -> DataFrame:
    """Reads rows told where their sheet's header and data are; further tables begin after gaps under the header.

    All by windows over the sheets' one exchange: no row is made twice.  A gap, a run of blank rows, parts tables as
    ranges.vertical_splits says; a table's header goes with the tables after it that have none of their own.
    """
    at, sub, cells = layout.at(), W.partitionBy("sheet", "sub_idx"), F.col("cells")
    looks = told.withColumn("looks", t.let(p.filled(cells), lambda f: F.struct(F.size(f).alias("n"), t.is_footnote_text(F.get(f, 0)).alias("note"))))
    n, note = F.col("looks.n"), F.col("looks.note")
    looked = looks.select("*", (n == 0).alias("blank"), ((n > 0) & ~note).alias("full"), ((n == 1) & ~note).alias("lone")).drop("looks")
    content = F.col("full") & (at >= F.col("data_start"))
    seen = looked.withColumn("gap", F.last(F.when(F.col("blank"), at), ignorenulls=True).over(layout.below()))
    seen = seen.withColumn("before", F.last(F.when(content, F.struct("lone", "gap")), ignorenulls=True).over(layout.above())).drop("gap")
    parted = content & F.coalesce(F.col("before.gap") < at, F.lit(False))
    near = F.coalesce(F.last(F.when(content, F.col("parted")), ignorenulls=True).over(layout.above()), F.lit(False))
    # whether a row is like a header is looked at near gaps only
    seen = seen.withColumn("parted", parted).withColumn("near", near).withColumn("like", F.when(content & (F.col("parted") | F.col("near")), p.is_header_like(cells)).otherwise(False))
    ahead = F.last(F.when(content, F.col("like")), ignorenulls=True).over(layout.below())
    begins = F.col("parted") & ((F.col("like") & ~F.col("before.lone")) | (F.col("lone") & F.coalesce(F.col("ahead"), F.lit(False))))
    opened = F.last(F.when(begins, F.col("before.gap")), ignorenulls=True).over(layout.below())  # the split row of the next table
    marked = seen.withColumn("ahead", ahead).withColumn("begin", F.coalesce(opened == at, F.lit(False))).drop("ahead", "before", "parted", "near", "like")
    marked = marked.withColumn("sub_idx", F.sum(F.col("begin").cast("int")).over(layout.down()).cast("int")).withColumn("n_subs", F.sum(F.col("begin").cast("int")).over(layout.whole()) + 1)
    marked = marked.withColumn("k", F.when((F.col("sub_idx") > 0) & ~F.col("blank"), p.kinds(cells)))
    like = F.coalesce(F.col("k.is_header_like"), F.lit(False))
    marked = marked.withColumn("like", like).withColumn("is_data", F.coalesce(F.col("full") & ~F.col("lone") & ~F.col("k.is_title") & ~like, F.lit(False))).drop("k", "lone")
    first, top, end = F.min(F.when(F.col("is_data"), at)).over(sub), F.min(F.when(F.col("like"), at)).over(sub), F.max(at).over(sub) + 1
    by = marked.withColumn("d1", first).withColumn("top", top).withColumn("end", end).withColumn("d1", F.coalesce("d1", "end"))
    zero = F.col("sub_idx") == 0
    own = F.when(zero, F.struct(F.col("header_start").alias("a"), F.col("header_end").alias("b"))).when(F.col("top") < F.col("d1"), F.struct(F.col("top").alias("a"), (F.col("d1") - 1).alias("b")))
    by = by.withColumn("own", own).withColumn("from", F.when(zero, F.col("data_start")).otherwise(F.col("d1")))
    by = by.withColumn("content", F.max(F.when(F.col("full") & (at >= F.col("from")), at)).over(sub))
    following = F.last(F.when(F.col("begin") & F.col("own").isNotNull(), F.col("sub_idx")), ignorenulls=True).over(layout.below())
    by = by.withColumn("following", F.coalesce(following, F.col("n_subs")).cast("int"))
    heads = F.when(at.between(F.col("own.a"), F.col("own.b")), F.transform(F.sequence("sub_idx", F.col("following") - 1), lambda k: F.struct(F.lit("header").alias("kind"), k.alias("k"))))
    data = F.when(at.between(F.col("from"), F.col("content")), F.array(F.struct(F.lit("data").alias("kind"), F.col("sub_idx").alias("k"))))
    none = F.array().cast("array<struct<kind: string, k: int>>")
    keep = [c for c in ("border",) if c in told.columns]
    each = by.select("sheet", "row_idx", "cells", *keep, F.explode(F.concat(F.coalesce(heads, none), F.coalesce(data, none))).alias("of"))
    label = F.concat(F.lit("p"), (F.col("of.k") + 1).cast("string")).alias("label")
    parts = dealt(cut(each.select(F.struct("sheet", F.col("of.k").alias("sub_idx")).alias("sheet"), "row_idx", "cells", *keep, label, "of.kind")), "sheet")
    return subtables.read_out(parts, subtables.named_rows(parts, advised=extras.keyed_names()))


def header_names(rows: DataFrame) -> DataFrame:
    """(sheet, pos, name, unique_name): the header block above the data, merged by column and made unique."""
    told = layout.with_data_start(layout.prepared(rows.select("sheet", "row_idx", "cells"), columns=True))
    told = told.withColumn("end", F.greatest(F.col("data_start") - 1, F.col("trim_start")))
    told = layout.with_start_above(told, "end", "start").where(F.col("row_idx").between(F.col("start"), F.col("end")))
    block = F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "cells"))), lambda r: r.cells)
    made = told.groupBy("sheet").agg(block.alias("block")).select("sheet", headers.block_names(F.col("block"), F.lit(False)).alias("names"))
    both = made.select("sheet", F.posexplode(F.arrays_zip("names", headers.distinct_names(F.col("names")).alias("unique"))).alias("pos", "n"))
    return both.select("sheet", "pos", F.col("n.names").alias("name"), F.col("n.unique").alias("unique_name"))


def horizontal_split(rows: DataFrame, extras: Extras | None = None) -> DataFrame:
    """Side-by-side tables, each with its own header.

    A sheet's regions are, in this order: a decision's that say where headers are; what borders part; any other ones of a
    decision, which otherwise name the border's regions that they cover most; what two blank columns or more part; what a
    header that says its own beginning again parts; the whole sheet.  Blank columns at a region's sides go.  A region's
    header is the decision's, or ends at the widest gap between the first borders, or is found by content.  Of a decision's
    regions those worth keeping stay (two rows, and 30 % of names of their own).
    """
    extras = extras or Extras()
    part = dealt(cut(layout.prepared(rows)), "sheet")
    found = cut(regions.side_by_side(part, extras.split_cols, extras.hints))  # a row a region
    n = part.select("sheet").join(found.select("sheet"), "sheet").count()
    sliced = regions.trim_sides(regions.sliced(part, found), ("sheet", "sub_idx")).drop("left")
    told = layout.with_header_range(layout.with_data_start(dealt(layout.by_subtable(sliced), "sheet", n=n)))
    if "border" in rows.columns:
        told = layout.with_border_header(told.withColumn("boundary", F.col("border")), first=15, most=9)
        told = layout.with_start_above(told, "border_end", "border_start", supplements=False)
    else:
        told = told.withColumn("border_end", F.lit(None).cast("int")).withColumn("border_start", F.lit(None).cast("int"))
    hint_end = F.when(F.col("hint.data_start") > 0, F.least(F.coalesce("hint.header_end", F.col("hint.data_start") - 1), F.col("hint.data_start") - 1)).otherwise(F.col("hint.header_end"))
    hinted = F.col("hint.header_start").isNotNull() & hint_end.isNotNull()
    end = F.when(hinted, hint_end).otherwise(F.coalesce("border_end", "header_end"))
    start = F.when(hinted, F.col("hint.header_start")).otherwise(F.coalesce("border_start", "header_start"))
    told = told.withColumn("h1", F.greatest(end, F.col("trim_start"))).withColumn("h0", F.greatest(F.least(start, F.col("h1")), F.col("trim_start")))
    first = F.when((F.col("data_start") >= 0) & (F.col("data_start") <= F.col("h1")), F.col("data_start")).otherwise(F.col("h1") + 1)
    keep = [c for c in ("border",) if c in rows.columns]
    both = F.array(F.when(F.col("row_idx").between(F.col("h0"), F.col("h1")), "header"), F.when(F.col("row_idx") >= first, "data"))
    parts = dealt(cut(told.withColumn("first", first).select("sheet", "row_idx", "cells", *keep, "label", "judged", F.explode(F.array_compact(both)).alias("kind"))), "sheet")
    named = subtables.named_rows(parts, advised=extras.keyed_names())
    return subtables.read_out(parts, named, drop_blank=True, judged=extras.hints is not None)


def vertical_subtable(rows: DataFrame, extras: Extras | None = None) -> DataFrame:
    """Stacked tables, each with its own header or the last one's: a decision's regions, else those that borders and content show.

    A sheet with less than two is read as one table with a multi-row header.
    """
    extras = extras or Extras()
    part = layout.prepared(rows)
    found = cut(subtables.vertical_regions(part))  # a row a sub-table
    if extras.hints is not None:
        given = cut(_given(part, extras.hints))
        found = given.unionByName(found.join(given.select("sheet").distinct(), "sheet", "left_anti"))
    keep = [c for c in ("border",) if c in rows.columns]
    parts = dealt(cut(subtables.regions_of_rows(part.select("sheet", "row_idx", "cells", *keep), found)), "sheet")
    out = subtables.read_out(parts, subtables.named_rows(parts, advised=extras.keyed_names()))
    rest = rows.join(found.select("sheet").distinct(), "sheet", "left_anti")
    return out.unionByName(multi_header(rest, extras))


def _given(part: DataFrame, hints: DataFrame) -> DataFrame:
    """A decision's stacked regions, each with a header (the last one's, if it has none) and its data up to the next one."""
    ends = part.groupBy("sheet").agg((F.max("row_idx") + 1).alias("n"))
    w = W.partitionBy("sheet").orderBy("sub_idx")
    known = hints.where(F.coalesce("data_start", "header_end").isNotNull()).join(ends, "sheet")
    start = F.coalesce("data_start", F.col("header_end") + 1)
    head_end = F.least(F.coalesce("header_end", F.when(F.col("header_start").isNotNull(), start - 1)), start - 1)
    following = F.lead(F.coalesce("header_start", start)).over(w)
    made = known.select(
        "sheet", "sub_idx", F.coalesce(ranges.label(F.col("label")), F.concat(F.lit("p"), (F.col("sub_idx") + 1).cast("string"))).alias("label"),
        F.when(head_end.isNotNull(), F.coalesce("header_start", head_end)).alias("header_start"), head_end.alias("header_end"), start.alias("data_start"),
        F.least(F.coalesce("data_end", following, "n"), F.col("n")).alias("data_end"),
    )
    return subtables.inherited(made).drop("many")


def paired_row_bilingual(rows: DataFrame, extras: Extras | None = None) -> DataFrame:
    """Records of several rows under a header row, folded into one: main cells, then those columns' continuations that have any.

    The header is where borders say, else the first row of texts under the titles.  Each sheet is folded by its own span,
    as the scores of its rows tell.  Continuations are called after their column, with 续 behind.
    """
    told = headers.with_paired_header(layout.prepared(rows)).where(F.col("header_row").isNotNull())
    if "is_solid" in rows.columns:
        told = layout.with_border_header(_bounded(told)).withColumn("header_row", F.coalesce("border_end", "header_row"))
    name_of = headers.distinct_names(headers.block_names(F.array("cells"), F.lit(False)))
    named = told.withColumn("names", F.max(F.when(F.col("row_idx") == F.col("header_row"), name_of)).over(layout.whole())).where(F.size("names") > 0)
    filled = fill.forward_fill(named.where(F.col("row_idx") > F.col("header_row")))
    fitted = F.transform(F.sequence(F.lit(0), F.size("names") - 1), lambda i: F.get("cells", i))
    under = filled.select("sheet", (F.col("row_idx") - F.col("header_row") - 1).alias("row_idx"), fitted.alias("cells"), "names")
    records = pairs.with_continuations(pairs.records(pairs.with_record_span(under)))
    longer = F.transform("more", lambda i: F.concat(F.get("names", i), F.lit("_续")))
    own = F.concat("main", F.transform("more", lambda i: F.get("rest", i)))
    kept = records.withColumn("cells", own).where(~p.is_blank(F.col("cells"))).withColumnRenamed("rec", "row_idx")
    first = F.row_number().over(W.partitionBy("sheet").orderBy("row_idx")) == 1
    told = kept.withColumn("first", first).withColumn("names", F.max(F.when(F.col("first"), pairs.unique_after(F.col("names"), longer))).over(layout.whole()))
    return _whole(told, F.col("names"))


#: By name; a new one is a callable from grid rows and extras to a relation.
REGISTRY: dict[str, Strategy] = {f.__name__: f for f in (standard, simple_header, multi_header, horizontal_split, vertical_subtable, paired_row_bilingual)}


def get(name: str) -> Strategy:
    if name not in REGISTRY:
        raise ValueError(f"unknown strategy {name!r}; available: {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name]


def run_all(rows: DataFrame, decisions: DataFrame, extras: Extras | None = None) -> dict[str, DataFrame]:
    """One relation for each strategy that the decisions (sheet, strategy) name, over all its sheets at once."""
    used = [r[0] for r in decisions.where(F.col("strategy").isin(*REGISTRY)).select("strategy").distinct().collect()]  # six at most
    return {name: get(name)(rows.join(decisions.where(F.col("strategy") == name).select("sheet"), "sheet", "left_semi"), extras) for name in sorted(used)}
