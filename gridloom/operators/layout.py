"""A sheet's layout told to each of its rows: one exchange by sheet, then windows and aggregates that keep to it.

The column ``sheet`` is the key, of any kind: a struct of a sheet and a sub-table's number makes the same operators work
on sub-tables (``by_subtable``, ``of_sheet``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t
from gridloom.operators import predicates as p

def at() -> Column:
    return F.col("row_idx")


def whole() -> W:
    return W.partitionBy("sheet")


def down() -> W:
    """From the sheet's first row to this one."""
    return W.partitionBy("sheet").orderBy("row_idx").rowsBetween(W.unboundedPreceding, W.currentRow)


def above() -> W:
    return W.partitionBy("sheet").orderBy("row_idx").rowsBetween(W.unboundedPreceding, -1)


def below() -> W:
    """The rows after this one: in descending order, so that a sheet of n rows takes n steps."""
    return W.partitionBy("sheet").orderBy(F.desc("row_idx")).rowsBetween(W.unboundedPreceding, -1)


def by_subtable(rows: DataFrame) -> DataFrame:
    """(sheet, sub_idx, …) with both as the key."""
    return rows.withColumn("sheet", F.struct("sheet", "sub_idx")).drop("sub_idx")


def of_sheet(rows: DataFrame) -> DataFrame:
    """The sheet and the number of a sub-table again, from their key."""
    return rows.withColumn("sub_idx", F.col("sheet.sub_idx")).withColumn("sheet", F.col("sheet.sheet"))


def prepared(rows: DataFrame, columns: bool = False) -> DataFrame:
    """Rows with ``trim_start``, without blank rows at both ends and without the footnotes at the end.

    What lies after the last row that is neither blank nor a footnote goes if a footnote is there.  columns: cells are cut
    to the right-most column that holds anything in what stays.
    """
    cells = F.col("cells")
    marked = rows.withColumn("full", ~p.is_blank(cells)).withColumn("note", p.is_footnote(cells))
    content = F.max(F.when(F.col("full") & ~F.col("note"), at())).over(whole())
    ends = marked.select("*", F.min(F.when(F.col("full"), at())).over(whole()).alias("trim_start"), F.max(F.when(F.col("full"), at())).over(whole()).alias("last"), content.alias("content"), F.max(F.when(F.col("note"), at())).over(whole()).alias("last_note"))
    noted = F.col("last_note").isNotNull() & (F.col("content").isNull() | (F.col("last_note") > F.col("content")))
    kept = ends.where(at().between(F.col("trim_start"), F.col("last")) & (~noted | (at() <= F.col("content")))).drop("full", "note", "last", "content", "last_note")
    if not columns:
        return kept
    right = F.array_max(F.transform("cells", lambda c, i: F.when(~t.blank(c), i + 1)))
    return kept.withColumn("right", F.coalesce(F.max(right).over(whole()), F.lit(0))).withColumn("cells", F.slice("cells", 1, F.col("right"))).drop("right")


def data_start(cells: Column) -> tuple[Column, Column]:
    """Whether a row is data, and whether it starts the data of a sheet where no row is: an ordinal category, or any number."""
    ordinal = F.coalesce(p.first_filled(cells).rlike(t.ORDINAL), F.lit(False))
    other = ordinal | F.exists(F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1))), lambda c: F.coalesce(p.is_data_number(c), F.lit(False)))
    return p.is_data_like(cells) & ~(ordinal & ~other), other


def with_data_start(rows: DataFrame) -> DataFrame:
    """With ``data_start``: the sheet's first data row, else the first that starts data all the same, else -1."""
    cells = F.col("cells")
    number = F.exists(F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1))), lambda c: F.coalesce(p.is_data_number(c), F.lit(False)))
    # as data_start, with one look at the cells
    starts = lambda f: t.let(number, lambda k: F.struct((k & p.is_measured(f)).alias("data"), (k | F.coalesce(F.get(f, 0).rlike(t.ORDINAL), F.lit(False))).alias("other")))
    marked = rows.withColumn("starts", t.let(p.filled(cells), starts))
    first, second = (F.min(F.when(F.col(f"starts.{c}"), at())).over(whole()) for c in ("data", "other"))
    return marked.withColumn("data_start", F.coalesce(first, second, F.lit(-1)).cast("int")).drop("starts")


def numbers_in(cells: Column) -> Column:
    """Whether so many cells after the first are data numbers, two and 30 %, that a row is no header."""
    numbers = F.size(F.filter(F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1))), lambda c: F.coalesce(p.is_data_number(c), F.lit(False))))
    return numbers >= F.greatest(F.lit(2.0), 0.3 * p.n_filled(cells))


def with_header_range(rows: DataFrame) -> DataFrame:
    """Rows with ``data_start``, with ``header_start`` and ``header_end``: the header block above the data; (0, 0) if there is none.

    Its end is the last row above the data that is neither blank, a title, nor a lone Chinese text (unless a row of
    several cells stands over that, which it then supplements).  Its start is the topmost row that belongs to it: up from
    the end, titles are passed over, lone texts belong if the row below has several cells, and a lone text of more than
    four characters that does not belong stops the search.
    """
    cells = F.col("cells")
    first, n = p.first_filled(cells), p.n_filled(cells)
    full = F.when((at() < F.col("data_start")) & ~p.is_blank(cells), F.struct(n.alias("n"), p.is_title(cells).alias("title"), first.alias("first")))
    marked = rows.withColumn("h", full)
    here = F.col("h.n")
    marked = marked.withColumn("over", F.coalesce(F.last(here, ignorenulls=True).over(above()), F.lit(0))).withColumn("under", F.last(here, ignorenulls=True).over(below()))
    lone = here == 1
    short = F.coalesce(lone & F.col("h.first").rlike(f"^{t.CJK}{{1,4}}$"), F.lit(False))
    long = F.coalesce(lone & (F.length("h.first") > 4), F.lit(False))
    passed = F.col("h.title") | ((short | (long & F.col("h.first").rlike(f"^{t.CJK}"))) & (F.col("over") <= 1))
    ended = marked.withColumn("end", F.max(F.when(F.col("h").isNotNull() & ~passed, at())).over(whole()))
    own = at() == F.col("end")
    fits = F.coalesce(F.col("under") > 1, F.lit(False)) & (at() < F.col("end"))
    inside = F.col("h").isNotNull() & (at() <= F.col("end"))
    stopped = ended.withColumn("stop", F.coalesce(F.max(F.when(inside & long & ~fits & ~own, at())).over(whole()), F.lit(-1)))
    joins = inside & (own | (~F.col("h.title") & ~((short | long) & ~fits))) & (at() > F.col("stop"))
    begun = stopped.withColumn("header_start", F.coalesce(F.min(F.when(joins, at())).over(whole()), F.lit(0)))
    return begun.withColumn("header_end", F.coalesce("end", F.lit(0))).drop("h", "over", "under", "end", "stop")


def with_border_header(rows: DataFrame, first: int | None = None, most: int | None = None, heavy: Column | None = None) -> DataFrame:
    """Rows with ``boundary``, with ``border_end``: the row before the widest gap of two open rows or more, retreated off data; NULL without one.

    Of equal gaps the first.  Without ``first``: no signal where over 70 % of rows are boundaries; without a gap the first
    boundary with two open rows among the four after it.  With it: the boundaries of so many first rows count, each gap up to ``most``.
    """
    bound = F.coalesce(F.col("boundary"), F.lit(False))
    next_bound = F.last(F.when(bound, at()), ignorenulls=True).over(below())
    gap = F.coalesce(next_bound, F.max(at()).over(whole()) + 1) - at() - 1
    marked = rows.withColumn("gap", F.when(bound, F.least(gap, F.lit(most)) if most else gap)).withColumn("weighs", numbers_in(F.col("cells")) if heavy is None else heavy)
    near = F.col("gap") >= 2
    if first is None:
        open_after = F.coalesce(F.sum((~bound).cast("int")).over(W.partitionBy("sheet").orderBy("row_idx").rowsBetween(1, 4)), F.lit(0))
        marked = marked.withColumn("open", open_after).withColumn("dense", F.avg(bound.cast("double")).over(whole()) > 0.7)
        other = F.min(F.when(bound & (F.col("open") >= 2), at())).over(whole())
    else:
        marked = marked.withColumn("dense", F.lit(False)).withColumn("open", F.lit(0))
        near, other = near & (at() < first), F.lit(None).cast("int")
    best = F.max_by("row_idx", F.when(near, F.struct(F.col("gap"), -at()))).over(whole())
    ended = marked.withColumn("spot", F.when(~F.col("dense"), F.coalesce(F.when(F.max(near.cast("int")).over(whole()) == 1, best), other)))
    weighs = F.max(F.when(at() == F.col("spot"), F.col("weighs"))).over(whole())
    end = F.when(weighs & (F.col("spot") > 0), F.col("spot") - 1).otherwise(F.col("spot"))
    return ended.withColumn("border_end", end).drop("gap", "weighs", "open", "dense", "spot")


def with_start_above(rows: DataFrame, end: str, start: str, supplements: bool = True) -> DataFrame:
    """With ``start``: up from the row ``end``, rows that are neither blank nor titles belong; a lone text of more than four
    characters above it stops the search, unless it supplements a header (a year's comparison) and supplements count."""
    cells = F.col("cells")
    text = F.regexp_replace(p.first_filled(cells), f"[{t.SPACE}]", "")
    stops = (p.n_filled(cells) == 1) & (F.length(text) > 4)
    if supplements:
        stops = stops & ~t.is_header_supplement(text)
    marked = rows.withColumn("stop", F.max(F.when((at() < F.col(end)) & stops, at())).over(whole())).withColumn("belongs", ~p.is_blank(cells) & ~p.is_title(cells))
    first = F.min(F.when(F.col("belongs") & (at() < F.col(end)) & (at() > F.coalesce("stop", F.lit(-1))), at())).over(whole())
    return marked.withColumn(start, F.coalesce(first, F.col(end))).drop("stop", "belongs")
