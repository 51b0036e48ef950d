"""Predicates on a row of cells (array<string>), as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions import text as t


def filled(cells: Column) -> Column:
    """The cells that are not blank, stripped."""
    return F.filter(F.transform(cells, t.uni_trim), lambda c: c != "")


def n_filled(cells: Column) -> Column:
    return F.size(F.filter(cells, lambda c: ~t.blank(c)))


def first_filled(cells: Column) -> Column:
    return F.get(filled(cells), 0)


def is_blank(cells: Column) -> Column:
    return ~F.exists(cells, lambda c: ~t.blank(c))


def is_title(cells: Column) -> Column:
    """At least two cells, all of one value."""
    return t.let(filled(cells), _title)


def _title(f: Column) -> Column:
    return (F.size(f) >= 2) & ~F.exists(f, lambda c: c != F.get(f, 0))


def is_header_like(cells: Column) -> Column:
    return t.let(filled(cells), _header_like)


def _header_like(f: Column) -> Column:
    return t.let(F.array_join(f, "\n"), lambda joined: _header_like_joined(f, joined))


def _header_like_joined(f: Column, joined: Column) -> Column:
    """No word or year spans a line, so that one look at the joined cells finds what any of them holds."""
    n = F.size(f)
    words = reduce(or_, (joined.contains(word) for word in t.HEADER_WORDS))
    numbers = F.when(joined.rlike(r"\d"), F.size(F.filter(f, lambda c: t.bare_number(c).rlike(t.NUMBER)))).otherwise(0)
    by_numbers = t.let(numbers, lambda k: F.when(k > 0.4 * n, False).when(joined.rlike(t.HEADER_YEAR), True).otherwise(((n - k) >= 2) & ((n - k) > k)))
    return F.when(n < 2, False).when(words, True).otherwise(by_numbers)


def kinds(cells: Column) -> Column:
    """A struct of n_filled, is_title and is_header_like, from one look at the cells."""
    return t.let(filled(cells), lambda f: F.struct(F.size(f).alias("n_filled"), _title(f).alias("is_title"), _header_like(f).alias("is_header_like")))


def is_footnote(cells: Column) -> Column:
    return F.coalesce(t.is_footnote_text(first_filled(cells)), F.lit(False))


def has_numeric_data(cells: Column) -> Column:
    """A number in any cell after the first."""
    number = F.exists(F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1))), lambda c: t.bare_number(c).rlike(t.LOOSE_NUMBER))
    return F.when(F.array_join(cells, "\n").rlike(r"\d"), number).otherwise(F.when(cells.isNotNull(), False))


def is_data_number(c: Column) -> Column:
    """A number that is not a bare year; a thousands separator tells that four digits are no year."""
    bare = t.bare_number(c)
    apart = F.coalesce(c, F.lit("")).rlike("[,　]") | ((F.length(c) > 4) & c.contains(" "))
    return bare.rlike(t.LOOSE_NUMBER) & (~bare.rlike(t.YEAR) | apart)


UNITS = "^(%|％|元|万元|亿元|人|万人|吨|万吨|公顷|千米|个|户|次|件)$"


def is_measured(f: Column, units: str = UNITS) -> Column:
    """Of filled cells: at least two, less than half of them units."""
    n = F.size(f)
    return (n >= 2) & (F.size(F.filter(f, lambda c: c.rlike(units))) < 0.5 * n)


def is_data_like(cells: Column, units: str = UNITS) -> Column:
    """At least two cells; not a row of units; a data number after the first cell."""
    numbers = F.exists(F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1))), lambda c: F.coalesce(is_data_number(c), F.lit(False)))
    return is_measured(filled(cells), units) & numbers


def is_continuation(n: Column, n_main: Column) -> Column:
    return (n >= 1) & (n <= F.greatest(F.lit(1), F.floor(n_main * 0.6)))


def numeric_names(names: Column) -> Column:
    """More than 30 % of the names are numbers."""
    return F.size(F.filter(names, lambda c: c.rlike(r"^-?\d+(\.\d+)?$|^\d+_\d+$"))) > 0.3 * F.size(names)


def fit(cells: Column, width: int) -> Column:
    """Padded with NULL or cut to the width."""
    return F.array(*(F.get(cells, F.lit(i)) for i in range(width)))


def merge_thousands(cells: Column, width: Column) -> Column:
    """A row wider than its header, with numbers put together that a separator has split; only if it then has the width."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("open"))

    def step(acc: Column, c: Column) -> Column:
        grows = acc.open & F.coalesce(c.rlike(r"^\d{3}$"), F.lit(False))
        last = F.element_at(acc.out, -1)
        out = F.when(grows, F.concat(F.slice(acc.out, 1, F.size(acc.out) - 1), F.array(F.concat(last, c)))).otherwise(F.concat(acc.out, F.array(c)))
        return F.struct(out.alias("out"), (grows | F.coalesce(c.rlike(r"^-?\d{1,3}$"), F.lit(False))).alias("open"))

    plain = F.transform(cells, lambda c: F.when(c.rlike(r"^-?\d{1,3}([,　，]\d{3})+$"), F.regexp_replace(c, "[,　，]", "")).otherwise(c))
    merged = F.aggregate(plain, start, step, lambda acc: acc.out)
    return F.when((F.size(cells) > width) & (F.size(merged) == width), merged).otherwise(cells)
