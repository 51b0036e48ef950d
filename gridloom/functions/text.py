"""Cell texts as Column expressions: cleaning, kinds of text, and names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the sheets' conventions are.
HEADER_WORDS = ("指标", "单位", "年份", "项目", "地区", "类别", "合计", "总计", "名称", "年", "月", "日", "序号", "编号", "代码")
FOOTNOTES = (
    "注[:：]", "备注", "说明", "附注", "数据来源", "资料来源", "来源[:：]", "notes?[:：]", "source[:：]", "本表", "[*※★●▲]",
    "[①-⑳❶-❿]", r"[（(]\s*[\d一-九十]+\s*[)）]\s*[^数百千万亿]",
)
NUMBER = r"^-?\d+(\.\d+)?$"
LOOSE_NUMBER = r"^-?\d+\.?\d*$"
YEAR = r"^\d{4}年?$"
HEADER_YEAR = r"19\d\d年?|20\d\d年?|\d{4}[-–]\d{4}"
ORDINAL = r"^[一二三四五六七八九十]+、"
CATEGORY = r"^([一二三四五六七八九十]+、|[（(][一二三四五六七八九十]+[)）]|\d+\.)"
CJK = "[一-鿿]"
NOISE = "[：:、，,。.（()）)%％—-]"


#: Unicode white space, as in a character class and as text.
SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACES = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def uni_trim(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(c, F.lit(SPACES))


def blank(c: Column) -> Column:
    """NULL or white space only."""
    return c.isNull() | ~c.rlike(f"[^{SPACE}]")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), 0)


def _seamless(parts: Column, least: int = 1) -> Column:
    """The parts of a split number put together, where every seam lies between digits, the parts inside have ``least``
    characters or more, and the whole is a number; else NULL."""
    last = F.size(parts) - 1
    fits = F.transform(parts, lambda x, i: ((i == 0) | x.rlike(r"^\d")) & ((i == last) | x.rlike(r"\d$")) & ((i == 0) | (i == last) | (F.length(x) >= least)))
    return F.when(~F.exists(fits, lambda ok: ~ok), let(F.array_join(parts, ""), lambda whole: F.when(whole.rlike(NUMBER), whole)))


def clean(c: Column) -> Column:
    """A cell's value: NULL if blank or nan; a number without what parts its digits, a text as it is.

    Commas go if each of them stands between two digits of its own.  Spaces go from a number of four digits or more; two
    groups of digits, the second of one or two, are a number that has lost its point.
    """

    def commas(s: Column) -> Column:
        return F.when(s.contains(","), F.coalesce(_seamless(F.split(s, ",", -1), least=2), s)).otherwise(s)

    def spaces(s: Column) -> Column:
        return F.when(s.rlike(r"\s"), let(F.split(s, r"\s+", -1), lambda parts: grouped(s, parts))).otherwise(s)

    def grouped(s: Column, parts: Column) -> Column:
        two = (F.size(parts) == 2) & F.get(parts, F.lit(0)).rlike(r"^\d+$") & F.get(parts, F.lit(1)).rlike(r"^\d{1,2}$")
        long = F.length(F.translate(s, "0123456789", "")) <= F.length(s) - 4
        return F.coalesce(F.when(long, _seamless(parts)), F.when(two, F.array_join(parts, ".")), s)

    none = F.lit(None).cast("string")
    return let(uni_trim(c), lambda s: F.when((s == "") | ((F.length(s) == 3) & (F.lower(s) == "nan")), none).otherwise(let(commas(s), spaces)))


def normalise(c: Column) -> Column:
    """Stripped, runs of spaces as one; NULL if blank."""
    return F.when(blank(c), F.lit(None).cast("string")).otherwise(F.regexp_replace(uni_trim(c), " {2,}", " "))


def leading_spaces(c: Column) -> Column:
    return F.coalesce(F.length(c) - F.length(F.ltrim(c)), F.lit(0))


def header_spaces(c: Column) -> Column:
    """Without spaces between digits."""
    return F.regexp_replace(c, r"(\d)\s+(?=\d)", "$1")


def bare_number(c: Column) -> Column:
    """Without commas, spaces and ideographic spaces."""
    return F.translate(F.coalesce(c, F.lit("")), ", 　", "")


def is_footnote_text(c: Column) -> Column:
    return F.coalesce(uni_trim(c).rlike("(?i)^(" + "|".join(FOOTNOTES) + ")"), F.lit(False))


def is_category_title(c: Column) -> Column:
    s = uni_trim(c)
    return F.coalesce(s.rlike(CATEGORY) & ((F.length(s) > 3) | ~s.rlike(r"^\d+\.")), F.lit(False))


def is_header_supplement(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\d{4}年") & c.rlike("[为比％%]"), F.lit(False))


#: What a float parser takes has this shape (not the other way round).
FLOAT = r"(?i)^[\x00-\x20]*[+-]?(nan|inf(inity)?|0x[\da-f.]+p[+-]?\d+|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)[fd]?[\x00-\x20]*$"


def is_numeric_text(c: Column) -> Column:
    """Whether a float parser takes it; texts that can't be numbers don't reach it, for it is slow to say no."""
    return F.when(c.rlike(FLOAT), c.try_cast("double").isNotNull()).otherwise(False)


def sanitise(c: Column) -> Column:
    """A name of letters, digits and underscores, 64 at most; never all digits."""
    kept = F.regexp_replace(F.regexp_replace(uni_trim(c), r"(?U)[^\w]", "_"), "_+", "_")
    kept = F.btrim(kept, F.lit("_"))
    named = F.when(kept.rlike(r"^\d+$"), F.concat(F.lit("y_"), kept)).otherwise(kept)
    return F.when(c.isNull(), "col_unknown").when(blank(c) | (kept == ""), "col_empty").otherwise(F.substring(named, 1, 64))


def reserve_id(c: Column) -> Column:
    return F.when(F.lower(c) == "id", "row_id").otherwise(c)


def numbered(base: Column, occurrence: Column, limit: int = 64) -> Column:
    """The base for occurrence 0, else base_k, the base cut so that it all fits."""
    suffix = F.concat(F.lit("_"), occurrence.cast("string"))
    cut = F.substr(base, F.lit(1), (F.lit(limit) - F.length(suffix)).cast("int"))
    return F.when(occurrence == 0, base).otherwise(F.concat(cut, suffix))


def source_file(c: Column) -> Column:
    """A path with forward slashes; of a long one the last three segments."""
    path = F.replace(c, F.lit("\\"), F.lit("/"))
    return F.when(F.length(c) <= 200, path).otherwise(F.substring_index(path, "/", -3))


def placeholder_table(status: Column, file: Column, sheet: Column, index: Column) -> Column:
    raw = F.concat_ws("_", status, file, F.nullif(sheet, F.lit("")), F.concat(F.lit("s"), index.cast("string")))
    return F.substring(F.regexp_replace(raw, r"(?U)\W", "_"), 1, 64)


def fallback_table(file: Column, sheet: Column, index: Column) -> Column:
    base = F.regexp_replace(F.substring_index(file, "/", -1), r"\.[^.]*$", "")
    raw = F.concat_ws("_", F.lit("ods"), base, sheet, F.concat(F.lit("s"), index.cast("string")))
    return F.substring(F.regexp_replace(F.regexp_replace(raw, r"(?U)\W", "_"), "_+", "_"), 1, 64)


def column_type(longest: Column) -> Column:
    """The least text type that holds this many characters, widened in steps of 512."""
    return (
        F.when(longest <= 512, "VARCHAR(512)")
        .when(longest <= 16_383, F.concat(F.lit("VARCHAR("), ((F.floor(longest / 512) + 1) * 512).cast("string"), F.lit(")")))
        .when(longest <= 65_535, "TEXT")
        .otherwise("MEDIUMTEXT")
    )


def json_candidates(c: Column) -> list[Column]:
    """Where a reply may hold its JSON object: all of it, a fenced block, the first brace to the last."""
    fenced = F.nullif(F.regexp_extract(c, r"(?s)```(?:json)?\s*(\{.*\})\s*```", 1), F.lit(""))
    braces = F.nullif(F.regexp_extract(c, r"(?s)(\{.*\})", 1), F.lit(""))
    return [c, fenced, braces]


def recovered_json(c: Column) -> Column:
    """The first candidate that parses, as text; NULL if none."""
    valid = [F.when(F.try_parse_json(x).isNotNull() & F.trim(x).startswith("{"), F.trim(x)) for x in json_candidates(c)]
    return F.coalesce(*valid)
