"""Queries over the sheet operators, each with the SQL that says the same, where SQL can.

Sheets are lifted from tables: the orders of a customer, the lines of a document, the events of a user, the turns of a
conversation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t
from gridloom.operators import borders, fill, grid, ingest_log, naming, pairs, ranges
from gridloom.operators import predicates as p
from gridloom.plans import decision, strategies
from gridloom.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

WS = r"\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _blank(x: str) -> str:
    return f"({x} IS NULL OR NOT regexp_matches({x}, '[^{WS}]'))"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flat(df: DataFrame, width: int, *keys: str, cells: str = "cells") -> DataFrame:
    return df.select(*keys, *(F.get(cells, F.lit(i)).alias(f"c{i}") for i in range(width)))


def orders_grid(spark: SparkSession, sf_dir: str, cells: Callable[[], list[Column]] | None = None) -> DataFrame:
    """A customer's orders as a sheet: status (only where it changes), priority, amount, date."""
    orders = read(spark, sf_dir, "orders")
    before = F.lag("o_orderstatus").over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    labelled = orders.withColumn("label", F.when(before.eqNullSafe(F.col("o_orderstatus")), F.lit(None)).otherwise(F.col("o_orderstatus")))
    amount = F.format_number("o_totalprice", 2)
    made = cells() if cells else [F.col("label"), F.col("o_orderpriority"), amount, F.date_format("o_orderdate", "yyyy-MM-dd")]
    return grid.to_grid(labelled, "o_custkey", ["o_orderkey"], made)


GRID = """
grid AS (
  SELECT o_custkey AS sheet, CAST(row_number() OVER w - 1 AS INTEGER) AS row_idx, o_orderstatus AS status, o_orderpriority AS priority,
         CASE WHEN lag(o_orderstatus) OVER w = o_orderstatus THEN NULL ELSE o_orderstatus END AS label,
         format('{:,.2f}', o_totalprice) AS amount, strftime(o_orderdate, '%Y-%m-%d') AS day
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)
)"""


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document as a sheet: a row a line, a cell a word."""
    lines = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("sheet"), F.posexplode(F.split("text", "\n", -1)).alias("row_idx", "line"))
    return lines.select("sheet", "row_idx", F.split("line", " ", -1).alias("cells"))


LINES = """
lines AS (
  SELECT doc_id AS sheet, CAST(unnest(range(len(p))) AS INTEGER) AS row_idx, unnest(p) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)
), rows AS (
  SELECT sheet, row_idx, string_split(line, ' ') AS cells,
         list_transform(list_filter(string_split(line, ' '), lambda c: NOT """ + _blank("c") + """), lambda c: """ + _trim("c") + """) AS f
  FROM lines
)"""


# --- sources -------------------------------------------------------------------------------------------------------


@query("""
SELECT url, regexp_extract(url, '[^/]*$') AS file, lower(url) LIKE '%.xls' AS is_xls FROM pages
WHERE NOT starts_with(regexp_extract(url, '[^/]*$'), '~$') AND NOT regexp_matches(url, '(^|/)(tmp|backup)/')
""")
def scan_filter_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = read(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    return files.wanted(urls, skip_dirs=("tmp", "backup"), extensions=None).select(F.col("path").alias("url"), "file", "is_xls")


@query(f"WITH {GRID} SELECT * FROM (SELECT sheet, row_idx, label AS c0, priority AS c1, amount AS c2, day AS c3, count(*) OVER (PARTITION BY sheet) AS max_row, CAST(4 AS BIGINT) AS max_col, count(*) FILTER (WHERE priority[1] = '1') OVER (PARTITION BY sheet) AS merged_count FROM grid) WHERE row_idx < 3")
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders_grid(spark, sf_dir)
    merges = rows.where(F.get("cells", F.lit(1)).startswith("1")).select("sheet", F.col("row_idx").alias("r0"))
    return flat(grid.preview(rows, 3, merges), 4, "sheet", "row_idx", "max_row", "max_col", "merged_count")


@query(f"""
WITH {GRID}, part AS (SELECT sheet, row_idx, label, count(*) OVER (PARTITION BY sheet) AS raw_row_count,
  max(row_idx) FILTER (WHERE label IS NOT NULL) OVER (PARTITION BY sheet) AS last FROM grid WHERE row_idx < 500)
SELECT sheet, row_idx, label AS c0, raw_row_count FROM part WHERE row_idx <= last
""")
def first_columns_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(grid.first_columns(orders_grid(spark, sf_dir), 1), 1, "sheet", "row_idx", "raw_row_count")


@query("""
WITH cells AS (SELECT l_orderkey AS sheet, l_linenumber - 1 AS col_idx, max(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) AS value FROM lineitem GROUP BY ALL),
rows AS (SELECT DISTINCT sheet FROM cells), every AS (SELECT sheet, CAST(i AS INTEGER) AS col_idx FROM rows, range(7) r(i))
SELECT e.sheet, e.col_idx, c.value FROM every e LEFT JOIN cells c ON e.sheet = c.sheet AND e.col_idx = c.col_idx
""")
def sparse_to_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sheet"), F.lit(0).alias("row_idx"), (F.col("l_linenumber") - 1).alias("col_idx"), F.col("l_quantity").cast("long").cast("string").alias("value"))
    cells = items.groupBy("sheet", "row_idx", "col_idx").agg(F.max("value").alias("value"))
    return grid.densify(cells, cells.select("sheet", "row_idx").distinct(), 7).select("sheet", "col_idx", "value")


@query(f"WITH {GRID} SELECT sheet, row_idx, unnest([0, 1]) AS col_idx, unnest([status, priority]) AS value FROM grid")
def merged_fill_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders_grid(spark, sf_dir, lambda: [F.col("label"), F.col("o_orderpriority")])
    cells = grid.to_cells(rows)
    starts = cells.where((F.col("col_idx") == 0) & F.col("value").isNotNull()).select("sheet", F.col("row_idx").alias("r0"))
    ends = rows.groupBy("sheet").agg(F.max("row_idx").alias("last"))
    r1 = F.coalesce(F.lead("r0").over(W.partitionBy("sheet").orderBy("r0")) - 1, F.col("last"))
    merges = starts.join(ends, "sheet").select("sheet", "r0", F.lit(0).alias("c0"), r1.alias("r1"), F.lit(0).alias("c1"))
    return grid.fill_merged(cells, merges)


# --- cells and rows ------------------------------------------------------------------------------------------------


@query("""
WITH g AS (SELECT *, (o_orderkey % 1000)::VARCHAR AS a, (o_custkey % 1000)::VARCHAR AS b FROM orders)
SELECT o_orderkey, format('{:.2f}', o_totalprice) AS commas, format('{:.2f}', o_totalprice) AS spaces, CASE o_orderstatus WHEN 'O' THEN 'nano' END AS nan,
  CASE WHEN length(a) + length(b) >= 4 THEN a || b WHEN length(b) <= 2 THEN a || '.' || b ELSE a || ' ' || b END AS decimals,
  CASE WHEN o_custkey % 3 = 0 THEN a || ',' || o_orderstatus WHEN length(b) >= 2 THEN '-' || a || b || '7' ELSE '-' || a || ',' || b || ',7' END AS seams, o_orderpriority AS words FROM g
""")
def clean_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount, status = F.format_number("o_totalprice", 2), F.col("o_orderstatus")
    a, b = (F.col(c) % 1000 for c in ("o_orderkey", "o_custkey"))
    padded = F.concat(F.lit(" "), F.replace(amount, F.lit(","), F.lit(" ")), F.lit("　"))
    nan = F.when(status == "F", " NaN ").when(status == "O", "nano　").otherwise("　 \t")
    two = F.concat_ws(" ", a.cast("string"), b.cast("string"))
    seams = F.when(F.col("o_custkey") % 3 == 0, F.concat_ws(",", a.cast("string"), status)).otherwise(F.concat(F.lit("-"), a.cast("string"), F.lit(","), b.cast("string"), F.lit(",7")))
    cells = {"commas": amount, "spaces": padded, "nan": nan, "decimals": two, "seams": seams, "words": F.col("o_orderpriority")}
    return read(spark, sf_dir, "orders").select("o_orderkey", *(t.clean(c).alias(n) for n, c in cells.items()))


@query(rf"""
WITH {LINES} SELECT sheet, row_idx, len(f) AS n_filled, len(f) = 0 AS is_blank, len(f) >= 2 AND len(list_distinct(f)) = 1 AS is_title,
  CASE WHEN len(f) < 2 THEN FALSE
       WHEN len(list_filter(f, lambda c: regexp_matches(c, '{"|".join(t.HEADER_WORDS)}'))) > 0 THEN TRUE
       WHEN len(list_filter(f, lambda c: regexp_matches(regexp_replace(c, '[, \x{{3000}}]', '', 'g'), '^-?\d+(\.\d+)?$'))) > 0.4 * len(f) THEN FALSE
       WHEN len(list_filter(f, lambda c: regexp_matches(c, '19\d\d年?|20\d\d年?|\d{{4}}[-–]\d{{4}}'))) > 0 THEN TRUE
       ELSE len(f) - len(list_filter(f, lambda c: regexp_matches(regexp_replace(c, '[, \x{{3000}}]', '', 'g'), '^-?\d+(\.\d+)?$'))) >= 2 END AS is_header_like,
  len(list_filter(cells[2:], lambda c: regexp_matches(regexp_replace(c, '[, \x{{3000}}]', '', 'g'), '^-?\d+\.?\d*$'))) > 0 AS has_numbers
FROM rows
""")
def row_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("cells")
    looked = document_lines(spark, sf_dir).select("sheet", "row_idx", p.kinds(c).alias("k"), p.has_numeric_data(c).alias("has_numbers"))
    return looked.select("sheet", "row_idx", F.col("k.n_filled").cast("long").alias("n_filled"), (F.col("k.n_filled") == 0).alias("is_blank"), "k.is_title", "k.is_header_like", "has_numbers")


def noted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sheets where low priorities are footnotes and unspecified ones blank rows."""
    low, none = F.col("o_orderpriority").startswith("5"), F.col("o_orderpriority").startswith("4")
    return orders_grid(spark, sf_dir, lambda: [F.when(low, F.concat(F.lit("Note: "), F.col("o_orderstatus"))).when(~none, F.col("o_orderstatus")), F.when(~none & ~low, F.format_number("o_totalprice", 2))])


NOTED = GRID + """, noted AS (SELECT sheet, row_idx, priority[1] = '5' AS note, priority[1] = '4' AS empty,
  CASE WHEN priority[1] = '5' THEN 'Note: ' || status WHEN priority[1] <> '4' THEN status END AS c0,
  CASE WHEN priority[1] NOT IN ('4', '5') THEN amount END AS c1 FROM grid)"""


@query(f"WITH {NOTED} SELECT sheet, row_idx, note AS is_note FROM noted")
def footnote_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noted(spark, sf_dir).select("sheet", "row_idx", p.is_footnote(F.col("cells")).alias("is_note"))


@query(f"""
WITH {NOTED}, e AS (SELECT *, max(row_idx) FILTER (WHERE NOT note AND NOT empty) OVER (PARTITION BY sheet) AS content,
  max(row_idx) FILTER (WHERE note) OVER (PARTITION BY sheet) AS last_note FROM noted)
SELECT sheet, row_idx, c0, c1 FROM e WHERE last_note IS NULL OR last_note < content OR row_idx <= content
""")
def footnote_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(ranges.truncate_footnotes(noted(spark, sf_dir)), 2, "sheet", "row_idx")


@query(f"WITH {NOTED} SELECT sheet, row_idx, c0, c1 FROM (SELECT *, count(*) FILTER (WHERE note) OVER (PARTITION BY sheet ORDER BY row_idx) AS seen FROM noted) WHERE seen = 0")
def footnote_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(ranges.stop_at_footnote(noted(spark, sf_dir)), 2, "sheet", "row_idx")


@query(f"""
WITH {NOTED}, e AS (SELECT *, min(row_idx) FILTER (WHERE NOT empty) OVER (PARTITION BY sheet) AS a, max(row_idx) FILTER (WHERE NOT empty) OVER (PARTITION BY sheet) AS b,
  min(CASE WHEN NOT empty THEN row_idx END) OVER (PARTITION BY sheet ORDER BY row_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_filled FROM noted)
SELECT sheet, row_idx, a AS trim_start, next_filled FROM e WHERE row_idx BETWEEN a AND b
""")
def trim_blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.next_filled(grid.trim_blank_rows(noted(spark, sf_dir))).select("sheet", "row_idx", "trim_start", "next_filled")


@query(f"WITH {NOTED}, w AS (SELECT sheet, CASE WHEN count(c1) > 0 THEN 2 WHEN count(c0) > 0 THEN 1 ELSE 0 END AS width FROM noted GROUP BY sheet) SELECT sheet, row_idx, CAST(width AS BIGINT) AS width FROM noted JOIN w USING (sheet)")
def trim_blank_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.trim_blank_columns(noted(spark, sf_dir)).select("sheet", "row_idx", F.size("cells").cast("long").alias("width"))


@query("""
SELECT o_custkey AS sheet, CAST(coalesce(min(i) FILTER (WHERE o_orderpriority[1] <> '1'), -1) AS INTEGER) AS data_start
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders) GROUP BY 1
""")
def data_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = F.col("o_orderpriority").startswith("1")
    return ranges.data_start(orders_grid(spark, sf_dir, lambda: [F.col("o_orderstatus"), F.when(urgent, F.lit("amount")).otherwise(F.format_number("o_totalprice", 2))]))


@query(f"""
WITH {GRID}, h AS (SELECT sheet, max(row_idx) AS header_end FROM grid GROUP BY sheet),
m AS (SELECT g.sheet, row_idx, header_end, priority[1] = '1' AS lone, priority[1] <> '4' AS keep FROM grid g JOIN h ON g.sheet = h.sheet),
s AS (SELECT *, coalesce(max(CASE WHEN lone THEN row_idx END) OVER (PARTITION BY sheet), -1) AS spot FROM m)
SELECT sheet, header_end, coalesce(min(row_idx) FILTER (WHERE keep AND row_idx > spot), header_end) AS header_start FROM s GROUP BY sheet, header_end
""")
def header_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, four = F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority").startswith("4")
    rows = orders_grid(spark, sf_dir, lambda: [F.when(one, "A long title").when(~four, F.col("o_orderstatus")), F.when(~one & ~four, F.col("o_orderpriority"))])
    return ranges.header_start_from_end(rows, rows.groupBy("sheet").agg(F.max("row_idx").alias("header_end")))


@query(f"WITH {GRID}, h AS (SELECT sheet, max(row_idx) AS header_end FROM grid GROUP BY sheet) SELECT g.sheet, CASE WHEN priority[1] IN ('1', '2') AND header_end > 0 THEN header_end - 1 ELSE header_end END AS header_end FROM grid g JOIN h ON g.sheet = h.sheet AND g.row_idx = h.header_end")
def header_retreat(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.when(F.col("o_orderpriority").rlike("^[12]"), F.format_number("o_totalprice", 2)).otherwise("1999")
    rows = orders_grid(spark, sf_dir, lambda: [F.col("o_orderstatus"), F.lit("12.5"), second])
    return ranges.retreat_header(rows, rows.groupBy("sheet").agg(F.max("row_idx").alias("header_end")))


@query(f"""
WITH {GRID}, k AS (SELECT sheet, row_idx, priority[1] AS x FROM grid),
d AS (SELECT sheet, coalesce(min(row_idx) FILTER (WHERE x = '1'), -1) AS ds FROM k GROUP BY sheet),
f AS (SELECT k.sheet, row_idx, ds, x, CASE x WHEN '3' THEN 1 WHEN '4' THEN 1 ELSE 2 END AS n FROM k JOIN d ON k.sheet = d.sheet WHERE row_idx < ds),
g AS (SELECT *, coalesce(lag(n) OVER w, 0) AS above, lead(n) OVER w AS below FROM f WINDOW w AS (PARTITION BY sheet ORDER BY row_idx)),
e AS (SELECT *, max(CASE WHEN NOT (x = '5' OR (x IN ('3', '4') AND above <= 1)) THEN row_idx END) OVER (PARTITION BY sheet) AS he FROM g),
b AS (SELECT *, row_idx = he AS own, row_idx < he AND coalesce(below > 1, FALSE) AS fits FROM e WHERE row_idx <= he),
s AS (SELECT *, coalesce(max(CASE WHEN x = '4' AND NOT fits AND NOT own THEN row_idx END) OVER (PARTITION BY sheet), -1) AS stop FROM b),
r AS (SELECT sheet, min(row_idx) AS hs, max(he) AS he FROM s WHERE row_idx > stop AND (own OR (x <> '5' AND NOT (x IN ('3', '4') AND NOT fits))) GROUP BY sheet)
SELECT d.sheet, coalesce(hs, 0) AS header_start, coalesce(he, 0) AS header_end FROM d LEFT JOIN r ON d.sheet = r.sheet
""")
def header_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.substring("o_orderpriority", 1, 1)
    first = F.when(x == "1", "北京").when(x == "2", "指标").when(x == "3", "单位").when(x == "4", "全国人口统计表").otherwise("标题")
    second = F.when(x == "1", F.format_number("o_totalprice", 2)).when(x == "2", "年份").when(x == "5", "标题")
    return ranges.header_range(orders_grid(spark, sf_dir, lambda: [first, second]))


# --- filling -------------------------------------------------------------------------------------------------------


@query(f"WITH {GRID} SELECT sheet, row_idx, status AS c0, amount AS c2 FROM grid")
def ffill_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(fill.forward_fill(orders_grid(spark, sf_dir)), 4, "sheet", "row_idx").drop("c1", "c3")


@query(f"""
WITH {GRID}, g AS (SELECT *, coalesce(sum(CAST(b AS INTEGER)) OVER (PARTITION BY sheet ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gid
  FROM (SELECT *, priority[1] = '1' AS b FROM grid)),
m AS (SELECT *, min(label) OVER k AS lo, max(label) OVER k AS hi, count(*) OVER k AS n FROM g WINDOW k AS (PARTITION BY sheet, gid))
SELECT sheet, row_idx, CAST(gid AS BIGINT) AS gid, CASE WHEN label IS NULL AND lo = hi AND n > 1 THEN lo ELSE label END AS c0 FROM m
""")
def ffill_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders_grid(spark, sf_dir).withColumn("border", F.get("cells", F.lit(1)).startswith("1"))
    return flat(fill.group_fill(fill.bordered_groups(rows)), 1, "sheet", "row_idx", "gid")


@query(f"""
WITH {GRID}, c AS (SELECT sheet, row_idx, CASE WHEN priority[1] IN ('1', '5') THEN status END AS c0, CASE WHEN priority[1] NOT IN ('1', '4') THEN amount END AS c1 FROM grid),
l AS (SELECT *, lag(CASE WHEN c0 IS NOT NULL AND c1 IS NULL THEN c0 END) OVER (PARTITION BY sheet ORDER BY row_idx) AS above FROM c WHERE c0 IS NOT NULL OR c1 IS NOT NULL)
SELECT sheet, row_idx, coalesce(c0, above) AS c0, c1 FROM l UNION ALL SELECT sheet, row_idx, c0, c1 FROM c WHERE c0 IS NULL AND c1 IS NULL
""")
def category_pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.substring("o_orderpriority", 1, 1)
    rows = orders_grid(spark, sf_dir, lambda: [F.when(kind.isin("1", "5"), F.col("o_orderstatus")), F.when(~kind.isin("1", "4"), F.format_number("o_totalprice", 2))])
    return flat(fill.push_down_categories(rows), 2, "sheet", "row_idx")


# --- records of several rows ---------------------------------------------------------------------------------------


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("role") == "user"
    return grid.to_grid(read(spark, sf_dir, "conversations"), "conv_id", ["turn", "text"], [F.when(user, F.col("role")), F.col("text"), F.when(user, F.length("text"))])


TURNS = """
t AS (SELECT conv_id AS sheet, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, text NULLS FIRST) - 1 AS i, CASE WHEN role = 'user' THEN role END AS c0, text AS c1,
  CASE WHEN role = 'user' THEN CAST(length(text) AS VARCHAR) END AS c2 FROM conversations)"""


@query(f"""
WITH {TURNS}, f AS (SELECT sheet, i // 2 AS rec, coalesce(max(c0) FILTER (WHERE i % 2 = 0), '') AS c0, coalesce(max(c1) FILTER (WHERE i % 2 = 0), '') AS c1, coalesce(max(c2) FILTER (WHERE i % 2 = 0), '') AS c2,
  coalesce(string_agg(c0, ' ' ORDER BY i) FILTER (WHERE i % 2 > 0), '') AS c3, coalesce(string_agg(c1, ' ' ORDER BY i) FILTER (WHERE i % 2 > 0 AND NOT {_blank("c1")}), '') AS c4, coalesce(string_agg(c2, ' ' ORDER BY i) FILTER (WHERE i % 2 > 0), '') AS c5 FROM t GROUP BY 1, 2)
SELECT sheet, CAST(rec AS BIGINT) AS rec, c0, c1, c2, c3, c4, c5 FROM f WHERE regexp_matches(c0 || c1 || c2 || c3 || c4 || c5, '[^{WS}]')
""")
def paired_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(pairs.fold(turns(spark, sf_dir)), 6, "sheet", "rec")


@query(f"""
WITH {TURNS}, n AS (SELECT sheet, i, CAST(NOT {_blank("c0")} AS INTEGER) + CAST(NOT {_blank("c1")} AS INTEGER) + CAST(NOT {_blank("c2")} AS INTEGER) AS n FROM t),
e AS (SELECT *, i // span AS g, i % span AS off FROM n, (VALUES (2), (3), (4)) v(span) WHERE i // span < 24),
m AS (SELECT *, max(CASE WHEN off = 0 THEN n END) OVER (PARTITION BY sheet, span, g) AS main FROM e),
q AS (SELECT sheet, span, g, max(main) AS main, count(*) FILTER (WHERE off > 0 AND n >= 1 AND n <= greatest(1, floor(main * 0.6))) AS cont FROM m GROUP BY ALL),
s AS (SELECT sheet, span, count(*) FILTER (WHERE main >= 2 AND cont = span - 1) / count(*) AS score FROM q GROUP BY ALL)
SELECT sheet, CAST(CASE WHEN max(score) >= 0.7 THEN arg_max(span, score * 1000 - span) ELSE 2 END AS INTEGER) AS span FROM s GROUP BY sheet
""")
def record_span_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.record_span(pairs.record_span_scores(turns(spark, sf_dir)))


@query(f"WITH {TURNS}, p AS (SELECT * FROM t WHERE i < 40 AND i % 2 > 0) SELECT DISTINCT sheet, k AS col_idx FROM (SELECT sheet, 0 AS k, c0 AS v FROM p UNION ALL SELECT sheet, 1, c1 FROM p UNION ALL SELECT sheet, 2, c2 FROM p) WHERE NOT {_blank('v')}")
def continuation_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.continuation_columns(turns(spark, sf_dir))


@query(f"""
WITH {GRID}, k AS (SELECT sheet, row_idx, priority[1] AS x FROM grid),
c AS (SELECT *, lead(x) OVER w AS nx, lag(row_idx) OVER w AS before, lag(x) OVER w AS px FROM k WHERE x <> '5' WINDOW w AS (PARTITION BY sheet ORDER BY row_idx))
SELECT c.sheet, min(b.row_idx) AS split FROM c JOIN k b ON b.sheet = c.sheet AND b.x = '5' AND b.row_idx > c.before AND b.row_idx < c.row_idx
WHERE (c.x = '1' AND coalesce(px, '') <> '4') OR (c.x = '4' AND nx = '1') GROUP BY c.sheet, c.row_idx
""")
def vertical_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.substring("o_orderpriority", 1, 1)
    first = F.when(x == "1", "指标").when(x == "4", "Totals").when(x != "5", "7.5")
    return ranges.vertical_splits(orders_grid(spark, sf_dir, lambda: [first, F.when(x == "1", "年份").when(x.isin("2", "3"), F.format_number("o_totalprice", 2))]))


# --- borders -------------------------------------------------------------------------------------------------------


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = (F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("int")
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("sheet"), row.alias("row_idx"), (F.col("event_type") == "error").alias("boundary"))


EVENTS = "e AS (SELECT user_id AS sheet, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS row_idx, event_type = 'error' AS boundary FROM events)"


@query(f"""
WITH {EVENTS}, s AS (SELECT sheet, avg(CAST(boundary AS INTEGER)) AS share, max(row_idx) AS last FROM e GROUP BY sheet),
g AS (SELECT e.sheet, row_idx, coalesce(lead(row_idx) OVER (PARTITION BY e.sheet ORDER BY row_idx), last + 1) - row_idx - 1 AS gap FROM e JOIN s ON e.sheet = s.sheet WHERE boundary AND share <= 0.7),
o AS (SELECT sheet, row_idx, boundary, coalesce(sum(CAST(NOT boundary AS INTEGER)) OVER (PARTITION BY sheet ORDER BY row_idx ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING), 0) AS open FROM e),
f AS (SELECT o.sheet, min(row_idx) FILTER (WHERE open >= 2) AS other FROM o JOIN s ON o.sheet = s.sheet WHERE boundary AND share <= 0.7 GROUP BY o.sheet),
b AS (SELECT sheet, row_idx, gap FROM g WHERE gap >= 2 QUALIFY row_number() OVER (PARTITION BY sheet ORDER BY gap DESC, row_idx) = 1)
SELECT f.sheet, coalesce(row_idx, other) AS header_end, gap FROM f LEFT JOIN b ON f.sheet = b.sheet WHERE coalesce(row_idx, other) IS NOT NULL
""")
def boundary_gap_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return borders.header_end_by_border(event_rows(spark, sf_dir))


@query(f"WITH {EVENTS}, s AS (SELECT sheet, row_idx, row_idx - coalesce(lag(row_idx) OVER (PARTITION BY sheet ORDER BY row_idx), -1) - 1 AS streak FROM e WHERE boundary) SELECT * FROM s WHERE streak >= 2")
def dash_streak_preclassify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return borders.dash_streak(event_rows(spark, sf_dir))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    style = F.when(F.col("l_returnflag") == "A", "thin").when(F.col("l_returnflag") == "R", "dashed")
    return read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sheet"), F.col("l_orderkey").alias("row_idx"), F.col("l_linenumber").alias("col_idx"), style.alias("edge"))


def _edge_sql(along: str, across: str) -> str:
    return f"""
WITH c AS (SELECT l_suppkey AS sheet, {along} AS k, {across} AS a, CASE l_returnflag WHEN 'A' THEN 'thin' WHEN 'R' THEN 'dashed' END AS edge FROM lineitem),
b AS (SELECT sheet, k, edge, count(*) AS n, min(a) AS spot FROM c WHERE edge IS NOT NULL GROUP BY ALL),
m AS (SELECT sheet, k, edge, sum(n) OVER (PARTITION BY sheet, k) AS styled FROM b QUALIFY row_number() OVER (PARTITION BY sheet, k ORDER BY n DESC, spot, edge) = 1),
w AS (SELECT sheet, k, count(*) AS width FROM c GROUP BY ALL)
SELECT w.sheet, w.k AS {{name}}, m.edge AS style, coalesce(styled, 0)::DOUBLE / width AS ratio, coalesce(m.edge = 'thin', FALSE) AS is_solid, coalesce(m.edge = 'dashed', FALSE) AS is_dash
FROM w LEFT JOIN m ON w.sheet = m.sheet AND w.k = m.k"""


@query(_edge_sql("l_orderkey", "l_linenumber").format(name="row_idx"))
def border_row_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return borders.edge_stats(edges(spark, sf_dir), "row_idx", "edge")


@query(_edge_sql("l_linenumber", "l_orderkey").format(name="col_idx"))
def border_col_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return borders.edge_stats(edges(spark, sf_dir), "col_idx", "edge")


@query(f"""
WITH s AS ({_edge_sql("l_linenumber", "l_orderkey").format(name="col_idx")})
SELECT DISTINCT sheet, col_idx FROM (SELECT *, lag(ratio) OVER w AS before, count(*) OVER (PARTITION BY sheet) AS n,
  arg_min(ratio, col_idx) FILTER (WHERE ratio >= 0.3) OVER (PARTITION BY sheet ORDER BY col_idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM s WINDOW w AS (PARTITION BY sheet ORDER BY col_idx))
WHERE (is_dash AND ratio >= 0.3) OR (n >= 4 AND ratio < 0.3 AND before > 0.5 AND coalesce(after, 1) > 0.5)
""")
def border_split_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return borders.split_columns(borders.edge_stats(edges(spark, sf_dir), "col_idx", "edge"))


# --- columns -------------------------------------------------------------------------------------------------------


def gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = F.lit(None).cast("string")
    return grid.to_cells(orders_grid(spark, sf_dir, lambda: [F.col("label"), F.col("o_orderpriority"), empty, empty, F.format_number("o_totalprice", 2)]))


GAPPED = GRID + """, cells AS (SELECT sheet, row_idx, unnest([0, 1, 2, 3, 4]) AS col_idx, unnest([label, priority, NULL, NULL, amount]) AS value FROM grid),
cols AS (SELECT sheet, col_idx, (count(*) - count(value))::DOUBLE / count(*) AS ratio FROM cells GROUP BY ALL)"""


@query(f"WITH {GAPPED} SELECT *, ratio > 0.8 AS is_blank FROM cols")
def blank_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.blank_columns(gapped(spark, sf_dir))


@query(f"WITH {GAPPED}, f AS (SELECT *, col_idx - row_number() OVER (PARTITION BY sheet ORDER BY col_idx) AS k FROM cols WHERE ratio <= 0.8) SELECT sheet, min(col_idx) AS start, max(col_idx) AS \"end\" FROM f GROUP BY sheet, k")
def blank_column_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.column_islands(ranges.blank_columns(gapped(spark, sf_dir)))


@query("SELECT DISTINCT o_custkey AS sheet, CAST(2 + o_custkey % 3 AS INTEGER) AS split_col FROM orders WHERE o_custkey % 3 < 2")
def split_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets with two blank columns, with one and then three, and with blank columns at their end only."""
    none, kind = F.lit(None).cast("string"), F.col("sheet") % 3
    rows = orders_grid(spark, sf_dir, lambda: [F.col("o_orderpriority"), F.format_number("o_totalprice", 2)])
    at = lambda i: F.get("cells", F.lit(i))
    cells = F.when(kind == 0, F.array(at(0), at(1), none, none, at(1))).when(kind == 1, F.array(at(0), none, at(0), none, none, none, at(1))).otherwise(F.array(at(0), at(1), none, none))
    return ranges.split_column(ranges.blank_columns(grid.to_cells(rows.withColumn("cells", cells))))


@query("""
WITH i AS (SELECT l_orderkey AS sheet, l_linenumber AS a, l_linenumber + CAST(l_quantity AS INTEGER) % 4 AS b FROM lineitem),
l AS (SELECT DISTINCT sheet, a, b FROM i WHERE a % 2 = 1), r AS (SELECT sheet, a, b, a AS hint FROM i WHERE a % 2 = 0)
SELECT l.sheet, l.a AS start, l.b AS "end", hint, least(l.b, r.b) - greatest(l.a, r.a) + 1 AS overlap FROM l JOIN r ON l.sheet = r.sheet AND least(l.b, r.b) >= greatest(l.a, r.a)
QUALIFY row_number() OVER (PARTITION BY l.sheet, l.a, l.b ORDER BY overlap DESC, hint) = 1
""")
def overlap_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sheet"), F.col("l_linenumber").alias("start"), (F.col("l_linenumber") + F.col("l_quantity").cast("int") % 4).alias("end"))
    return ranges.best_overlap(items.where(F.col("start") % 2 == 1).distinct(), items.where(F.col("start") % 2 == 0).withColumn("hint", F.col("start")))


@query(f"WITH {GRID} SELECT DISTINCT sheet, CAST(3 AS INTEGER) AS split_col FROM (SELECT sheet, arg_max(priority[1], -row_idx) AS x FROM grid WHERE row_idx < 5 GROUP BY sheet) WHERE x IN ('1', '2')")
def repeated_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("o_orderpriority").rlike("^[12]")
    return ranges.repeated_header(orders_grid(spark, sf_dir, lambda: [F.lit("年份"), F.lit("男"), F.lit("女"), F.when(x, "年份").otherwise("a"), F.when(x, "男").otherwise("b"), F.lit("女")]))


@query(f"WITH {GRID} SELECT sheet, row_idx, 'left' AS label, label AS c0, priority AS c1 FROM grid UNION ALL SELECT sheet, row_idx, 'right', amount, day FROM grid")
def region_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(grid.regions(orders_grid(spark, sf_dir), [(0, 1, "left"), (2, 3, "right")]), 2, "sheet", "row_idx", "label")


@query("""
SELECT o_orderkey, o_orderstatus AS c0, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS c1 FROM orders
""")
def thousands_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.floor("o_totalprice").cast("long")
    split = F.concat(F.array("o_orderstatus"), F.split(F.format_number(whole.cast("double"), 0), ","))
    rows = read(spark, sf_dir, "orders").withColumn("cells", split)
    return flat(rows.withColumn("cells", p.merge_thousands(F.col("cells"), F.lit(2))), 2, "o_orderkey")


# --- names ---------------------------------------------------------------------------------------------------------

WORDS = r"\pL\p{Mn}\p{Me}\p{Mc}\p{Nd}\p{Pc}"


def _sanitise(x: str) -> str:
    kept = f"trim(regexp_replace(regexp_replace({_trim(x)}, '[^{WORDS}]', '_', 'g'), '_+', '_', 'g'), '_')"
    return f"CASE WHEN {x} IS NULL THEN 'col_unknown' WHEN {kept} = '' THEN 'col_empty' WHEN regexp_matches({kept}, '^[0-9]+$') THEN substring('y_' || {kept}, 1, 64) ELSE substring({kept}, 1, 64) END"


@query(f"SELECT p_partkey, {_sanitise('p_name')} AS name, {_sanitise('p_brand')} AS brand, {_sanitise('CAST(p_size AS VARCHAR)')} AS size_name, CASE WHEN lower(p_type) = 'id' THEN 'row_id' ELSE p_type END AS type_name FROM part")
def sanitise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", t.sanitise(F.col("p_name")).alias("name"), t.sanitise(F.col("p_brand")).alias("brand"), t.sanitise(F.col("p_size").cast("string")).alias("size_name"), t.reserve_id(F.col("p_type")).alias("type_name"))


@query("""
SELECT p_size AS sheet, p_partkey AS pos, p_brand AS name, CASE WHEN k = 0 THEN p_brand ELSE substring(p_brand, 1, 63 - len(CAST(k AS VARCHAR))) || '_' || k END AS unique_name
FROM (SELECT *, row_number() OVER (PARTITION BY p_size, p_brand ORDER BY p_partkey) - 1 AS k FROM part)
""")
def unique_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.unique_names(read(spark, sf_dir, "part").select(F.col("p_size").alias("sheet"), F.col("p_partkey").alias("pos"), F.col("p_brand").alias("name")))


@query(r"""
WITH n AS (SELECT c_custkey, substring(regexp_replace('ERROR_' || c_name || '_' || c_mktsegment || '_s' || c_nationkey, '\W', '_', 'g'), 1, 64) AS placeholder,
  substring(regexp_replace(regexp_replace('ods_' || c_name || '_' || c_mktsegment || '_s' || c_nationkey, '\W', '_', 'g'), '_+', '_', 'g'), 1, 64) AS fallback,
  'ods_' || lower(c_mktsegment) AS base FROM customer),
k AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY c_custkey) - 1 AS k FROM n)
SELECT c_custkey, placeholder, fallback, CASE WHEN k = 0 THEN base ELSE base || '_' || k END AS table_name FROM k
""")
def table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, sheet, index = F.concat(F.lit("in/"), F.col("c_name"), F.lit(".xlsx")), F.col("c_mktsegment"), F.col("c_nationkey")
    named = read(spark, sf_dir, "customer").select("c_custkey", t.placeholder_table(F.lit("ERROR"), F.col("c_name"), sheet, index).alias("placeholder"), t.fallback_table(name, sheet, index).alias("fallback"), F.concat(F.lit("ods_"), F.lower(sheet)).alias("base"))
    return naming.unique_names_of_one(named, "c_custkey", "base").select("c_custkey", "placeholder", "fallback", F.col("unique_name").alias("table_name"))


@query(f"""
SELECT n_regionkey AS sheet, n_nationkey AS col_idx, {_sanitise("CASE WHEN r_name = n_name THEN r_name ELSE r_name || n_name END")} AS name
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def header_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = F.explode(F.array(F.struct(F.lit(0).alias("row_idx"), F.col("r_name").alias("value")), F.struct(F.lit(1).alias("row_idx"), F.col("n_name").alias("value")), F.struct(F.lit(2).alias("row_idx"), F.lit(" ").alias("value")))).alias("x")
    return naming.merged_header(both.select(F.col("n_regionkey").alias("sheet"), F.col("n_nationkey").alias("col_idx"), rows).select("sheet", "col_idx", "x.*"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 10 >= 8 AND p_size % 2 = 1 THEN p_brand WHEN p_size % 2 = 0 THEN 'code' WHEN p_size % 10 >= 6 THEN p_brand ELSE 'code' END AS c0, p_type AS c1 FROM part
""")
def fuse_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("p_size") % 2 == 0
    advised = F.array(F.when(even, "col_3").otherwise(F.col("p_brand")), F.col("p_type"))
    fused = naming.fuse(F.array(F.lit("code"), F.lit("col_1")), advised, F.col("p_size") % 10 / 10)
    return flat(read(spark, sf_dir, "part").select("p_partkey", fused.alias("cells")), 2, "p_partkey")


@query(r"""
WITH n AS (SELECT p_partkey, p_name,
  CASE p_partkey % 5 WHEN 0 THEN '第' || p_size || '组' || (p_partkey % 7) || '班' WHEN 1 THEN (1950 + p_size) || ' ' || (2000 + p_size % 9) || CASE WHEN p_size % 2 = 0 THEN '产量' ELSE '人口' END
    WHEN 2 THEN '人口' || (1990 + p_size) WHEN 3 THEN p_name ELSE '规格' || p_size || '号' || (p_size + 3) END AS src,
  CASE p_partkey % 6 WHEN 0 THEN 'class_' || (p_partkey % 9) || '_group' WHEN 1 THEN 'growth_' || (1951 + p_size) || '_x' WHEN 2 THEN replace(p_name, ' ', '_') || '_' WHEN 3 THEN 'Pop_' || (1990 + p_size) || '_v2' WHEN 4 THEN 'size_' || p_size ELSE '_' || p_size || 'a' || p_size || 'b7' END AS en FROM part),
w AS (SELECT *, regexp_extract_all(src, '\d+') AS w, regexp_extract_all(en, '\d+') AS f, string_split_regex(en, '\d+') AS gaps FROM n),
k AS (SELECT *, list_filter(w, lambda x: length(x) = 4) AS years, regexp_extract(en, '^([a-z_]+?)_?\d', 1) AS letters, CASE WHEN trim(regexp_replace(src, '\d+', '', 'g')) = '产量' THEN 'output' ELSE 'col' END AS part FROM w)
SELECT p_partkey, CASE WHEN len(w) = 0 THEN en
  WHEN len(years) > 0 AND len(list_filter(years, lambda y: contains(en, y))) = 0 THEN array_to_string(list_filter(list_concat([CASE WHEN letters = '' THEN part ELSE rtrim(letters, '_') END], w), lambda x: x <> ''), '_')
  WHEN len(f) = 0 THEN rtrim(en, '_') || '_' || array_to_string(w, '_')
  WHEN len(f) >= len(w) THEN array_to_string(list_transform(gaps, lambda g, i: g || coalesce(w[i], f[i], '')), '')
  ELSE list_reduce(list_concat([en], w), lambda a, x: CASE WHEN contains(a, x) THEN a ELSE rtrim(a, '_') || '_' || x END) END AS name FROM k
""")
def numeric_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    text = lambda *parts: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))
    source = (
        F.when(key % 5 == 0, text("第", size, "组", key % 7, "班")).when(key % 5 == 1, text(size + 1950, " ", size % 9 + 2000, F.when(size % 2 == 0, "产量").otherwise("人口")))
        .when(key % 5 == 2, text("人口", size + 1990)).when(key % 5 == 3, F.col("p_name")).otherwise(text("规格", size, "号", size + 3))
    )
    english = (
        F.when(key % 6 == 0, text("class_", key % 9, "_group")).when(key % 6 == 1, text("growth_", size + 1951, "_x")).when(key % 6 == 2, text(F.replace("p_name", F.lit(" "), F.lit("_")), "_"))
        .when(key % 6 == 3, text("Pop_", size + 1990, "_v2")).when(key % 6 == 4, text("size_", size)).otherwise(text("_", size, "a", size, "b7"))
    )
    return read(spark, sf_dir, "part").select("p_partkey", naming.repair_digits(source, english).alias("name"))


@query(rf"""
WITH m AS (SELECT unnest({list(naming.KEYWORDS)}) AS k, unnest({list(naming.KEYWORDS.values())}) AS v, unnest(range({len(naming.KEYWORDS)})) AS pos),
n AS (SELECT p_partkey, (SELECT k FROM m WHERE pos = p_size % 31) || CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN '_' || (SELECT k FROM m WHERE pos = p_partkey % 31) ELSE (1980 + p_size)::VARCHAR END AS src,
  CASE p_partkey % 4 WHEN 0 THEN 'Total_' || (SELECT v FROM m WHERE pos = p_size % 31) WHEN 1 THEN 'x_' || (1980 + p_size) WHEN 2 THEN 'something_of_' || p_partkey || '_detail' ELSE lower(split_part(p_name, ' ', 1)) END AS en FROM part),
h AS (SELECT p_partkey, list(v ORDER BY pos) AS parts FROM n JOIN m ON contains(src, k) OR contains(replace(src, '_', ''), k) GROUP BY p_partkey),
w AS (SELECT n.*, coalesce(parts, []) AS parts, regexp_extract_all(src, '\d+') AS num FROM n LEFT JOIN h ON n.p_partkey = h.p_partkey)
SELECT p_partkey, CASE WHEN len(list_filter(num, lambda x: contains(en, x))) > 0 OR len(parts) = 0 OR len(list_filter(parts, lambda x: contains(lower(en), x))) > 0
  OR (length(en) >= 15 AND length(en) - length(replace(en, '_', '')) >= 2) THEN en ELSE array_to_string(list_concat(parts, list_filter(num, lambda x: NOT contains(en, x))), '_') END AS name FROM w
""")
def semantic_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    word, english_word = (F.array(*map(F.lit, x)) for x in (naming.KEYWORDS, naming.KEYWORDS.values()))
    end = F.when(key % 3 == 0, "").when(key % 3 == 1, F.concat(F.lit("_"), F.get(word, (key % 31).cast("int")))).otherwise((size + 1980).cast("string"))
    english = (
        F.when(key % 4 == 0, F.concat(F.lit("Total_"), F.get(english_word, size % 31))).when(key % 4 == 1, F.concat(F.lit("x_"), (size + 1980).cast("string")))
        .when(key % 4 == 2, F.concat(F.lit("something_of_"), key.cast("string"), F.lit("_detail"))).otherwise(F.lower(F.substring_index("p_name", " ", 1)))
    )
    return read(spark, sf_dir, "part").select("p_partkey", naming.repair_meaning(F.concat(F.get(word, size % 31), end), english).alias("name"))


# --- planning and logging ------------------------------------------------------------------------------------------


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def processed_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("ERROR")
    log = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), status.alias("status"))
    return ingest_log.unprocessed(read(spark, sf_dir, "customer").select("c_custkey"), log, ["c_custkey"])


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def log_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_log.upserted(read(spark, sf_dir, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_log.summary(read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status")))


@query("""
WITH m AS (SELECT 'text' AS column_name, max(length(text)) AS longest FROM documents UNION ALL SELECT 'lang', max(length(lang)) FROM documents UNION ALL SELECT 'source', max(length(source)) FROM documents)
SELECT column_name, longest, CASE WHEN longest <= 512 THEN 'VARCHAR(512)' WHEN longest <= 16383 THEN 'VARCHAR(' || ((longest // 512 + 1) * 512) || ')' WHEN longest <= 65535 THEN 'TEXT' ELSE 'MEDIUMTEXT' END AS column_type FROM m
""")
def max_len_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_log.longest(read(spark, sf_dir, "documents").select("text", "lang", "source"))


@query(f"WITH {LINES} SELECT sheet, max(len(cells)) AS width, CASE WHEN max(len(cells)) > 100 OR count(*) FILTER (WHERE len(f) > 0) = 0 THEN 'SKIP' ELSE 'SUCCESS' END AS status FROM rows GROUP BY sheet")
def wide_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = document_lines(spark, sf_dir).groupBy("sheet").agg(F.max(F.size("cells")).cast("long").alias("width"), F.count_if(~p.is_blank(F.col("cells"))).alias("n"))
    return by.select("sheet", "width", ingest_log.guarded(F.col("width"), F.col("n")).alias("status"))


@query("""
SELECT event_id, CASE WHEN event_type IN ('view') THEN 'standard' ELSE 'UNKNOWN' END AS strategy,
  least(greatest(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0), 0), 1) AS confidence FROM events
""")
def decision_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    strategy = F.when(F.col("event_type") == "view", "standard").otherwise(F.col("event_type"))
    made = decision.validated(strategy, F.get_json_object("props", "$.k"))
    return read(spark, sf_dir, "events").select("event_id", made.alias("d")).select("event_id", "d.*")


@query("SELECT event_id, json_extract_string(props, '$.k') AS plain, json_extract_string(props, '$.k') AS fenced, json_extract_string(props, '$.k') AS prose, NULL::VARCHAR AS broken FROM events")
def json_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = lambda c: F.get_json_object(t.recovered_json(c), "$.k")
    wrapped = F.concat(F.lit("Here:\n```json\n"), F.col("props"), F.lit("\n```\nDone."))
    return read(spark, sf_dir, "events").select("event_id", k(F.col("props")).alias("plain"), k(wrapped).alias("fenced"), k(F.concat(F.lit("It is "), F.col("props"), F.lit(" I think"))).alias("prose"), k(F.lit("{no")).alias("broken"))


# --- strategies ----------------------------------------------------------------------------------------------------


@query(f"""
WITH {GRID}, r AS (SELECT *, last_value(label IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY row_idx) AS filled, label IS NULL OR row_idx < 0 AS x FROM grid)
SELECT sheet, CAST(row_idx + 1 AS BIGINT) AS row_no, filled AS c0, priority AS c1, replace(amount, ',', '') AS c2, day AS c3 FROM r
""")
def recovered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: customers' sheets with a header, blank rows and repeated labels left out, read back as relations."""
    rows = orders_grid(spark, sf_dir)
    header = F.array(*map(F.lit, ("状态", "优先级", "金额", "日期")))
    first = rows.select("sheet").distinct().select("sheet", F.lit(-1).alias("row_idx"), header.alias("cells"))
    sheets = first.unionByName(rows).withColumn("row_idx", F.col("row_idx") + 1)
    return flat(strategies.simple_header(sheets), 4, "sheet", "row_no")


def queries() -> dict[str, Query]:
    from gridloom import queries_layout, queries_tables  # noqa: F401  (they add their own)

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
