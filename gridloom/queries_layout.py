"""Queries over headers, regions, borders, decisions and the log, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.operators import borders, headers, ingest_log, naming, ranges, regions
from gridloom.plans import decision
from gridloom.queries import EVENTS, GAPPED, GRID, _edge_sql, edges, event_rows, gapped, orders_grid, query, read
from gridloom.session import dealt

KEYED = GRID + ", k AS (SELECT sheet, row_idx, priority[1] AS x, status, amount FROM grid)"


# --- borders -------------------------------------------------------------------------------------------------------


@query(f"WITH s AS ({_edge_sql('l_orderkey', 'l_linenumber').format(name='row_idx')}) SELECT sheet, row_idx FROM s WHERE (is_solid AND ratio >= 0.7) OR (is_dash AND ratio >= 0.3)")
def boundary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = borders.edge_stats(edges(spark, sf_dir), "row_idx", "edge")
    return stats.where(borders.is_boundary(F.col("ratio"), F.col("is_solid"), F.col("is_dash"))).select("sheet", "row_idx")


@query(f"""
WITH {EVENTS}, s AS (SELECT sheet, max(row_idx) AS last FROM e GROUP BY sheet),
g AS (SELECT e.sheet, row_idx, least(9, coalesce(lead(row_idx) OVER (PARTITION BY e.sheet ORDER BY row_idx), last + 1) - row_idx - 1) AS gap FROM e JOIN s ON e.sheet = s.sheet WHERE boundary)
SELECT sheet, row_idx AS header_end, gap FROM g WHERE gap >= 2 AND row_idx < 15 QUALIFY row_number() OVER (PARTITION BY sheet ORDER BY gap DESC, row_idx) = 1
""")
def region_border_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return borders.region_header_end(event_rows(spark, sf_dir))


@query("""
WITH e AS (SELECT user_id AS sheet, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS row_idx, event_type AS t FROM events),
u AS (SELECT *, t IN ('error', 'signup') AS edge, count(*) FILTER (WHERE t = 'error') OVER (PARTITION BY sheet) AS strong FROM e WHERE row_idx > 1),
b AS (SELECT *, lead(row_idx) OVER (PARTITION BY sheet ORDER BY row_idx) AS nx FROM u WHERE t = 'error' OR (t = 'signup' AND strong < 2))
SELECT b.sheet, b.row_idx AS split FROM b JOIN u j ON j.sheet = b.sheet AND j.row_idx > b.row_idx AND j.row_idx < b.nx
GROUP BY b.sheet, b.row_idx HAVING count(*) FILTER (WHERE NOT j.edge) >= 2 AND count(*) FILTER (WHERE j.t = 'view') >= 1
""")
def splits_by_border(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    row = event_rows(spark, sf_dir)
    typed = read(spark, sf_dir, "events").select(F.col("user_id").alias("sheet"), (F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("int").alias("row_idx"), "event_type")
    ratio = F.when(kind == "error", 0.9).when(kind == "signup", 0.5).when(kind == "view", 0.0).otherwise(0.2)
    rows = typed.select("sheet", "row_idx", ratio.alias("bottom_ratio"), F.lit(0.0).alias("top_ratio"), (kind == "error").alias("is_solid"), (kind == "signup").alias("is_dash"))
    return borders.splits_by_border(rows, row.select("sheet").distinct().withColumn("header_end", F.lit(1)))


@query(f"""
WITH {GRID}, k AS (SELECT sheet, row_idx, priority[1] AS x FROM grid WHERE row_idx >= 2),
c AS (SELECT *, lead(x) OVER w AS nx, lag(row_idx) OVER w AS before, lag(x) OVER w AS px FROM k WHERE x <> '5' WINDOW w AS (PARTITION BY sheet ORDER BY row_idx))
SELECT c.sheet, min(b.row_idx) - 1 AS split FROM c JOIN k b ON b.sheet = c.sheet AND b.x = '5' AND b.row_idx > c.before AND b.row_idx < c.row_idx
WHERE (c.x = '1' AND coalesce(px, '') <> '4') OR (c.x = '4' AND nx = '1') GROUP BY c.sheet, c.row_idx
""")
def content_splits_under_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.substring("o_orderpriority", 1, 1)
    first = F.when(x == "1", "指标").when(x == "4", "Totals").when(x != "5", "7.5")
    rows = orders_grid(spark, sf_dir, lambda: [first, F.when(x == "1", "年份").when(x.isin("2", "3"), F.format_number("o_totalprice", 2))])
    return ranges.splits_under_header(rows, rows.select("sheet").distinct().withColumn("header_end", F.lit(0)))


# --- headers -------------------------------------------------------------------------------------------------------


def headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sheets where urgent ones are data, high ones headers, medium ones units, low ones titles."""
    x = F.substring("o_orderpriority", 1, 1)
    first = F.when(x == "1", "北京").when(x == "2", F.concat(F.lit("指标"), F.col("o_orderstatus"))).when(x == "3", "单位").when(x == "5", "标题")
    second = F.when(x == "1", F.format_number("o_totalprice", 2)).when(x == "2", "年份").when(x == "5", "标题")
    return orders_grid(spark, sf_dir, lambda: [first, second])


@query(f"""
WITH {KEYED}, d AS (SELECT sheet, min(row_idx) FILTER (WHERE x = '1') AS ds FROM k GROUP BY sheet)
SELECT k.sheet, max(row_idx) AS header_end FROM k JOIN d ON k.sheet = d.sheet WHERE x IN ('2', '5') AND row_idx < ds GROUP BY k.sheet
""")
def header_end_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers.header_end_by_content(headed(spark, sf_dir))


@query(f"""
WITH {KEYED}, h AS (SELECT sheet, min(row_idx) FILTER (WHERE x IN ('1', '2', '3')) AS header_row FROM k GROUP BY sheet)
SELECT h.sheet, header_row, coalesce(max(row_idx) FILTER (WHERE row_idx < header_row AND x IN ('5', '3')), 0) AS title_row FROM h JOIN k ON h.sheet = k.sheet WHERE header_row IS NOT NULL GROUP BY h.sheet, header_row
""")
def paired_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers.paired_header(headed(spark, sf_dir))


HEADER_CELLS = """
c AS (SELECT l_orderkey AS sheet, r AS row_idx, col_idx, CASE WHEN r = 0 THEN l_returnflag WHEN l_suppkey % 3 > 0 THEN l_linestatus || CAST(l_suppkey % 2 AS VARCHAR) END AS value
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_shipdate) - 1 AS INTEGER) AS col_idx FROM lineitem), range(2) t(r)),
n AS (SELECT *, CASE WHEN lag(col_idx) OVER w = col_idx - 1 THEN lag(value) OVER w END AS beside FROM c WINDOW w AS (PARTITION BY sheet, row_idx ORDER BY col_idx)),
m AS (SELECT *, coalesce(value = beside AND max(CASE WHEN value IS NOT NULL AND (beside IS NULL OR beside <> value) THEN 1 END) OVER (PARTITION BY sheet, col_idx ORDER BY row_idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) = 1, FALSE) AS repeats FROM n)"""


def header_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two header rows of an order's lines: return flags, which neighbours share, and status with a digit, or nothing."""
    number = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate")) - 1
    low = F.when(F.col("l_suppkey") % 3 > 0, F.concat("l_linestatus", (F.col("l_suppkey") % 2).cast("string")))
    both = F.explode(F.array(F.struct(F.lit(0).alias("row_idx"), F.col("l_returnflag").alias("value")), F.struct(F.lit(1).alias("row_idx"), low.alias("value")))).alias("v")
    lines = dealt(read(spark, sf_dir, "lineitem"), "l_orderkey", each=100_000).withColumn("col_idx", number)
    return lines.select(F.col("l_orderkey").alias("sheet"), "col_idx", both).select("sheet", "v.row_idx", "col_idx", "v.value")


@query(f"WITH {HEADER_CELLS} SELECT sheet, CAST(row_idx AS INTEGER) AS row_idx, col_idx, value, repeats FROM m")
def repeated_by_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers.repeated_by_merge(header_cells(spark, sf_dir))


@query(f"""
WITH {HEADER_CELLS}, v AS (SELECT *, max(CASE WHEN value IS NOT NULL THEN 1 END) OVER (PARTITION BY sheet, col_idx ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 1 AS begun FROM m)
SELECT sheet, col_idx, coalesce(string_agg(value, '' ORDER BY row_idx) FILTER (WHERE NOT (repeats AND coalesce(begun, FALSE))), 'col_' || col_idx) AS name FROM v GROUP BY sheet, col_idx
""")
def merged_header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers.merged_names(header_cells(spark, sf_dir))


@query(f"""
WITH {GRID}, u AS (SELECT sheet, CASE WHEN priority[1] = '1' THEN '1 234.5' WHEN priority[1] <> '2' THEN priority END AS v FROM grid WHERE row_idx BETWEEN 2 AND 11)
SELECT sheet FROM u GROUP BY sheet HAVING count(v) >= 2 AND count(v) FILTER (WHERE v <> '1 234.5') > 0.5 * count(v)
""")
def first_column_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.substring("o_orderpriority", 1, 1)
    rows = orders_grid(spark, sf_dir, lambda: [F.when(x == "1", "1 234.5").when(x != "2", F.col("o_orderpriority"))])
    return headers.first_column_texts(rows, rows.select("sheet").distinct().withColumn("header_end", F.lit(1)))


@query("""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'price' WHEN 'MACHINERY' THEN 'growth_rate' WHEN 'HOUSEHOLD' THEN 'total' ELSE 'col' END AS part,
  CASE WHEN c_nationkey % 4 = 0 THEN 'ods_' || lower(c_mktsegment) ELSE substring('ods_' || lower(c_mktsegment) || repeat('x', 60), 1, 64 - len('_p' || (c_nationkey + 1))) || '_p' || (c_nationkey + 1) END AS table_name,
  CASE WHEN c_nationkey % 2 = 0 THEN c_name ELSE 'col_0' END AS first_name FROM customer
""")
def header_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment, key = F.col("c_mktsegment"), F.col("c_nationkey")
    part = naming.english_part(F.when(segment == "BUILDING", " 价格 ").when(segment == "MACHINERY", "增长率（）").when(segment == "HOUSEHOLD", "合 计").otherwise("别的"))
    base = F.concat(F.lit("ods_"), F.lower(segment), F.when(key % 4 == 0, "").otherwise("x" * 60))
    given = F.when(key % 2 == 0, F.array("c_name", F.lit("b"))).otherwise(F.array("c_name"))
    names = headers.overridden(F.array(F.lit("col_0"), F.lit("col_1")), given)
    return read(spark, sf_dir, "customer").select("c_custkey", part.alias("part"), headers.subtable_name(base, key, F.when(key % 4 == 0, 1).otherwise(2)).alias("table_name"), F.get(names, F.lit(0)).alias("first_name"))


@query("""
WITH d AS (SELECT DISTINCT l_suppkey AS sheet, l_linenumber AS sub_idx, l_returnflag AS k FROM lineitem)
SELECT sheet, CASE WHEN row_number() OVER (PARTITION BY sheet, k ORDER BY sub_idx) = 1 THEN k ELSE k || '_p' || (sub_idx + 1) END AS key, 'of ' || sub_idx AS description FROM d
""")
def merged_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sheet"), F.col("l_linenumber").alias("sub_idx"), F.col("l_returnflag").alias("key")).distinct()
    return headers.merged_descriptions(rows.withColumn("description", F.concat(F.lit("of "), F.col("sub_idx").cast("string"))))


# --- regions -------------------------------------------------------------------------------------------------------


@query(f"""
WITH {GRID}, w AS (SELECT sheet, CASE WHEN count(*) FILTER (WHERE priority[1] IN ('1', '2')) > 0 THEN 1 ELSE 2 END AS "left", CASE WHEN count(*) FILTER (WHERE priority[1] = '3') > 0 THEN 3 ELSE 2 END AS "right" FROM grid GROUP BY sheet)
SELECT g.sheet, row_idx, CAST("left" AS INTEGER) AS "left", CAST("right" - "left" + 1 AS BIGINT) AS width, CASE WHEN "left" = 1 THEN CASE WHEN priority[1] IN ('1', '2') THEN status END ELSE amount END AS c0 FROM grid g JOIN w ON g.sheet = w.sheet
""")
def region_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.substring("o_orderpriority", 1, 1)
    rows = orders_grid(spark, sf_dir, lambda: [F.lit(None).cast("string"), F.when(x.isin("1", "2"), F.col("o_orderstatus")), F.format_number("o_totalprice", 2), F.when(x == "3", "x"), F.lit(" ")])
    return regions.trim_sides(rows).select("sheet", "row_idx", "left", F.size("cells").cast("long").alias("width"), F.get("cells", F.lit(0)).alias("c0"))


@query("""
WITH s AS (SELECT DISTINCT l_suppkey AS sheet, l_linenumber AS col_idx FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40), w AS (SELECT l_suppkey AS sheet, max(l_linenumber) + 1 AS width FROM lineitem GROUP BY 1),
e AS (SELECT sheet, col_idx FROM s UNION SELECT sheet, 0 FROM w)
SELECT e.sheet, row_number() OVER k - 1 AS sub_idx, col_idx AS start, coalesce(lead(col_idx) OVER k, width) - 1 AS "end" FROM e JOIN w ON e.sheet = w.sheet WHERE col_idx < width WINDOW k AS (PARTITION BY e.sheet ORDER BY col_idx)
""")
def regions_of_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sheet"), F.col("l_linenumber").alias("col_idx"), "l_returnflag", "l_quantity")
    widths = lines.groupBy("sheet").agg((F.max("col_idx") + 1).alias("width"))
    return regions.regions_of_splits(lines.where("l_returnflag = 'R' and l_quantity > 40").select("sheet", "col_idx"), widths)


@query("""
WITH n AS (SELECT l_suppkey AS sheet, l_linenumber AS sub_idx, count(*) AS columns, count(*) FILTER (WHERE l_returnflag = 'R') AS own, CAST(sum(l_quantity) AS BIGINT) % 5 AS n_rows FROM lineitem GROUP BY 1, 2),
k AS (SELECT sheet, sub_idx, n_rows FROM n WHERE n_rows >= 2 AND (columns <= 2 OR own >= 0.3 * columns))
SELECT sheet, count(*) AS n_subtables, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM k GROUP BY sheet
""")
def subtables_worth_keeping(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sheet"), F.col("l_linenumber").alias("sub_idx"), F.when(F.col("l_returnflag") == "R", "name").otherwise("col_3").alias("name"), "l_quantity")
    counts = lines.groupBy("sheet", "sub_idx").agg((F.sum("l_quantity").cast("long") % 5).alias("n_rows"))
    return regions.subtable_totals(counts.join(regions.worth_keeping(lines, counts), ["sheet", "sub_idx"]))


@query(f"WITH {GAPPED}, held AS (SELECT sheet, col_idx FROM cells GROUP BY ALL HAVING count(value) > 0 OR col_idx <> 2) SELECT c.* FROM cells c JOIN held h ON c.sheet = h.sheet AND c.col_idx = h.col_idx")
def without_blank_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = gapped(spark, sf_dir)
    names = cells.select("sheet", "col_idx").distinct().withColumn("name", F.when(F.col("col_idx") == 3, "kept").otherwise(F.concat(F.lit("col_"), F.col("col_idx").cast("string"))))
    return regions.without_blank_columns(cells, names)


@query(f"""
WITH {KEYED}, a AS (SELECT *, CASE WHEN row_idx > 6 THEN 6 ELSE 0 END AS split FROM k WHERE row_idx > 0)
SELECT sheet, split, min(row_idx) FILTER (WHERE x = '1') AS data_start FROM a GROUP BY sheet, split
""")
def begins_of_subtables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = headed(spark, sf_dir)
    return regions.begins_of_subtables(rows, rows.select("sheet").distinct().select("sheet", F.explode(F.array(F.lit(0), F.lit(6))).alias("split")))


# --- decisions and the log -----------------------------------------------------------------------------------------


@query("""
SELECT event_id, CASE event_type WHEN 'view' THEN 'standard' WHEN 'click' THEN 'horizontal_split' ELSE 'UNKNOWN' END AS strategy,
  CASE WHEN event_type IN ('view', 'click') THEN least(greatest(value / 100, 0), 1) ELSE 0 END AS confidence, CASE WHEN event_type = 'view' THEN json_extract_string(props, '$.k') END AS k,
  CASE event_type WHEN 'error' THEN '' ELSE 'h' || user_id END AS table_name_hint, CAST(CASE event_type WHEN 'click' THEN 1 END AS INTEGER) AS n_regions,
  CASE event_type WHEN 'error' THEN 'not an object' WHEN 'signup' THEN 'illegal strategy: magic' ELSE '' END AS error FROM events
""")
def decision_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    strategy = F.when(kind == "view", "standard").when(kind == "click", "horizontal_split").when(kind == "signup", "magic").otherwise("UNKNOWN")
    params = F.when(kind == "view", F.col("props")).otherwise("[1]")
    listed = F.when(kind == "click", '[{"col_start": 1}]').otherwise("[3]")
    confidence = F.when(kind == "purchase", '"high"').otherwise((F.col("value") / 100).cast("string"))
    raw = F.concat(F.lit('{"strategy": "'), strategy, F.lit('", "params": '), params, F.lit(', "regions": '), listed, F.lit(', "confidence": '), confidence, F.lit(', "table_name_hint": "h'), F.col("user_id").cast("string"), F.lit('"}'))
    made = read(spark, sf_dir, "events").select("event_id", decision.from_raw(F.when(kind == "error", "[]").otherwise(raw)).alias("d"))
    return made.select("event_id", "d.strategy", "d.confidence", F.try_element_at("d.params", F.lit("k")).alias("k"), "d.table_name_hint", F.when(F.col("d.regions").isNotNull(), F.size("d.regions")).alias("n_regions"), "d.error")


@query("""
WITH f AS (SELECT o_orderkey AS sheet, CASE CAST(o_orderpriority[1] AS INTEGER) % 3 WHEN 0 THEN 'simple_header' WHEN 1 THEN 'vertical_subtable' ELSE 'standard' END AS strategy,
  CAST(o_orderkey % 4 AS INTEGER) AS data_start, CASE WHEN o_orderstatus = 'F' THEN 3 END AS split_col, o_custkey % 2 AS n_splits FROM orders)
SELECT sheet, CASE WHEN strategy = 'simple_header' AND data_start >= 2 THEN 'multi_header' WHEN strategy = 'vertical_subtable' AND split_col IS NOT NULL THEN 'horizontal_split'
  WHEN strategy = 'vertical_subtable' AND n_splits = 0 THEN 'multi_header' ELSE strategy END AS strategy,
  CASE WHEN (strategy = 'simple_header' AND data_start >= 2) OR (strategy = 'vertical_subtable' AND (split_col IS NOT NULL OR n_splits = 0)) THEN strategy END AS fallback_from FROM f
""")
def fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.substring("o_orderpriority", 1, 1).cast("int") % 3
    strategy = F.when(kind == 0, "simple_header").when(kind == 1, "vertical_subtable").otherwise("standard")
    facts = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sheet"), strategy.alias("strategy"), (F.col("o_orderkey") % 4).cast("int").alias("data_start"), F.when(F.col("o_orderstatus") == "F", 3).alias("split_col"), (F.col("o_custkey") % 2).alias("n_splits"))
    return decision.with_fallback(facts)


@query("""
WITH r AS (SELECT 'in/' || l_suppkey || CASE WHEN l_suppkey % 2 = 0 THEN '.XLS' ELSE '.xlsx' END AS source_path, CAST(l_linenumber AS VARCHAR) AS sheet_name, max(l_orderkey) AS o FROM lineitem GROUP BY ALL)
SELECT source_path, regexp_extract(source_path, '[^/]*$') AS source_filename, sheet_name, 0 AS subtable_index, CASE WHEN o % 3 = 0 THEN 'SUCCESS' ELSE 'ERROR' END AS status, CASE WHEN o % 3 = 0 THEN 'standard' ELSE 'UNKNOWN' END AS parse_strategy,
  lower(source_path) LIKE '%.xls' AS is_xls, CASE WHEN o % 3 = 0 THEN CAST(o % 5 AS INTEGER) END AS merged_cells_count, CASE WHEN o % 3 = 0 THEN o % 5 > 0 ELSE FALSE END AS has_merged_cells FROM r
""")
def ingest_log_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old log without all columns, all errors, and a run that succeeds for a third of its sheets."""
    suffix = F.when(F.col("l_suppkey") % 2 == 0, ".XLS").otherwise(".xlsx")
    sheets = read(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("in/"), F.col("l_suppkey").cast("string"), suffix).alias("source_path"), F.col("l_linenumber").cast("string").alias("sheet_name")).agg(F.max("l_orderkey").alias("o"))
    old = sheets.select("source_path", "sheet_name", F.lit("ERROR").alias("status"))
    new = sheets.where("o % 3 = 0").select("source_path", "sheet_name", F.lit("SUCCESS").alias("status"), F.lit("standard").alias("parse_strategy"), (F.col("o") % 5).alias("merged_cells_count"))
    log = ingest_log.merged_log(old, new)
    return log.select("source_path", "source_filename", "sheet_name", "subtable_index", "status", "parse_strategy", "is_xls", "merged_cells_count", "has_merged_cells")
