"""Queries over whole tables of sheets, as the strategies read them, each with its SQL.

Sheets are made of customers' orders: their kinds of row (titles, headers, blank rows, categories, continuations) and their
borders follow from the orders' columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.operators import borders, headers, subtables
from gridloom.plans import strategies, table_function
from gridloom.queries import _sanitise, query, read
from gridloom.session import dealt


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sheet, status, key, priority, amount) with n, the order's number in its sheet from 0."""
    number = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    return dealt(read(spark, sf_dir, "orders"), "o_custkey").select(F.col("o_custkey").alias("sheet"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("priority"), F.format_number("o_totalprice", 2).alias("amount"), number.alias("n"))


ORDERS = """
o AS (SELECT o_custkey AS sheet, o_orderstatus AS status, o_orderkey AS key, o_orderpriority AS priority, format('{:,.2f}', o_totalprice) AS amount,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n FROM orders)"""


def row(*cells: Column | str | None, bound: Column | bool = False) -> Column:
    """A row of a sheet, and whether a solid edge ends it."""
    values = [F.lit(c).cast("string") if c is None or isinstance(c, str) else c.cast("string") for c in cells]
    return F.struct(F.array(*values).alias("cells"), F.lit(bound).alias("bound"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """(sheet, row_idx, cells, and the edges) of (sheet, rows): the rows of all, in order."""
    each = rows.select("sheet", *order, F.posexplode("rows").alias("at", "r"))
    index = (F.row_number().over(W.partitionBy("sheet").orderBy(*order, "at")) - 1).cast("int")
    edge = F.when(F.col("r.bound"), 0.9).otherwise(0.0)
    return each.select("sheet", index.alias("row_idx"), "r.cells", edge.alias("bottom_ratio"), F.lit(0.0).alias("top_ratio"), F.col("r.bound").alias("is_solid"), F.lit(False).alias("is_dash"))


def shown(relation: DataFrame, width: int) -> DataFrame:
    cells = (F.get(c, F.lit(i)).alias(f"{c[0]}{i}") for c in ("names", "cells") for i in range(width))
    return relation.select("sheet", "sub_idx", "label", "row_no", *cells)


# --- stacked tables ------------------------------------------------------------------------------------------------


@query("""
WITH RECURSIVE s AS (SELECT l_orderkey AS sheet, list_sort(list_distinct(list(l_partkey % 25))) AS x FROM lineitem GROUP BY 1),
k AS (SELECT sheet, x, x[1] AS kept FROM s UNION ALL SELECT sheet, x, list_filter(x, lambda y: y >= kept + 3)[1] FROM k WHERE len(list_filter(x, lambda y: y >= kept + 3)) > 0)
SELECT sheet, CAST(kept AS INTEGER) AS split FROM k
""")
def spaced_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of splits that lie close together."""
    found = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("sheet")).agg(F.sort_array(F.collect_set((F.col("l_partkey") % 25).cast("int"))).alias("splits"))
    return found.select("sheet", F.explode(subtables.spaced(F.col("splits"))).alias("split"))


@query(f"""
WITH {ORDERS}, g AS (SELECT *, dense_rank() OVER (PARTITION BY sheet ORDER BY status) - 1 AS sub_idx, row_number() OVER (PARTITION BY sheet, status ORDER BY key) AS row_no FROM o),
h AS (SELECT *, max(sub_idx) OVER (PARTITION BY sheet) = 0 AS one, NOT (status = 'P' AND sheet % 2 = 0 AND sub_idx > 0) AS own FROM g)
SELECT sheet, sub_idx::INTEGER AS sub_idx, CASE WHEN one THEN 'p1' WHEN own THEN status || '类统计' ELSE 'p' || (sub_idx + 1) END AS label, row_no,
  CASE WHEN one THEN status || '类统计指标' ELSE '指标' END AS n0, (2000 + sheet % 50 + CASE WHEN own THEN sub_idx ELSE sub_idx - 1 END) || '年' AS n1, status || '-' || key AS c0, replace(amount, ',', '') AS c1 FROM h
""")
def vertical_subtables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders by status, each a table with a title and a header, or, after a border only, with the header of the last."""
    made = orders(spark, sf_dir).withColumn("sub_idx", F.dense_rank().over(W.partitionBy("sheet").orderBy("status")) - 1)
    w = W.partitionBy("sheet", "status").orderBy("key")
    first, last = F.row_number().over(w) == 1, F.lead("key").over(w).isNull()
    own = ~((F.col("status") == "P") & (F.col("sheet") % 2 == 0) & (F.col("sub_idx") > 0))
    year = F.concat((F.lit(2000) + F.col("sheet") % 50 + F.col("sub_idx")).cast("string"), F.lit("年"))
    gap = F.when(F.col("first") & (F.col("sub_idx") > 0), F.array(row(None, None), row(None, None))).otherwise(F.array().cast("array<struct<cells: array<string>, bound: boolean>>"))
    head = F.array(row(F.concat("status", F.lit("类统计")), None), row("指标", year))
    data = F.array(row(F.concat_ws("-", "status", F.col("key").cast("string")), F.col("amount"), bound=F.col("last")))
    rows = made.withColumn("first", first).withColumn("last", last)
    rows = rows.withColumn("rows", F.concat(gap, F.when(F.col("first") & own, head).otherwise(F.slice(head, 1, 0)), data))
    return shown(strategies.vertical_subtable(numbered(rows, ["status", "key"])), 2)


@query(f"""
WITH {ORDERS}, s AS (SELECT sheet, count(*) AS m FROM o GROUP BY sheet),
e AS (SELECT sheet, m, CASE WHEN sheet % 4 = 0 THEN 4 WHEN sheet % 4 = 2 AND m >= 2 THEN 6 WHEN sheet % 4 = 2 THEN 4 ELSE 5 END AS he FROM s)
SELECT sheet, 0 AS sub_idx, 'p1' AS label, 0 AS header_start, 0 AS header_end, 1 AS data_start, 3 AS data_end FROM e
UNION ALL SELECT sheet, 1, 'p2', 4, he, he + 1, (6 + m + CASE WHEN sheet % 4 = 2 THEN 1 ELSE 0 END)::INTEGER FROM e
""")
def subtable_header_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second tables whose header ends where borders and texts disagree, each way round: a border above the last header-like row, one below it on
    a header-like row beyond data, one on data, and none."""
    made = orders(spark, sf_dir)
    kind = F.col("sheet") % 4
    top = [row("指标", "年份"), row("a", "1.5"), row("b", "2.5"), row(None, None), row("项目", "年份", bound=kind == 0)]
    end = F.when(kind == 2, F.array(row("x", "12.5"), row("单位", "名称", bound=True))).otherwise(F.array(row("单位", "名称")))
    data = F.array(row(F.col("status"), F.col("amount"), bound=(kind == 3) & (F.col("n") == 0)))
    rows = made.withColumn("rows", F.when(F.col("n") == 0, F.concat(F.array(*top), end, data)).otherwise(data))
    return subtables.vertical_regions(numbered(rows, ["n"])).select("sheet", "sub_idx", "label", "header_start", "header_end", "data_start", "data_end")


# --- headers of several rows ---------------------------------------------------------------------------------------


@query(f"""
WITH {ORDERS}, l AS (SELECT *, lag(status) OVER (PARTITION BY sheet ORDER BY n) AS before FROM o), r AS (
  SELECT sheet, n, 1 AS later, status || '类' AS c0, replace(amount, ',', '') AS c1, n::VARCHAR || '.5' AS c2 FROM l
  UNION ALL SELECT sheet, n, 0, status || '类', NULL, NULL FROM l WHERE n > 0 AND before <> status)
SELECT sheet, 0 AS sub_idx, 'p1' AS label, row_number() OVER (PARTITION BY sheet ORDER BY n, later) AS row_no, CASE WHEN sheet % 2 = 0 THEN '指标' ELSE '指标单位' END AS n0,
  CASE WHEN sheet % 2 = 0 THEN '1990万人' ELSE '1990总量' END AS n1, CASE WHEN sheet % 2 = 0 THEN '2000万人' ELSE '2000增速' END AS n2, c0, c1, c2 FROM r
""")
def two_row_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under a header of two rows, the second one of units or of words; categories over the rows of a status."""
    made = orders(spark, sf_dir)
    before = F.lag("status").over(W.partitionBy("sheet").orderBy("n"))
    label = F.concat("status", F.lit("类"))
    even = F.col("sheet") % 2 == 0
    head = F.array(row("指标", "1990", "2000"), row(F.when(~even, "单位"), F.when(even, "万人").otherwise("总量"), F.when(even, "万人").otherwise("增速")))
    made = made.withColumn("turn", F.coalesce(before != F.col("status"), F.lit(False)))
    data = F.array(row(F.when(F.col("n") == 0, label), F.col("amount"), F.concat(F.col("n").cast("string"), F.lit(".5"))))
    rows = made.withColumn("rows", F.when(F.col("n") == 0, F.concat(head, data)).when(F.col("turn"), F.concat(F.array(row(label, None, None)), data)).otherwise(data))
    return shown(strategies.multi_header(numbered(rows, ["n"]).select("sheet", "row_idx", "cells")), 3)


def _from_left(left: str, own: str) -> str:
    common = f"list_max(list_filter(range(1, least(length({left}), length({own})) + 1), lambda k: {left}[:k] = {own}[:k]))"
    held = f"list_max(list_filter(range(1, least(length({left}), length({own})) + 1), lambda k: contains({own}, {left}[:k])))"
    return f"coalesce({left}[:{common}], nullif(regexp_extract({left}, '^(\\d{{4}}年?)', 1), ''), {left}[:{held}])"


@query(rf"""
WITH p AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN (1950 + p_size) || '年' || p_brand WHEN 1 THEN p_type WHEN 2 THEN split_part(p_name, ' ', 1) ELSE 'col 1' END AS l,
  CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN p_name WHEN 2 THEN '为' || p_brand ELSE (1950 + p_size % 8) || '年人口' END AS own FROM part),
s AS (SELECT *, {_sanitise('l')} AS n0 FROM p), x AS (SELECT *, {_from_left('n0', 'own')} AS prefix FROM s), y AS (SELECT *, prefix || own AS made FROM x)
SELECT p_partkey, n0, CASE WHEN prefix IS NOT NULL AND NOT starts_with(n0, 'col_') AND prefix <> n0 AND NOT starts_with({_sanitise('made')}, 'col_') THEN {_sanitise('made')} ELSE {_sanitise('own')} END AS n1 FROM y
""")
def names_from_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header blocks with a gap over the second column, named by what it has in common with the name on its left."""
    size, key = F.col("p_size"), F.col("p_partkey")
    left = F.when(size % 4 == 0, F.concat((size + 1950).cast("string"), F.lit("年"), "p_brand")).when(size % 4 == 1, F.col("p_type")).when(size % 4 == 2, F.substring_index("p_name", " ", 1)).otherwise("col 1")
    own = F.when(key % 4 == 0, F.col("p_type")).when(key % 4 == 1, F.col("p_name")).when(key % 4 == 2, F.concat(F.lit("为"), "p_brand")).otherwise(F.concat((size % 8 + 1950).cast("string"), F.lit("年人口")))
    none = F.lit(None).cast("string")
    made = read(spark, sf_dir, "part").select("p_partkey", headers.block_names(F.array(F.array(left, none), F.array(none, own)), F.lit(False), gaps=True).alias("names"))
    return made.select("p_partkey", F.get("names", F.lit(0)).alias("n0"), F.get("names", F.lit(1)).alias("n1"))


# --- side by side, and records of several rows ---------------------------------------------------------------------


@query(f"""
WITH {ORDERS}, c AS (SELECT *, count(*) OVER (PARTITION BY sheet) AS m FROM o)
SELECT sheet, 0 AS sub_idx, CASE WHEN sheet % 3 = 0 OR sheet % 6 = 5 THEN 'left' ELSE 'p1' END AS label, n + 1 AS row_no, '指标A' AS n0, 'y_1990' AS n1, status || key AS c0, replace(amount, ',', '') AS c1 FROM c WHERE sheet % 3 > 0 OR m > 1
UNION ALL SELECT sheet, 1, CASE WHEN sheet % 3 = 0 OR sheet % 6 = 5 THEN 'right' ELSE 'p2' END, n + 1, '指标B', '类别', priority, n || '.25' FROM c WHERE sheet % 3 > 0 OR m > 1
""")
def side_by_side_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables beside each other: parted by two blank columns, by a border with or without hints, or by hints with their headers."""
    made = orders(spark, sf_dir)
    third = F.col("sheet") % 3
    gap = F.when(third == 1, F.array(F.lit(None).cast("string"), F.lit(None).cast("string"))).otherwise(F.array(F.lit(None).cast("string")))

    def beside(left: list[Column], right: list[Column]) -> Column:
        return F.struct(F.concat(F.array(*left), gap, F.array(*right)).alias("cells"), F.lit(False).alias("bound"))

    data = F.array(beside([F.concat("status", F.col("key").cast("string")), F.col("amount")], [F.col("priority"), F.concat(F.col("n").cast("string"), F.lit(".25"))]))
    head = F.array(beside([F.lit("指标A"), F.lit("1990")], [F.lit("指标B"), F.lit("类别")]))
    rows = numbered(made.withColumn("rows", F.when(F.col("n") == 0, F.concat(head, data)).otherwise(data)), ["n"]).select("sheet", "row_idx", "cells")
    sheets = made.select("sheet").distinct()
    cols = sheets.where(third == 2).select("sheet", F.lit(2).alias("col_idx"))
    region = lambda k, name, a, b: F.struct(F.lit(k).alias("sub_idx"), F.lit(name).alias("label"), F.lit(a).alias("col_start"), F.lit(b).alias("col_end"))
    given = sheets.where((third == 0) | (F.col("sheet") % 6 == 5)).select("sheet", F.explode(F.array(region(0, "left", 0, 1), region(1, "right", 3, 4))).alias("r")).select("sheet", "r.*")
    told = F.when(third == 0, 0)
    hints = given.select("*", told.alias("header_start"), told.alias("header_end"), (told + 1).alias("data_start"), F.lit(None).cast("int").alias("data_end"))
    return shown(strategies.horizontal_split(rows, strategies.Extras(split_cols=cols, hints=hints)), 2)


@query(f"""
WITH {ORDERS}
SELECT sheet, 0 AS sub_idx, 'p1' AS label, n + 1 AS row_no, '序号' AS n0, '名称' AS n1, '金额' AS n2, '日期' AS n3, '序号_续' AS n4, '名称_续' AS n5, key::VARCHAR AS c0, priority AS c1, amount AS c2, 'd' || n AS c3,
  CASE WHEN sheet % 2 = 0 THEN key::VARCHAR ELSE key || ' ' || key END AS c4, CASE WHEN sheet % 2 = 0 THEN status || '1' ELSE status || '1 ' || status || '2' END AS c5 FROM o
""")
def paired_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records of two rows or three, under a merged title and a header: what is under the key and the priority becomes columns of its own."""
    made = orders(spark, sf_dir)
    more = [row(None, F.concat("status", F.lit(str(k))), None, None) for k in (1, 2)]
    record = F.concat(F.array(row(F.col("key"), F.col("priority"), F.col("amount"), F.concat(F.lit("d"), F.col("n").cast("string")))), F.when(F.col("sheet") % 2 == 0, F.array(more[0])).otherwise(F.array(*more)))
    head = F.array(row(*["对照表"] * 4), row("序号", "名称", "金额", "日期"))
    first = F.when(F.col("sheet") % 3 == 0, head).otherwise(F.slice(head, 2, 1))
    rows = made.withColumn("rows", F.when(F.col("n") == 0, F.concat(first, record)).otherwise(record))
    return shown(strategies.paired_row_bilingual(numbered(rows, ["n"]).select("sheet", "row_idx", "cells")), 6)


@query("""
WITH c AS (SELECT l_orderkey AS sheet, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_shipdate) - 1 AS INTEGER) AS col_idx,
  CASE l_suppkey % 3 WHEN 0 THEN 0.1 WHEN 1 THEN 0.4 ELSE 0.9 END AS ratio, l_returnflag = 'R' AND l_linestatus = 'F' AS is_dash FROM lineitem),
k AS (SELECT *, count(*) OVER (PARTITION BY sheet) AS n FROM c), r AS (SELECT *, col_idx - row_number() OVER (PARTITION BY sheet ORDER BY col_idx) AS island FROM k WHERE ratio < 0.3 AND n >= 4),
i AS (SELECT sheet, min(col_idx) AS a, max(col_idx) AS b FROM r GROUP BY sheet, island)
SELECT sheet, a AS col_idx FROM i JOIN c p USING (sheet) LEFT JOIN c q ON q.sheet = i.sheet AND q.col_idx = b + 1 WHERE p.col_idx = a - 1 AND p.ratio > 0.5 AND (q.sheet IS NULL OR q.ratio > 0.5)
UNION SELECT sheet, col_idx FROM c WHERE is_dash AND ratio >= 0.3
""")
def enclosed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of thin edges: between full ones, beside half ones, at the end."""
    number = (F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate")) - 1).cast("int")
    ratio = F.when(F.col("l_suppkey") % 3 == 0, 0.1).when(F.col("l_suppkey") % 3 == 1, 0.4).otherwise(0.9)
    lines = dealt(read(spark, sf_dir, "lineitem"), "l_orderkey", each=100_000).select(F.col("l_orderkey").alias("sheet"), number.alias("col_idx"), ratio.alias("ratio"), ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("is_dash"))
    return borders.split_columns(lines)


@query(f"""
WITH {ORDERS} SELECT sheet, n + 1 AS row_no, CASE WHEN sheet % 4 < 3 THEN priority END AS "优先级", amount AS "金额", CAST(NULL AS VARCHAR) AS nowhere FROM o
""")
def sheet_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table function over sheets whose columns stand in four orders, one of them without a priority."""
    kind = F.col("sheet") % 4
    pick = lambda a, b, c: F.when(kind == 0, F.array(a, b, c)).when(kind == 1, F.array(c, a, b)).when(kind == 2, F.array(b, a)).otherwise(F.array(c, b))
    cells = F.struct(pick(F.col("priority"), F.col("amount"), F.col("status")).alias("cells"), F.lit(False).alias("bound"))
    head = F.struct(pick(F.lit("优先级"), F.lit(" 金额"), F.lit("状态")).alias("cells"), F.lit(False).alias("bound"))
    rows = orders(spark, sf_dir).withColumn("rows", F.when(F.col("n") == 0, F.array(row(None, " "), head, cells)).otherwise(F.array(cells)))
    numbered(rows, ["n"]).select("sheet", "row_idx", "cells").createOrReplaceTempView("gridloom_sheets")
    table_function.register(spark)
    return spark.sql("SELECT * FROM sheet_table(TABLE(gridloom_sheets) PARTITION BY sheet ORDER BY (row_idx), array('优先级', '金额', 'nowhere'))")
