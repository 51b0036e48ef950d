"""Workbooks in a folder to relations: one scan, a profile and a decision a sheet, one job a strategy, tables and a log."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.functions import text as t
from gridloom.operators import borders, grid, headers, ingest_log, naming, pairs, ranges
from gridloom.operators import predicates as p
from gridloom.plans import decision, strategies
from gridloom.session import cut
from gridloom.sinks import tables
from gridloom.sources import files, xlsx

#: The widest sheet that is read; wider ones are logged as SKIP.
WIDEST = tables.MOST_COLUMNS
#: What an advisor must be sure of a decision.
SURE = 0.8


def read(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells, merges, refused) of all workbooks of a folder.

    refused has (sheet, status, width) for what is not read on: ERROR and the path for a workbook with any error, SKIP for a
    sheet without content, or whose content or merged ranges go beyond WIDEST columns.  The others have no row or cell of these.
    """
    found = files.scan(spark, folder, extensions=(".xlsx",))
    held = cut(xlsx.contents(found).withColumn("sheet", xlsx.sheet_key()))  # each workbook is opened once
    cells = held.where("kind = 'cell'").drop("kind", "r1", "c1")
    merged = held.where("kind = 'merge'").select("sheet", "path", F.col("row_idx").alias("r0"), F.col("col_idx").alias("c0"), "r1", "c1")
    broken = held.where("kind = 'error'").select("path").distinct()
    cells, merged = (x.join(broken, "path", "left_anti") for x in (cells, merged))
    reach = cells.where(~t.blank(F.col("value"))).select("sheet", "col_idx").unionByName(merged.select("sheet", F.col("c1").alias("col_idx")))
    wide = reach.groupBy("sheet").agg((F.max("col_idx") + 1).cast("int").alias("width")).where(F.col("width") > WIDEST)
    errors = broken.select(F.col("path").alias("sheet"), F.lit("ERROR").alias("status"), F.lit(None).cast("int").alias("width"))
    every = held.where("kind = 'sheet'").join(broken, "path", "left_anti").select("sheet")
    empty = every.join(reach, "sheet", "left_anti").select("sheet", F.lit("SKIP").alias("status"), F.lit(0).alias("width"))
    refused = cut(errors.unionByName(wide.select("sheet", F.lit("SKIP").alias("status"), "width")).unionByName(empty))
    cells, merged = (x.join(refused.select("sheet"), "sheet", "left_anti") for x in (cells, merged))
    return cut(cells), cut(merged), refused


def sheets(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, cells, merges) of a folder's workbooks, without those that are refused: merged ranges filled, cells long with their edges."""
    cells, merged, _ = read(spark, folder)
    return densified(cells, merged), cells, merged


def densified(cells: DataFrame, merged: DataFrame) -> DataFrame:
    """(sheet, row_idx, cells) of the cells, merged ranges filled as far as the sheet's content goes, or their own first cell."""
    used = cells.where(~t.blank(F.col("value"))).groupBy("sheet").agg(F.max("row_idx").alias("last_row"), F.max("col_idx").alias("last_col"))
    r1, c1 = (F.least(end, F.greatest(F.coalesce(last, first), first)).alias(end) for end, last, first in (("r1", "last_row", "r0"), ("c1", "last_col", "c0")))
    merged = merged.join(used, "sheet", "left").select("sheet", "r0", "c0", r1, c1)
    strips = merged.select("sheet", F.explode(F.sequence("r0", "r1")).alias("row_idx"), "c0", "c1")
    covered = strips.select("sheet", "row_idx", F.explode(F.sequence("c0", "c1")).alias("col_idx")).withColumn("value", F.lit(None).cast("string"))
    own = cells.where(F.col("col_idx") < WIDEST).select("sheet", "row_idx", "col_idx", "value")  # beyond lie edges of empty cells only
    missing = covered.join(own, ["sheet", "row_idx", "col_idx"], "left_anti")
    filled = grid.fill_merged(own.unionByName(missing), merged.select("sheet", "r0", "c0", "r1", "c1"))
    span = filled.groupBy("sheet").agg(F.max("row_idx").alias("last"), F.max("col_idx").alias("right"))
    at = filled.groupBy("sheet", "row_idx").agg(F.map_from_entries(F.collect_list(F.struct("col_idx", "value"))).alias("m"))
    every = span.select("sheet", "right", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("row_idx"))
    value = F.transform(F.sequence(F.lit(0), F.col("right")), lambda i: F.try_element_at("m", i))
    return cut(every.join(at, ["sheet", "row_idx"], "left").select("sheet", "row_idx", value.alias("cells")))


def with_edges(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows with the edge columns of borders.row_edges."""
    none = {"bottom_ratio": F.lit(0.0), "top_ratio": F.lit(0.0), "is_solid": F.lit(False), "is_dash": F.lit(False), "border": F.lit(False)}
    joined = rows.join(borders.row_edges(cells), ["sheet", "row_idx"], "left")
    return joined.withColumns({c: F.coalesce(F.col(c), v) for c, v in none.items()})


def profile(rows: DataFrame, cells: DataFrame, merged: DataFrame) -> DataFrame:
    """One row a sheet: what the classifier looks at."""
    content = F.col("cells")
    base = rows.groupBy("sheet").agg(F.sum(p.n_filled(content)).alias("n_filled"), F.count_if(p.is_title(content)).alias("n_titles"), F.max(F.size(content)).alias("width"), F.count(F.lit(1)).cast("int").alias("n_rows"))
    edges = borders.edge_stats(cells, "row_idx", "b_bottom").withColumn("boundary", borders.is_boundary(F.col("ratio"), F.col("is_solid"), F.col("is_dash")))
    by_border = borders.pre_classify(edges, borders.edge_stats(cells, "col_idx", "b_right")).select("sheet", F.col("strategy").alias("border_strategy"))
    span = pairs.record_span_scores(rows.where(F.col("row_idx") > 0).withColumn("row_idx", F.col("row_idx") - 1)).groupBy("sheet").agg(F.max("score").alias("span_score"))
    splits = ranges.vertical_splits(rows).groupBy("sheet").agg(F.count(F.lit(1)).alias("n_splits"))
    across = ranges.split_column(ranges.blank_columns(grid.to_cells(rows)))
    joined = cut(base)
    for other in map(cut, (by_border, span, splits, across)):  # one row a sheet
        joined = joined.join(other, "sheet", "left")
    for other in (ranges.data_start(grid.trim_blank_rows(rows)), merged.groupBy("sheet").agg(F.count(F.lit(1)).alias("n_merges"))):
        joined = joined.join(other, "sheet", "left")
    return joined.fillna({"n_splits": 0, "n_merges": 0, "span_score": 0.0, "data_start": -1})


def hints_of(decided: DataFrame) -> DataFrame:
    """(sheet, sub_idx, label, col_start, …, data_end) of (sheet, d): the regions of decisions, as strategies.Extras takes them."""
    each = decided.select("sheet", F.posexplode("d.regions").alias("sub_idx", "r"))
    number = lambda k: F.try_element_at("r", F.lit(k)).try_cast("int").alias(k)
    return each.select("sheet", "sub_idx", F.try_element_at("r", F.lit("label")).alias("label"), *map(number, ("col_start", "col_end", "header_start", "header_end", "data_start", "data_end")))


def ingest(spark: SparkSession, folder: str, log: DataFrame | None = None, advice: DataFrame | None = None) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """(log rows, relations by strategy, header names) of the folder's sheets that the log does not hold as done.

    A workbook that can't be read whole is one row ERROR of its path in the log, and none of its cells is loaded.  advice is
    (sheet, raw) with an advisor's decisions as JSON text: a legal one that is sure (0.8) goes before the rules, and its regions are hints.
    """
    cells, merged, refused = read(spark, folder)
    rows = densified(cells, merged)
    if log is not None:
        todo = ingest_log.unprocessed(rows.select("sheet").distinct(), log, ["sheet"])
        rows, cells, merged = (x.join(todo, "sheet", "left_semi") for x in (rows, cells, merged))
        refused = refused.join(log.where(F.col("status") == "SKIP"), "sheet", "left_anti") if "sheet" in log.columns else refused
    facts = cut(profile(rows, cells, merged))
    by_rule = decision.with_fallback(decision.classify(facts).join(facts, "sheet"))
    extras = strategies.Extras(split_cols=cut(borders.split_columns(borders.edge_stats(cells, "col_idx", "b_right")).where(F.col("col_idx") > 0)))
    agent, given = F.lit("rules"), F.lit(None).cast("string")
    if advice is not None:
        sure = cut(advice.select("sheet", decision.from_raw(F.col("raw")).alias("d")).where((F.col("d.error") == "") & (F.col("d.strategy") != "UNKNOWN") & (F.col("d.confidence") >= SURE)))
        extras.hints = hints_of(sure)
        by_rule = by_rule.join(sure.select("sheet", F.col("d.strategy").alias("advised"), F.nullif("d.table_name_hint", F.lit("")).alias("hint")), "sheet", "left")
        agent, given = F.when(F.col("advised").isNotNull(), "advisor").otherwise("rules"), F.col("hint")
        by_rule = by_rule.withColumn("strategy", F.coalesce("advised", "strategy"))
    decided = by_rule.select("sheet", "strategy", agent.alias("agent"), given.alias("table_name_hint")).join(facts.select("sheet", "width", "n_filled", "n_rows", "n_merges"), "sheet")
    status = F.when(F.col("strategy") == "SKIP", "SKIP").otherwise(ingest_log.guarded(F.col("width"), F.col("n_filled"), WIDEST))
    logged = decided.select("sheet", "strategy", status.alias("status"), F.col("width").alias("column_count"), "agent", "table_name_hint", F.col("n_rows").alias("original_row_count"), F.col("n_merges").cast("int").alias("merged_cells_count"))
    reason = F.when(F.col("status") == "ERROR", "the workbook can't be read").when(F.col("width") > WIDEST, F.concat(F.col("width").cast("string"), F.lit(f" columns; at most {WIDEST} are read"))).otherwise("nothing in it")
    refused = refused.select("sheet", F.when(F.col("status") == "SKIP", "SKIP").otherwise("UNKNOWN").alias("strategy"), "status", F.col("width").alias("column_count"), reason.alias("error_message"))
    logged = cut(logged.unionByName(refused, allowMissingColumns=True))
    good = logged.where(F.col("status") == "SUCCESS").select("sheet", "strategy")
    return logged, strategies.run_all(cut(with_edges(rows, cells)), good, extras), strategies.header_names(rows)


def load(spark: SparkSession, folder: str, out: str, advice: DataFrame | None = None, database: str = "default") -> DataFrame:
    """Ingests a folder into tables of the catalogue, and gives the log of all runs.

    Each sub-table is a table of ``database``, with the source's names as comments on its columns; its rows in long form,
    (sheet, sub_idx, label, names, row_no, cells), stay under ``out/relations``, parted by run, strategy and table, and
    header names under ``out/names``.  ``out/log`` holds the log.  Tables are written before the log, so that a run that
    fails is tried again; sheets that the log holds as done are left out.  The last run's log counts.
    """
    log, number = _last_log(spark, out)
    done = None if log is None else log.select(F.concat_ws("#", "source_path", F.col("sheet_index").cast("string")).alias("sheet"), "status")
    began = time.monotonic()
    logged, relations, names = ingest(spark, folder, done, advice)
    found = files.scan(spark, folder, extensions=(".xlsx",))
    held = xlsx.sheets(found).where(F.col("error").isNull()).select(xlsx.sheet_key().alias("sheet"), "sheet_name")
    sizes = found.select(F.col("path").alias("source_path"), F.col("length").cast("long").alias("file_size_bytes"))
    path, index = F.substring_index("sheet", "#", 1), F.when(F.col("sheet").contains("#"), F.substring_index("sheet", "#", -1).cast("int"))
    known = cut(logged.join(held, "sheet", "left").withColumn("source_path", path).withColumn("sheet_index", index))
    loaded = []
    for strategy, relation in relations.items():
        relation = cut(relation)
        named = cut(_named_tables(relation, known, log, number))
        where = f"{out}/relations/run={number}/strategy={strategy}"
        relation.join(named.select("sheet", "sub_idx", "table_name"), ["sheet", "sub_idx"]).write.mode("overwrite").partitionBy("table_name").parquet(where)
        for r in named.toLocalIterator():  # a row a table
            rows = spark.read.schema("sheet string, sub_idx int, label string, names array<string>, row_no bigint, cells array<string>").parquet(f"{where}/table_name={r['table_name']}")
            source = f"来源: {r['source_path']}"
            tables.publish_table(tables.relation(rows, r["english"], r["source_path"], r["sheet_name"] or "", source, r["names"]), r["table_name"], source, database)
        loaded.append(named)
    names.select("sheet", "pos", "name", "unique_name").write.mode("overwrite").parquet(f"{out}/names/run={number}")
    took = int(1000 * (time.monotonic() - began))
    rows = known.select("sheet", "source_path", "sheet_index", F.coalesce("sheet_name", F.lit("")).alias("sheet_name"), F.col("strategy").alias("parse_strategy"), "status", "column_count", "agent", "original_row_count", "merged_cells_count", "error_message")
    if loaded:
        every = loaded[0]
        for other in loaded[1:]:
            every = every.unionByName(other)
        made = every.select("sheet", F.col("sub_idx").alias("subtable_index"), F.col("label").alias("subtable_label"), "table_name", F.col("n").cast("int").alias("actual_row_count"), F.size("names").alias("own_columns"), F.to_json(F.map_from_arrays(headers.distinct_names(F.col("english")), "names")).alias("column_names"), F.concat(F.lit("来源: "), F.col("source_path")).alias("table_description"))
        rows = rows.join(made, "sheet", "left").withColumn("column_count", F.coalesce("own_columns", "column_count")).drop("own_columns")
        empty = (F.col("status") == "SUCCESS") & F.col("table_name").isNull()
        rows = rows.withColumn("error_message", F.when(empty, "no rows").otherwise(F.col("error_message"))).withColumn("status", F.when(empty, "SKIP").otherwise(F.col("status")))
        rows = rows.withColumn("parse_time_ms", F.when(F.col("table_name").isNotNull(), F.lit(took)))
    rows = rows.join(sizes, "source_path", "left")
    ingest_log.merged_log(log, rows.drop("sheet")).write.mode("overwrite").parquet(f"{out}/log/run={number}")
    return spark.read.parquet(f"{out}/log/run={number}")


def _named_tables(relation: DataFrame, known: DataFrame, log: DataFrame | None, number: int) -> DataFrame:
    """(sheet, sub_idx, label, names, english, n, table_name, source_path, sheet_name), a row a table: names in English where they are known, and unique tables."""
    by = relation.groupBy("sheet", "sub_idx", "label", "names").agg(F.count(F.lit(1)).alias("n"))
    by = by.join(known.select("sheet", "source_path", "sheet_name", "sheet_index", "table_name_hint"), "sheet")
    count = F.count(F.lit(1)).over(W.partitionBy("sheet"))
    base = F.coalesce(F.col("table_name_hint"), t.fallback_table(F.col("source_path"), F.col("sheet_name"), F.col("sheet_index")))
    base = F.lower(t.sanitise(base))
    by = by.withColumn("base", headers.subtable_name(base, F.col("sub_idx"), count)).withColumn("english", headers.distinct_names(naming.english_names(F.col("names"))))
    unique = naming.unique_names(by.withColumn("all", F.lit(0)).withColumn("pos", F.struct("source_path", "sheet_index", "sub_idx")), group="all", name="base")
    if log is not None:  # names of earlier runs are taken
        taken = log.where(F.col("table_name").isNotNull()).select(F.col("table_name").alias("unique_name")).distinct().withColumn("taken", F.lit(True))
        unique = unique.join(taken, "unique_name", "left").withColumn("unique_name", F.when(F.col("taken"), F.concat(F.substring("unique_name", 1, 56), F.lit(f"_r{number}"))).otherwise(F.col("unique_name")))
    return unique.select("sheet", "sub_idx", "label", "names", "english", "n", F.col("unique_name").alias("table_name"), "source_path", "sheet_name")


def _last_log(spark: SparkSession, out: str) -> tuple[DataFrame | None, int]:
    """The last run's log, and the number of the next run."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/log")
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    runs = [f.getPath().getName() for f in store.listStatus(root)] if store.exists(root) else []
    complete = [int(n.removeprefix("run=")) for n in runs if n.startswith("run=") and store.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/log/{n}/_SUCCESS"))]
    return (spark.read.parquet(f"{out}/log/run={max(complete)}") if complete else None), max(complete, default=-1) + 1
