"""Decisions on how to read a sheet: validation of raw records, and a deterministic classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The strategies, and the outcomes that are none.
STRATEGIES = ("standard", "simple_header", "multi_header", "horizontal_split", "vertical_subtable", "paired_row_bilingual")
OUTCOMES = (*STRATEGIES, "SKIP", "UNKNOWN")


def validated(strategy: Column, confidence: Column) -> Column:
    """A struct of a legal strategy (else UNKNOWN) and a confidence from 0 to 1 (0 if it is no number)."""
    number = F.coalesce(confidence.cast("string").try_cast("double"), F.lit(0.0))
    legal = F.when(strategy.isin(*OUTCOMES), strategy).otherwise("UNKNOWN")
    return F.struct(legal.alias("strategy"), F.least(F.greatest(number, F.lit(0.0)), F.lit(1.0)).alias("confidence"))


def classify(profile: DataFrame) -> DataFrame:
    """(sheet, strategy) from one row a sheet: n_filled, border_strategy, span_score, split_col, n_splits, data_start, n_titles, n_merges.

    The first rule that holds: nothing there; what borders say; paired rows; side by side; stacked; a plain table; a
    header of several rows; a simple one.
    """
    rule = (
        F.when(F.col("n_filled") == 0, "SKIP")
        .when(F.col("border_strategy").isNotNull(), F.col("border_strategy"))
        .when(F.col("span_score") >= 0.7, "paired_row_bilingual")
        .when(F.col("split_col").isNotNull(), "horizontal_split")
        .when(F.col("n_splits") > 0, "vertical_subtable")
        .when((F.col("data_start") == 1) & (F.col("n_titles") == 0) & (F.col("n_merges") == 0), "standard")
        .when(F.col("data_start") >= 2, "multi_header")
        .otherwise("simple_header")
    )
    return profile.select("sheet", rule.alias("strategy"))


DECISION = "struct<strategy: string, params: map<string, string>, table_name_hint: string, confidence: double, reasoning: string, regions: array<map<string, string>>, error: string>"


def from_raw(raw: Column) -> Column:
    """A whole decision from JSON text, each field of its type or its default.

    Text that is no JSON object, or an illegal strategy, gives UNKNOWN with confidence 0 and says so in ``error``; params
    that are no object are empty; confidence is from 0 to 1, 0 if it is no number; regions that are no list of objects are NULL.
    """
    field = lambda name: F.get_json_object(raw, f"$.{name}")
    is_object = F.coalesce(F.try_parse_json(raw).isNotNull() & F.trim(raw).startswith("{"), F.lit(False))
    strategy = F.coalesce(F.nullif(field("strategy"), F.lit("")), F.lit("UNKNOWN"))
    legal = is_object & strategy.isin(*OUTCOMES)
    number = F.coalesce(field("confidence").try_cast("double"), F.lit(0.0))
    params = F.when(legal & F.trim(field("params")).startswith("{"), F.from_json(field("params"), "map<string,string>"))
    regions = field("regions")
    listed = F.when(F.trim(regions).startswith("["), F.from_json(regions, "array<string>"))
    objects = legal & F.coalesce(~F.exists(listed, lambda r: ~F.coalesce(F.trim(r).startswith("{"), F.lit(False))), F.lit(False))
    error = F.when(~is_object, "not an object").when(~legal, F.concat(F.lit("illegal strategy: "), strategy)).otherwise("")
    return F.struct(
        F.when(legal, strategy).otherwise("UNKNOWN").alias("strategy"),
        F.coalesce(params, F.create_map().cast("map<string,string>")).alias("params"),
        F.when(is_object, F.coalesce(field("table_name_hint"), F.lit(""))).otherwise("").alias("table_name_hint"),
        F.when(legal, F.least(F.greatest(number, F.lit(0.0)), F.lit(1.0))).otherwise(0.0).alias("confidence"),
        F.when(is_object, F.coalesce(field("reasoning"), F.lit(""))).otherwise("").alias("reasoning"),
        F.when(objects, F.transform(listed, lambda r: F.from_json(r, "map<string,string>"))).alias("regions"),
        error.alias("error"),
    )


def with_fallback(decided: DataFrame) -> DataFrame:
    """(sheet, strategy, fallback_from) of (sheet, strategy, data_start, split_col, n_splits): one hop at most.

    A simple header that turns out to have several rows is a multi-row one; stacked tables that stand side by side are
    split across, and without any split they are one table with a multi-row header.
    """
    to = (
        F.when((F.col("strategy") == "simple_header") & (F.col("data_start") >= 2), "multi_header")
        .when((F.col("strategy") == "vertical_subtable") & F.col("split_col").isNotNull(), "horizontal_split")
        .when((F.col("strategy") == "vertical_subtable") & (F.coalesce("n_splits", F.lit(0)) == 0), "multi_header")
    )
    return decided.select("sheet", F.coalesce(to, F.col("strategy")).alias("strategy"), F.when(to.isNotNull(), F.col("strategy")).alias("fallback_from"))
