"""Publishing of relations as tables, whole or not at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import text as t

#: Wider relations are skipped.
MOST_COLUMNS = 100


def column_names(spark_names: Sequence[str]) -> list[str]:
    """Sanitised, unique (in any case), and none called id.  On the driver: one name a column."""
    out: list[str] = []
    for name in spark_names:
        base, k = ("row_id" if name.lower() == "id" else name), 0
        made = base
        while made.lower() in {x.lower() for x in out}:
            k += 1
            made = f"{base[: 63 - len(str(k))]}_{k}"
        out.append(made)
    return out


def comment(text: str, limit: int = 1024) -> str:
    """Cut to so many bytes, at a character's end."""
    return text.encode()[:limit].decode(errors="ignore")


def relation(rows: DataFrame, names: Sequence[str], source_file: str, sheet_name: str, description: str = "", comments: Sequence[str] | None = None) -> DataFrame:
    """Cells as columns, and where they come from.  Sanitised names come in; each column has a comment (its name, if none is given)."""
    width = len(names)
    said = comments or names
    columns = [F.get("cells", F.lit(i)).alias(n, metadata={"comment": comment(c)}) for i, (n, c) in enumerate(zip(column_names(names), said, strict=True))]
    where = [t.source_file(F.lit(source_file)).alias("_source_file"), F.lit(sheet_name).alias("_sheet_name"), F.col("row_no").cast("int").alias("_row_number")]
    if width > MOST_COLUMNS:
        raise ValueError(f"{width} columns; at most {MOST_COLUMNS} can be loaded")
    return rows.select(*columns, *where, F.current_timestamp().alias("_created_at"), F.lit(comment(description)).alias("_table_description"))


def publish(df: DataFrame, path: str) -> None:
    """Replaces the table at a path."""
    df.write.mode("overwrite").parquet(path)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def publish_table(df: DataFrame, name: str, description: str = "", database: str = "default") -> None:
    """Replaces a table of the catalogue, with comments on its columns (from their metadata) and on itself.

    Rows are written under a scratch name first, and the table takes the place of the old one only when they are whole: a
    load that fails leaves the old table as it was.
    """
    spark = df.sparkSession
    scratch, target = (f"{quoted(database)}.{quoted(n)}" for n in (f"{name}__new", name))
    spark.sql(f"DROP TABLE IF EXISTS {scratch}")
    df.write.saveAsTable(scratch)
    if description:
        spark.sql(f"COMMENT ON TABLE {scratch} IS '{comment(description).translate({39: chr(92) + chr(39), 92: chr(92) * 2})}'")
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(f"ALTER TABLE {scratch} RENAME TO {target}")


def publish_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch: int = 500) -> None:
    """Replaces a table of a database, in batches; text columns are as wide as their longest value needs."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    most = df.agg(*(F.coalesce(F.max(F.length(c)), F.lit(0)).alias(c) for c in texts)).select(*(t.column_type(F.col(c)).alias(c) for c in texts)).first()
    types = ", ".join(f"`{c}` {most[c]}" for c in texts)
    df.write.option("batchsize", batch).option("createTableColumnTypes", types).jdbc(url, table, mode="overwrite", properties=properties)
