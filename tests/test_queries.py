"""Every query with SQL, on the smallest tables, against DuckDB."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple("" if r[i] is None else f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_oracle(spark, name):
    base = duckdb.connect()
    for t in TABLES:
        base.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = base.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    expected = normal(cursor.fetchall(), names)
    df = __spark_entry__.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert normal([tuple(r) for r in df.collect()], df.columns) == expected


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
