"""Queries that have SQL, against it."""

import duckdb
import pytest

from cairnspark.llm.catalog import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    result = con.execute(SQL[name])
    own = [d[0] for d in result.description]
    assert sorted(own) == sorted(df.columns)
    got = sorted(map(tuple, df.select(own).collect()), key=str)
    assert got == sorted(result.fetchall(), key=str)
