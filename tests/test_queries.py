"""Every query of the catalogue against its SQL."""

import math

import duckdb
import pytest

from cairnspark.plans.catalog import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(values):
    plain = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(plain(v) for v in r) for r in values), key=str)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, oracle, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = oracle.execute(SQL[name])
    own = [d[0] for d in result.description]
    assert sorted(own) == columns
    at = [own.index(c) for c in columns]
    assert rows(df.select(columns).collect()) == rows([tuple(r[i] for i in at) for r in result.fetchall()])


def test_primary_first_of_large_keys(spark, tmp_path):
    """Part and supplier keys beyond a million, as larger tables have."""
    rows_ = [(1, 1, 1_200_000, 1, "A"), (1, 2, 5, 1, "B"), (2, 1, 7, 2_500_000, "C"), (2, 1, 8, 3, "D"), (3, 2, 1, 1, "E"), (3, 1, 10**15, 9, "F")]
    lines = spark.createDataFrame([(o, n, p, s, f, 9.0, "O") for o, n, p, s, f in rows_], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_quantity double, l_linestatus string")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    want = rows(con.execute(SQL["primary_first"]).fetchall())
    assert want == [(1, "A"), (2, "C"), (3, "F")]
    assert rows(QUERIES["primary_first"](spark, str(tmp_path)).select("page_id", "gt_type").collect()) == want
