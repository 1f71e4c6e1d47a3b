"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import os

import duckdb
import pytest

from parcelflow.plans import oracle, queries

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def rows(values, columns):
    return sorted(tuple(str(v) for _, v in sorted(zip(columns, r, strict=True))) for r in values)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_as_sql(spark, con, name):
    df = queries.queries()[name](spark, DIR)
    cur = con.execute(oracle.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(cur.fetchall(), columns)
