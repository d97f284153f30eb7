"""Every query against its SQL in DuckDB, on the smallest test tables."""

import os

import duckdb
import pytest

from skeinflow.plans.catalogue import QUERIES
from skeinflow.plans.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLE_SQL[name])
    columns = sorted(d[0] for d in want.description)
    assert columns == sorted(got.columns)
    place = [[d[0] for d in want.description].index(c) for c in columns]
    expected = sorted(tuple(str(row[i]) for i in place) for row in want.fetchall())
    assert sorted(tuple(str(r[c]) for c in columns) for r in got.collect()) == expected


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
