"""Every query of the library against its SQL, on the smallest tables."""

import os

import duckdb
import pytest
from tidemark import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def value(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(value(r[c]) for c in columns) for r in df.collect())
    if name not in queries.ORACLE_SQL:
        assert got
        return
    rel = duck.sql(queries.ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert got == sorted(tuple(value(r[i]) for i in at) for r in rel.fetchall())
