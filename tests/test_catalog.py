"""Every query with SQL gives the rows that DuckDB does."""

import duckdb
import pytest

from ribolith.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = [tuple(r) for r in df.select(*(f"`{c}`" for c in cols)).collect()]
    rel = duck.sql(catalog.ORACLES[name])
    assert sorted(rel.columns) == cols
    at = [list(rel.columns).index(c) for c in cols]
    want = [tuple(r[i] for i in at) for r in rel.fetchall()]
    assert sorted(map(str, got)) == sorted(map(str, want))
