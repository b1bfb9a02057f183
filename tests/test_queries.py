"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from scorchmap.plans.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, DIR)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted(map(tuple, want.project(", ".join(f'"{c}"' for c in columns)).fetchall()), key=repr)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == rows
