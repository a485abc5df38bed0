"""Every query of the engine against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from tidewheel.plans.oracle import oracle_sql
from tidewheel.plans.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = queries()[name](spark, SF)
    got = sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
    found = con.execute(oracle_sql()[name])
    columns = [d[0] for d in found.description]
    at = [columns.index(c) for c in sorted(columns)]
    assert sorted(columns) == sorted(df.columns)
    assert got == sorted(repr(tuple(r[k] for k in at)) for r in found.fetchall())
