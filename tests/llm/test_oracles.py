"""DuckDB's rows for the queries that SQL can express."""

import glob
import os

import duckdb
import pytest

from palimpsest.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    found = queries.QUERIES[name](spark, SF)
    names = sorted(found.columns)
    want = duck.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(repr, map(tuple, found.select(*names).collect()))) == sorted(map(repr, want))
