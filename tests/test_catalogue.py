"""Every query with an oracle gives DuckDB's rows on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from palimpsest import catalogue

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("<NA>", "NaT"):
        return "None"
    if isinstance(v, (bool, str)):
        return repr(v)
    try:
        return repr(int(v)) if float(v).is_integer() else repr(float(v))
    except (TypeError, ValueError):
        return str(v)


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(map(plain, r)) for r in frame[names].astype(object).values)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_oracle(spark, duck, name):
    assert rows(catalogue.QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(catalogue.ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs(spark, name):
    found = catalogue.QUERIES[name](spark, SF)
    assert found.count() >= 0 and found.columns


def test_entry_without_the_other_subpackage():
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
