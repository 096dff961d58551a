"""Every registered query against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from fieldloom.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return c


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(map(repr, frame.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_matches_duckdb(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA).toPandas()
    want = duck.execute(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    for c in got.columns:
        want[c] = want[c].astype(got[c].dtype)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs(spark, name):
    # The smallest tables leave some of these without rows.
    assert catalogue.QUERIES[name](spark, DATA.replace("sf0.001", "sf0.01")).count() > 0
