"""Every core query against the SQL that states its result, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from loomcrawl.plans import registry

SF = "/root/testdata/sf0.001"


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    show = lambda v: "null" if v is None or v != v else repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(map(show, r)) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, oracle, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    if name in registry.ORACLE_SQL:
        assert rows_of(got) == rows_of(oracle.sql(registry.ORACLE_SQL[name]).df())
    else:
        assert len(got.columns) > 0
