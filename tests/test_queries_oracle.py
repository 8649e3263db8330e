"""Every registered query against its DuckDB oracle at sf0.001 (the driver's
correctness gate, run locally on the smallest tables)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from lodestar.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cols = sdf.columns
    srows = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=_key)
    sql = E.oracle_sql().get(name)
    assert sql is not None, "every query of the library has an oracle"
    res = duck.execute(sql)
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
    assert srows == drows
