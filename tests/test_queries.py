"""Every query that has SQL equals it on the small tables."""

import math
import os
from pathlib import Path

import pytest

from stratavox.plans import catalog

duckdb = pytest.importorskip("duckdb")
DATA = Path(os.environ.get("QUERY_DATA", "/root/testdata/sf0.001"))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    return f"{float(v):.9g}" if isinstance(v, (int, float)) else str(v)


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_as_sql(spark, con, name):
    got = catalog.QUERIES[name](spark, str(DATA))
    want = con.sql(catalog.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, str(DATA)).count() > 0


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
