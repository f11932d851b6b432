"""Registered queries over the small tables, against their SQL where duckdb is installed."""

import os

import pytest

from gridledger import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(plans.oracle_sql()) <= set(plans.queries())


def plain(rows):
    return sorted(tuple("" if v is None else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, duck, name):
    out = plans.queries()[name](spark, SF)
    columns = sorted(out.columns)
    rows = out.select(*[f"`{c}`" for c in columns]).collect()
    sql = plans.oracle_sql().get(name)
    if sql is None:
        assert columns and rows is not None
        return
    want = duck.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({sql}) AS q").fetchall()
    assert plain(rows) == plain(want)
