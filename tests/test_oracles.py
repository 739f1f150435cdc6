"""Every query with SQL gives the rows DuckDB gives."""

import math
import os

import duckdb
import pytest

from tidewell.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(names, values):
    order = sorted(range(len(names)), key=lambda k: names[k])

    def text(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return "null"
        if isinstance(v, bool):
            return str(v)
        return repr(round(float(v), 9)) if isinstance(v, int | float) else str(v).removesuffix("+00:00")

    return [names[k] for k in order], sorted(tuple(text(v[k]) for k in order) for v in values)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got[1] or name in ("page_boards", "page_postings")
        return
    rel = con.sql(sql)
    assert got == rows(rel.columns, rel.fetchall())
