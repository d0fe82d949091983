import os

import duckdb
import pytest

from lucerna.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = lambda it, names: sorted(repr([plain(r[names.index(c)]) for c in cols]) for r in it)
    assert rows(got.collect(), got.columns) == rows(want.fetchall(), want.columns)


def test_every_query_has_rows_of_a_stable_schema(spark):
    for name, q in QUERIES.items():
        assert q(spark, SF).schema == q(spark, SF).schema, name
