"""Queries of the library against their own SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from millrace.plans import catalogue

SF = "/root/testdata/sf0.001"


def _plain(v):
    return round(v, 5) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, SF)
    names = sorted(got.columns)
    result = duck.execute(catalogue.oracle_sql()[name])
    have = [d[0] for d in result.description]
    assert sorted(have) == names
    want = sorted(repr([_plain(r[have.index(c)]) for c in names]) for r in result.fetchall())
    assert sorted(repr([_plain(r[c]) for c in names]) for r in got.collect()) == want
