"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from hoptally import queries as registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"create view {t.removesuffix('.parquet')} as select * from '{SF}/{t}'")
    return c


def plain(rows, columns):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(repr([int(r[i]) if not isinstance(r[i], (str, bool, type(None))) else r[i] for i in at]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(want.fetchall(), list(want.columns))


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
