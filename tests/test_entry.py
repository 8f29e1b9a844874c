"""Every registered linkage query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from mosaiq.plans import file_queries  # noqa: F401  registers its own
from mosaiq.plans import linkage_queries as L

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(L.ORACLES))
def test_query_is_its_sql(spark, duck, name):
    a, b = entry.queries()[name](spark, SF).toPandas(), duck.sql(L.ORACLES[name]).df()
    a, b = a[sorted(a)], b[sorted(b)]
    assert list(a) == list(b)
    order = lambda d: d.sort_values(list(d)).reset_index(drop=True).astype(str)
    assert order(a).equals(order(b))


def test_all_queries_are_told_apart():
    assert set(L.ORACLES) <= set(L.QUERIES) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
