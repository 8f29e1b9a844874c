import os

import duckdb
import pytest

from mosaiq.llm import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_is_its_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    a, b = registry.QUERIES[name](spark, SF).toPandas(), con.sql(registry.ORACLES[name]).df()
    a, b = a[sorted(a)], b[sorted(b)]
    order = lambda d: d.sort_values("doc_id").reset_index(drop=True).astype(str)
    assert list(a) == list(b) and order(a).equals(order(b))
