import duckdb
import pytest

from vitrine.llm.oracles import ORACLES
from vitrine.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    con.execute(ORACLES[name])
    order = [d[0] for d in con.description]
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(order)
    wanted = sorted(map(repr, con.fetchall()))
    assert sorted(repr(tuple(r)) for r in found.select(*order).collect()) == wanted
