from __future__ import annotations

import duckdb
import pytest

from sparvane.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in found.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, found.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*names).collect())
