from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from sparvane.plans import queries

SF = "/root/testdata/sf0.001"


def value(x):
    return None if isinstance(x, float) and math.isnan(x) else x


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_equals_its_sql(spark, con, name):
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(value(r[c]) for c in columns)) for r in df.collect())
    found = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in found.description]
    expected = sorted(repr(tuple(value(r[names.index(c)]) for c in columns)) for r in found.fetchall())
    assert sorted(names) == columns
    assert got == expected
    if name not in ("literal_subset", "top_entries_offset"):
        assert got


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
