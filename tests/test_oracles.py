"""Every query with an oracle gives the oracle's rows."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tidegate.plans import registry  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def rows(found):
    return sorted(tuple("" if x is None else str(x) for x in r) for r in found)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_oracle(spark, tables, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    ours = df.select(*columns).collect()
    cursor = tables.execute(registry.oracle_sql()[name])
    named = [c[0] for c in cursor.description]
    assert sorted(named) == columns
    theirs = [tuple(r[named.index(c)] for c in columns) for r in cursor.fetchall()]
    assert rows(ours) == rows(theirs)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
