import pytest

import __spark_entry__ as entry
from parity import cell, compare, connect
from __spark_entry__ import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, SMALL, name, QUERIES[name], SQL[name])
    assert ok, note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 10 and df.columns[0] == "entity_id"


#: Queries whose order is part of the answer.
ORDERED = {
    "export_projection": "avg_payment DESC NULLS LAST, entity_id",
    "quadrant_listing": "weighted_payment, entity_id",
    "footnote_counts": "n DESC, footnote_code NULLS FIRST",
    "quadrant_counts": "n DESC, quadrant",
}


@pytest.mark.parametrize(("name", "order"), ORDERED.items())
def test_order(spark, con, name, order):
    df = QUERIES[name](spark, SMALL)
    columns = ", ".join(f'"{c}"' for c in df.columns)
    want = con.execute(f"SELECT {columns} FROM ({SQL[name]}) ORDER BY {order}").fetchall()
    assert [tuple(map(cell, r)) for r in df.collect()] == [tuple(map(cell, r)) for r in want]
