"""Every registered query against its SQL in DuckDB."""

import oracle
import pytest

import __spark_entry__ as entry
from strataledger.queries import ORACLES as SQL
from strataledger.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf, con, name):
    diff = oracle.compare(QUERIES[name](spark, sf), con, SQL[name])
    assert [d for d in diff if d != "EMPTY"] == []


@pytest.mark.parametrize(
    ("name", "keys"), [("order_multi", [1, 2]), ("top_n", [2, 0]), ("order_binary", [1, 0]), ("order_desc_recent", [1])]
)
def test_rows_come_in_order(spark, sf, con, name, keys):
    got = [tuple(r[k] for k in keys) for r in QUERIES[name](spark, sf).collect()]
    assert got == [tuple(r[k] for k in keys) for r in con.execute(SQL[name]).fetchall()]


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["version_type", "event_type", "n", "total"]
    assert out.agg({"n": "sum"}).first()[0] == 1_000
