"""Every registered query against its SQL twin on the smallest tables."""

import datetime as dt
import decimal

import duckdb
import pytest
from conftest import SMALL

from lakeops.plans import ORACLES, QUERIES
from lakeops.tables import TABLE_NAMES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return con


def text(value):
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    got = sorted(tuple(text(r[c]) for c in columns) for r in frame.collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted(tuple(text(r[i]) for i in at) for r in cursor.fetchall())
    assert got == want


def test_every_unchecked_query_is_known():
    assert set(QUERIES) - set(ORACLES) == {"ann_search", "ann_search_filtered", "recall_at_k"}
