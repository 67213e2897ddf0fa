"""Every registered query against its SQL on the smallest data set."""

import pytest
from oracle import compare, connect

from firnline.registry import load

QUERIES, ORACLE = load()
# map projections: rows are checked in test_spatial
NO_SQL = {"target_sources", "season_mosaic", "plan_wet_snow"}


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, data, name):
    state, n, note = compare(spark, con, data, name, QUERIES[name], ORACLE.get(name))
    assert state == ("rows-only" if name in NO_SQL else "ok"), note


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
