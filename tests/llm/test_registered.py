"""Registered queries with equivalent SQL, over the whole small tables."""

import duckdb
import pytest

from firnline.llm.oracles import ORACLE
from firnline.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, data, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    rel = con.sql(ORACLE[name])
    got = QUERIES[name](spark, data)
    assert got.columns == rel.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, rel.fetchall()))
