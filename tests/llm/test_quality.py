"""Quality counts of short texts against the equivalent SQL."""

import duckdb
import pytest

from firnline.llm import quality
from firnline.llm.oracles import ORACLE

TEXTS = [
    None, "", " ", "a", "a b", "a b c", "a a a", "a a a a", "- - - - -", "a a a a a a", "a\n\na", "one two three", "x y z x y z",
    "é é é é", "aaaaaaaaaaa", "#!? #!? #!? #!?", "a\ta\na\ra", "word " * 60,
]


def test_short_texts_against_sql(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a a a a"), (7, "a a a a")]
    got = quality.quality_report(spark.createDataFrame(rows, "doc_id long, text string"))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    rel = con.sql(ORACLE["op8_quality"])
    assert got.columns == rel.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, rel.fetchall()))


@pytest.mark.parametrize(("text", "want"), [("a a a a", 4), ("- - - - -", 5), ("a a a", 0), ("a b", 0), ("", 0), (None, 0)])
def test_repeated_windows_of_short_texts(spark, text, want):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality.quality_report(docs).collect()[0].n_repeat_words == want
