import random

import duckdb
import pytest
from pyspark.sql import functions as F

from firnline.llm import divergence as dv
from firnline.llm.oracles import ORACLE


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return sorted(con.sql(ORACLE["op13_source_divergence"]).fetchall(), key=str)


def corpus(n):
    rng = random.Random(9)
    words = ["Snow", "ICE", "über", "naïve", "x42y", "été", "日本", "river", "riverbed", "rivers", "Ünter", "a", "ab", "abc", "zz", "don't"]
    rows = []
    for _ in range(n):
        source = rng.choice(["s1", "s2", "S3", "é", None, ""])
        k = 5 + (hash(source or "") % 3) * 4
        rows.append((rng.choice([" ", "-", "7"]).join(rng.choice(words[:k] if rng.random() < 0.7 else words) for _ in range(rng.randint(0, 25))), rng.choice(["en", "de", None, "en"]), source))
    return rows + [(None, "en", "s9"), ("", "xx", "only"), ("rare words here", "yy", "one"), ("others there", "yy", "two"), (None, None, None), ("snow " * 400_000, "en", "s1")]


SETTINGS = [{}, {"block": 3, "cells": 7}, {"block": 3, "cells": 1, "sent": 0}, {"block": 100, "sent": 0}]


@pytest.mark.parametrize("settings", SETTINGS)
def test_against_sql(spark, monkeypatch, settings):
    monkeypatch.setattr(dv, "HELD", 50 if settings else dv.HELD)
    monkeypatch.setattr(dv, "RANGE", 4 if settings else dv.RANGE)
    rows = corpus(300)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("ordinal", F.lit("clash")).withColumn("n", F.lit(1)).repartition(5)
    got = sorted(map(tuple, dv.divergence(docs, **settings).collect()), key=str)
    assert got == by_sql(rows)
    assert {r[2] for r in got} == {"pair", "term"} and ("yy", "one", "pair", "two", 0, 1) in got


def test_types_and_empty_table(spark):
    none = dv.divergence(spark.createDataFrame([], "text string, lang string, source string"))
    assert none.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert none.collect() == []


def minimal_states(terms):
    """Right languages of all prefixes: as many states as the least automaton has."""
    prefixes = {t[:i] for t in terms for i in range(len(t) + 1)}
    return len({frozenset(t[len(p):] for t in terms if t.startswith(p)) for p in prefixes})


def test_transducer_is_minimal_and_gives_ordinals():
    rng = random.Random(2)
    for size in (1, 2, 30, 200):
        terms = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))).encode() for _ in range(size)})
        one = dv.Transducer.of(dv.Transducer.build(terms).packed())
        assert one.ordinals(terms).tolist() == list(range(len(terms)))
        others = [t for t in {"".join(rng.choice("abcé") for _ in range(rng.randint(1, 7))).encode() for _ in range(500)} if t not in terms]
        assert set(one.ordinals(others).tolist()) <= {-1}
        assert len(one.final) == minimal_states(terms)


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, terms = 123_456_789_012_345, 987_654_321_098_765_432, 7_000_000
    got = spark.range(1).select(dv.share(F.lit(n), F.lit(total), F.lit(terms))).first()[0]
    assert got == 1 + dv.SCALE * (n + 2) // (total + 2 * terms)
