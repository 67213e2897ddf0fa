import random
import re

import pytest
from pyspark.sql import functions as F

from firnline.llm import decontaminate as dc


def plain(text):
    return [w for w in (re.sub(r"[\W_]+", "", x.lower()) for x in (text or "").split()) if w]


def brute(item, text):
    """Least edits between the item and any stretch of the text, cell by cell."""
    a, b = plain(item), plain(text)
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5))) for _ in range(400)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(say(rng.choice([5, 8, 13, 20, 35, 60])))) for k in range(30)]
    docs = []
    for k in range(300):
        words = say(rng.randint(0, 300))
        if k % 2:
            piece = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, max(1, len(piece) // 4))):
                at = rng.randrange(len(piece))
                kind = rng.randrange(3)
                if kind == 0:
                    piece[at] = "zz" + str(rng.randrange(99))
                elif kind == 1:
                    piece.insert(at, "qq" + str(rng.randrange(99)))
                elif len(piece) > 1:
                    del piece[at]
            at = rng.randint(0, len(words))
            words[at:at] = [w.title() + rng.choice(["", ",", "."]) for w in piece]
        docs.append((k, " ".join(words)))
    return docs, items


def test_against_brute_force(spark, planted):
    docs, items = planted
    want = set()
    for d, t in docs:
        for i, s in items:
            n = len(plain(s))
            e = brute(s, t)
            if n >= dc.MIN_WORDS and e <= dc.limit_of(n, dc.SIMILARITY):
                want.add((d, i, e))
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.edits) for r in dc.find_leaks(frame, bench).collect()]
    assert len(want) > 80
    assert set(got) == want and len(got) == len(want)
    kept = {r.doc_id for r in dc.drop_leaks(frame, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _, _ in want}


def test_nulls_ties_and_empty_tables(spark):
    item = "one two three four five six seven"
    docs = spark.createDataFrame([(None, item), (1, None), (2, ""), (3, item), (3, item), (4, "x " * 50_000 + item)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too short"), (None, item)], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in dc.find_leaks(docs, bench).collect()), key=str)
    assert got == sorted([(d, i) for d in (None, 3, 3, 4) for i in (1, 1, None)], key=str)
    assert sorted(r.doc_id for r in dc.drop_leaks(docs, bench).collect()) == [1, 2]
    assert dc.find_leaks(docs.where("false"), bench).collect() == []
    assert dc.find_leaks(docs, bench.where("false")).collect() == []
    assert dc.drop_leaks(docs, bench.where("false")).count() == 6


def test_items_under_four_words_match_by_sequence(spark):
    bench = spark.createDataFrame([(1, "Glacier"), (2, "snow line"), (3, "ice on lakes"), (3, "ice on lakes"), (4, ""), (5, "?!"), (6, "one two three four five")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "a glacier, a GLACIER!"), (2, "the Snow-line is no snow, line"), (3, "on lakes ice"), (4, "no ice on lakes"), (5, "line snow"), (6, ""),
        (7, "ice on lakes snow line one two three four five"), (8, None), (9, "glaciers"),
    ], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.edits, r.item_words, r.last_word) for r in dc.find_leaks(docs, bench).collect())
    assert got == [(1, 1, 0, 1, 2), (2, 2, 0, 2, 6), (4, 3, 0, 3, 4), (4, 3, 0, 3, 4), (7, 2, 0, 2, 5), (7, 3, 0, 3, 3), (7, 3, 0, 3, 3), (7, 6, 0, 5, 10)]
    assert sorted(r.doc_id for r in dc.drop_leaks(docs, bench).collect()) == [3, 5, 6, 8, 9]


@pytest.mark.parametrize("kind", ["smallint", "date", "decimal(10,2)", "string", "double"])
def test_item_ids_of_any_type(spark, kind):
    item = "the river ice broke up late in the spring of that year"
    docs = spark.createDataFrame([(1, "so " + item), (2, "nothing")], "doc_id long, text string")
    number = F.lit(7) if kind != "date" else F.lit("2024-01-25")
    bench = spark.createDataFrame([(item,)], "text string").select(number.cast(kind).alias("item_id"), "text")
    found = dc.find_leaks(docs, bench)
    assert dict(found.dtypes)["item_id"] == kind
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, bench.first().item_id)]
