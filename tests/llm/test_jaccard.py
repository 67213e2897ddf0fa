import random
import re

import pytest
from pyspark.sql import functions as F

from firnline.llm import jaccard


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2)))


def brute(rows):
    """Component id of every row, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [(d, len(s), least[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def corpus(seed=1, groups=14, copies=14):
    rng = random.Random(seed)
    vocabulary = ["w" + str(k) for k in range(300)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 11, 14, 25, 40, 90, 200, 700]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                at = rng.randrange(len(words))
                rng.choice([lambda: words.insert(at, "new" + str(rng.random())), lambda: words.__setitem__(at, "x" + str(rng.random())), lambda: words.append("end")])()
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + k, t) for k, t in enumerate([None, "", " \n\t", "one", "ONE", "one two", "one two three", "É one two", "é one two"])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,cost", [(1, 4.0), (2, 0.0), (3, 1e6)])
def test_against_all_pairs(spark, seed, cost):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("label", F.lit("x"))
    got = jaccard.jaccard_components(docs, candidate_cost=cost).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_costly_segments_are_swapped(spark):
    costs = spark.createDataFrame([(1, 0, 100.0, 110.0), (1, 1, 1.0, 5.0), (1, 2, 2.0, 50.0), (2, 0, 1.0, 5.0), (2, 1, 1.0, 5.0)], "band long, segment long, equal double, near double")
    got = sorted(map(tuple, jaccard.allocation(costs).collect()))
    assert got == [(1, 0, -1), (1, 1, 1)]


def test_one_document_of_each_group_stays(spark):
    rows = corpus(4, groups=5, copies=6)
    rows += [rows[0], (None, "lonely words without an id"), (None, "lonely words without an id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit("clash"))
    kept = jaccard.keep_one_each(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id for r in kept.collect()), key=str)
    want = {c for _, n, c in brute(rows) if n} | {d for d, t in rows if not shingles(t)}
    assert set(got) == want
    assert got.count(None) == 2 and len(got) == len(want) + 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_components(empty).collect() == []
    assert jaccard.keep_one_each(empty).collect() == []
