import hashlib
import math
import random
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from firnline.llm import importance as im

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def runs(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = WORD.findall(lower)
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target, percent=5, min_words=20):
    s, t = [0] * im.BUCKETS, [0] * im.BUCKETS
    code = lambda f: crc32(f.encode()) % im.BUCKETS
    for side, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in runs(text)[1]:
                side[code(f)] += 1
    S, T, B = sum(s), sum(t), im.BUCKETS
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + B) / ((s[b] + 1) * (T + B)))) for b in range(B)]
    out, able = {}, []
    for doc, text in docs:
        words, feats = runs(text)
        weight = sum(gain[code(f)] for f in feats)
        h = int(hashlib.sha256(f"42:{doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[doc] = [len(feats), weight, score, None]
        if len(words) >= min_words:
            able.append((-score, doc))
    for k, (_, doc) in enumerate(sorted(able)[: percent * len(able) // 100]):
        out[doc][3] = k + 1
    return sorted((d, *v) for d, v in out.items())


def corpus(n):
    rng = random.Random(3)
    vocabulary = ["Snow", "ICE", "über", "naïve", "42nd", "été", "x", "river", "Ünter", "日本", "a1b2", "zz"]
    texts = []
    for k in range(n):
        words = [rng.choice(vocabulary[: 6 + k % 7]) + rng.choice([" ", ", ", "\n", "--", "\x00", " ", "\x7f"]) for _ in range(rng.choice([0, 1, 2, 3, 19, 20, 21, 60]))]
        texts.append("".join(words))
    return list(enumerate(texts))


@pytest.mark.parametrize("held,joined", [(1 << 16, 4 << 20), (5, 200), (1, 1)])
def test_against_brute_force(spark, monkeypatch, held, joined):
    monkeypatch.setattr(im, "HELD", held)
    monkeypatch.setattr(im, "JOINED", joined)
    rows = corpus(400) + [(400, None), (401, ""), (402, "word " * 3000), (403, "ice" * 5000)]
    target = ["ice river ice", None, "", "Snow über river " * 9]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("score", F.lit("clash")).withColumn("place", F.lit(1))
    got = im.resampling_report(docs, spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")).collect()
    want = brute(rows, target)
    assert sorted(map(tuple, got)) == want
    assert sum(r[4] is not None for r in want) > 5


def test_ties_go_to_smaller_ids_and_repeats_are_kept(spark):
    scored = spark.createDataFrame([(k, 7 if k < 40 else k % 5, True) for k in range(100)] + [(3, 7, True), (None, 7, True)],
                                   "doc_id long, score long, drawable boolean").repartition(6)
    got = im.ranked(scored, 30, 30).where("rank is not null").orderBy("rank").collect()
    assert [r.rank for r in got] == list(range(1, 31))
    assert [r.doc_id for r in got] == [0, 1, 2, 3, 3, *range(4, 29)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert im.resampling_report(none, none).collect() == []
    some = spark.createDataFrame([(None, "one two"), (1, "a " * 30), (1, "a " * 30)], "doc_id long, text string")
    got = im.resampling_report(some, none).collect()
    assert len(got) == 3 and all(r["rank"] is None for r in got) and {r.n_features for r in got} == {3, 87}


def test_registered_query_reads_the_whole_table(spark, data):
    from firnline.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{data}/benchmark.parquet").select("text").collect()]
    got = sorted(map(tuple, QUERIES["op11_importance_resampling"](spark, data).collect()))
    assert got == brute(docs, target)
