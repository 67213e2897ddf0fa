import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from firnline.llm import suffix_dedup as sd


def brute(rows, width=200):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for (doc, _), d in zip(rows, data):
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - width + 1):
            if count[d[i : i + width]] > 1:
                gone[i : i + width] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(d) else 0
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((doc, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_cover_has_every_difference():
    assert {(a - b) % sd.PERIOD for a in sd.COVER for b in sd.COVER} == set(range(sd.PERIOD))


def test_hash_depends_on_exactly_its_bytes():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 3, 3000).astype(np.uint8)
    with np.errstate(over="ignore"):
        for width in (67, 68, 200):
            h = sd.string_hashes(data, width)
            seen = {}
            for i in range(len(h)):
                assert seen.setdefault(int(h[i]), bytes(data[i : i + width])) == bytes(data[i : i + width])
            assert (sd.string_hashes(data[5:], width) == h[5:]).all()


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    say = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [say(n) for n in (199, 200, 201, 350, 900)]
    rows = []
    for k in range(60):
        t = say(rng.randint(0, 400))
        for _ in range(rng.randint(0, 2)):
            s = rng.choice(shared)
            cut = rng.randint(0, 30)
            t += s[cut:] + say(rng.randint(0, 60))
        rows.append((k, t))
    rows += [(60, rows[7][1]), (60, rows[7][1]), (61, None), (62, ""), (None, "x" * 199), (63, "y" * 201), (64, "ab" * 150), (65, "ab" * 99 + "b"),
             (66, rows[3][1] + "\n" + shared[3]), (67, say(6000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("tid", F.lit(1))
    want = brute(rows)
    assert sum(r[2] > 0 for r in want) > 20
    got = sd.dedup_report(docs).collect()
    assert sorted(map(tuple, got), key=str) == want


def test_empty_table(spark):
    assert sd.dedup_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
