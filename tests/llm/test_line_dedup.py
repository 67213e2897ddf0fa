import hashlib
import random

import pytest
from pyspark.sql import functions as F

from firnline.llm import line_dedup as ld


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows):
    held = {}
    for n, (doc, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                held.setdefault(k, []).append(doc)
    top = {k: max((d for d in ds if d is not None), default=None) for k, ds in held.items() if len(ds) >= 3}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if top.get(key(x)) is None or (doc is not None and doc >= top[key(x)])]
        out.append((doc, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(n, seed=5):
    rng = random.Random(seed)
    shared = [f"Shared line {k} with snow and ice" for k in range(25)] + ["é" * 19, "é" * 20, "x" * 19, "x" * 20, "  " + "y" * 18 + "\t", " " + "z" * 19, "İstanbul is a long line too"]
    rows = []
    for doc in range(n):
        lines = []
        for _ in range(rng.randint(0, 9)):
            s = rng.choice(shared) if rng.random() < 0.6 else f"own line of document {doc} number {rng.random()}"
            lines.append(rng.choice(["", " ", "\t", "\r"]) + (s.upper() if rng.random() < 0.2 and s.isascii() else s) + rng.choice(["", " \x0b\x0c", "\r"]))
        rows.append((doc, "\n".join(lines) + rng.choice(["", "\n", "\n\n"])))
    return rows


EXTRA = [(None, "x" * 20 + "\nheld without any id at all"), (None, "held without any id at all"), (None, "held without any id at all"), (900, None), (901, ""),
         (902, "\n\n\n"), (903, "A line that one row repeats\n" * 5), (903, "A line that one row repeats"), (903, "a line that one row repeats\nx"), (904, "long " * 50_000)]


@pytest.mark.parametrize("waves", [1, 3])
def test_against_brute_force(spark, waves):
    rows = corpus(200) + EXTRA
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("drop", F.lit(1)).repartition(4)
    got = ld.dedup_lines(docs, waves=waves).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect()
    want = brute(rows)
    assert sorted(map(tuple, got), key=str) == want
    assert sum(r[2] > 0 for r in want) > 100


def verdicts(store, docs):
    return sorted((tuple(r) for r in ld.apply_drops(docs, store.dropped_lines()).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect()), key=str)


@pytest.mark.parametrize("marks", [0xFFFF, 3])
def test_deletions_are_exact_and_reversible(spark, monkeypatch, marks):
    """Also with marks of two bits, when most lines are taken for others."""
    monkeypatch.setattr(ld.Cuckoo, "MARKS", marks)
    monkeypatch.setattr(ld, "SHARD_LINES", 200)
    rows = corpus(90)
    table = lambda some: spark.createDataFrame(some, "doc_id long, text string")
    store = ld.LineStore(spark, 2)
    store.insert(table(rows[:50]))
    before = verdicts(store, table(rows[:50]))
    assert before == brute(rows[:50])
    store.insert(table(rows[50:]))
    assert verdicts(store, table(rows)) == brute(rows)
    ids = lambda some: spark.createDataFrame([(d,) for d, _ in some] + [(7777,)], "doc_id int")
    store.delete(ids(rows[50:]))
    assert verdicts(store, table(rows[:50])) == before
    store.delete(ids(rows[10:30]))
    store.insert(table(rows[40:]))  # some of them a second time
    left = rows[:10] + rows[30:50] + rows[40:]
    got = {tuple(r) for r in store.exact_counts().select(F.hex("key"), "n", "top").collect()}
    held = {}
    for doc, text in left:
        for k in {key(x) for x in text.split("\n") if len(key(x)) >= 20}:
            held.setdefault(k, []).append(doc)
    assert got == {(ld.hash_of(k.encode()).hex().upper(), len(v), max(v)) for k, v in held.items()}
    held_by_filters = {(r.shard, r.filter) for r in store.filters.collect()}
    marks_in = sum(sum(1 for layer in ld.Cuckoo.of(f).layers for s in layer if s) for _, f in held_by_filters)
    assert marks_in == len(held)


def test_cuckoo_keeps_what_was_added_and_grows():
    rng = random.Random(1)
    kept = ld.Cuckoo(64)
    hashes = [rng.getrandbits(64) - (1 << 63) for _ in range(1000)]
    for h in hashes:
        kept.add(h)
    assert len(kept.layers) > 1 and all(h in kept for h in hashes)
    for h in hashes[:500]:
        kept.discard(h)
    again = ld.Cuckoo.of(kept.packed())
    assert all(h in again for h in hashes[500:])
    assert sum(h in again for h in hashes[:500]) < 50


def test_later_waves_meet_the_filters(spark, data):
    refs = ld.references(spark.read.parquet(f"{data}/documents.parquet"), "doc_id", "text", ld.MIN_CHARS).cache()
    store = ld.LineStore(spark, 4)
    store.add(refs.where("doc_id % 2 = 0"))
    store.add(refs.where("doc_id % 2 = 1"))
    known, new = store.counts[1].where("known").count(), store.counts[1].where("not known").count()
    assert known > 0 and new > known


def test_empty_table(spark):
    assert ld.dedup_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
