"""Every stage of the pipeline against a plain reading of its rule."""

import re

import corpus_pipeline as cp
import public_tokenizers
from tokenizers import Tokenizer

from firnline.llm import decontaminate as dc
from firnline.llm import quality


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_duplicates", "benchmark_leaks", "secret_scan", "tokens"]
    kept = {r.doc_id for r in quality.quality_report(docs).where("kept").collect()}
    stages = dict(cp.STAGES)
    one = cp.written(stages["quality_rules"](spark, docs, data), "t")
    rows = {r.doc_id: r.text for r in one.collect()}
    assert set(rows) == kept and one.columns == docs.columns
    sets = {d: shingles(t) for d, t in rows.items()}
    root = {d: d for d in rows}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sorted(rows):
        for b in rows:
            if b < a and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    two = cp.written(stages["near_duplicates"](spark, one, data), "t")
    assert {r.doc_id for r in two.collect()} == {d for d in rows if top(d) == d} and two.columns == docs.columns
    leaks = {r.doc_id for r in dc.find_leaks(two, spark.read.parquet(f"{data}/benchmark.parquet")).collect()}
    three = cp.written(stages["benchmark_leaks"](spark, two, data), "t")
    assert {r.doc_id for r in three.collect()} == {d for d in rows if top(d) == d} - leaks
    four = cp.written(stages["secret_scan"](spark, three, data), "t")
    assert four.columns == docs.columns and four.count() == three.count()
    texts = {r.doc_id: r.text for r in four.collect()}
    assert not any(re.search(r"AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}", t) for t in texts.values())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in stages["tokens"](spark, four, data).collect():
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
