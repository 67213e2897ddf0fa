import hashlib
import random
import struct

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from firnline.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def texts():
    rng = random.Random(5)
    out = [None, "", " ", "Hello World", "it's don''s '''re 12345 <|endoftext|>x<|startoftext|>", "éé ß İ Σ 中文字 가", "\t\r\x0b\x85a b　c"]
    for alphabet in ("abcdefghinorstuy", "aab'", "é中文字a1-", "!?.,'st", "éä"):
        for n in (50, 700, 3000):
            out.append("".join(rng.choice(alphabet) for _ in range(n)))
    out.append("word " * 50 + "".join(rng.choice("thentioner") for _ in range(5000)) + " tail\n" + "x" * 900 + "<|endoftext|>" * 30)
    return out


@pytest.mark.parametrize("leaf", [16, 100])
def test_tree_concatenation_is_exact(library, leaf):
    with open(PATH, encoding="utf-8") as f:
        codec = bpe.Codec(f.read(), leaf=leaf, window=4)
    for t in texts():
        want = ids_of(library, t)
        ids, decoded = codec.text(t)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, (t or "")[:40]
        assert decoded == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("spread", [1 << 20, 200])
def test_rows_agree_with_the_library(spark, library, spread):
    rows = list(enumerate(texts())) + [(3, "Hello World"), (None, "twice"), (None, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("row", F.lit(7))
    got = bpe.encode_texts(docs, PATH, digest=True, leaf=64, spread=spread).collect()
    want = []
    for i, t in rows:
        ids = ids_of(library, t)
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_round_trip_of_full_rows(spark, library):
    docs = spark.createDataFrame([(1, "the quick brown fox"), (2, None)], "doc_id long, text string")
    for r in bpe.encode_texts(docs, PATH).collect():
        assert bpe.decode_ids(bytes(r.ids), library) == r.decoded


def test_empty_table(spark):
    assert bpe.encode_texts(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_words_that_come_often_stay_in_memory(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 20_000)
    codec = bpe.Codec(open(PATH, encoding="utf-8").read())
    plain = codec.tokenizer
    for k in range(400):
        text = f"the common word{k} of snow, and word{k + 1}!"
        ids, decoded = codec.text(text)
        want = plain.encode(text, add_special_tokens=False).ids
        assert ids == struct.pack(f"<{len(want)}I", *want)
        assert decoded == plain.decode(want, skip_special_tokens=False)
    assert "common" in codec.memo or "common" in codec.old
    assert len(codec.memo) + len(codec.old) < 200
