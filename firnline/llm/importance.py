"""Importance resampling towards a target distribution of hashed word runs.

A document's features are its runs of one to three words, hashed into a fixed
number of buckets.  The corpus and the target each make one histogram; a bucket's
gain is the logarithm of their smoothed ratio, a document's weight the sum of its
features' gains, and the documents with the greatest weight plus Gumbel noise are
drawn, which samples without replacement in proportion to the weights.

The texts of a batch are joined with a separator, one pattern pass finds all
words, the words' places are looked up in the documents' offsets, and runs whose
first and last word lie in different documents are masked before they are counted.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import islice, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import numbered, prepare, written

BUCKETS = 10_000
RUN = 3
#: Neither a letter nor a digit, so no word spans two texts.
SEPARATOR = b"\x00"
#: A word in lower-cased UTF-8: digits, letters and everything beyond ASCII.
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Bytes joined at once (a longer text stands alone) and words held at once.
JOINED, HELD = 4 << 20, 1 << 16


def joined_texts(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """The column's texts (null: empty) in pieces for one buffer, each with the
    row it starts at."""
    first, size, piece = 0, 0, []
    for row, text in enumerate(column.cast(pa.binary())):
        data = text.as_py() or b""
        if piece and size + len(data) > JOINED:
            yield first, piece
            first, size, piece = row, 0, []
        piece.append(data)
        size += len(data) + 1
    if piece:
        yield first, piece


def features(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """All features as ``(words in the run, text's place in the list, bucket)``.

    Words arrive in portions; the last words of a portion are kept as the start of
    the runs that end in the next one, so memory does not grow with the texts
    beyond the buffer itself.
    """
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    matches = WORDS.finditer(SEPARATOR.join(texts).lower())
    words: list[bytes] = []
    where = np.zeros(0, np.int64)
    while portion := list(islice(matches, HELD)):
        fresh = len(words)
        words += [m.group() for m in portion]
        at = np.fromiter((m.start() for m in portion), np.int64, len(portion))
        where = np.concatenate([where, np.searchsorted(offsets, at, side="right") - 1])
        sums: list[int] = []
        for n in range(1, RUN + 1):
            # a run's checksum goes on from that of the run without its last word
            spaced = map(crc32, repeat(b" "), sums[:-1]) if n > 1 else repeat(0)
            sums = list(map(crc32, words[n - 1 :], spaced))
            begin = max(0, fresh - n + 1)
            one, last = where[begin : len(words) - n + 1], where[begin + n - 1 :]
            inside = one == last
            yield n, one[inside], (np.array(sums[begin:], np.int64) % BUCKETS)[inside]
        words, where = words[1 - RUN :], where[1 - RUN :]


def bucket_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Features of all texts per bucket.  A task sends one row per bucket, whatever
    it read; what comes to the driver has as many rows as there are buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, texts in joined_texts(batch.column(0)):
                for _, _, bucket in features(texts):
                    total += np.bincount(bucket, minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the smoothed ratio, rounded down, per bucket."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
        for s, t in zip(corpus.tolist(), target.tolist())
    ], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", seed: int = 42) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_features, weight, score``.

    The score adds Gumbel noise that depends on ``seed`` and the id alone (a null
    id counts as empty); documents without words have no features and weight 0.
    """
    kind = dict(docs.dtypes)[doc_id]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, runs, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for row, texts in joined_texts(batch.column(2)):
                size = len(texts)
                here = slice(row, row + size)
                for length, place, bucket in features(texts):
                    found = np.bincount(place, minlength=size)
                    runs[here] += found
                    if length == 1:
                        words[here] += found
                    weight[here] += np.bincount(place, weights=gain[bucket], minlength=size).astype(np.int64)
            noise = [math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c) for c in (words, runs, weight, weight + np.array(noise, np.int64))]],
                names=["doc_id", "n_words", "n_features", "weight", "score"])

    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return docs.select(F.col(doc_id).alias("doc_id"), draw.alias("draw"), F.col(text).cast("string").alias("text")).mapInArrow(
        score, f"doc_id {kind}, n_words long, n_features long, weight long, score long"
    )


def ranked(scored: DataFrame, keep: int, percent: int) -> DataFrame:
    """``scored`` with the ``rank`` of its ``keep`` best rows, highest score first,
    ties to the smaller id; the others have none.

    Rows that cannot be drawn are set aside by a quantile whose error is bounded;
    the others are sorted and numbered over the cluster.
    """
    # the quantile is off by a ten-thousandth of the rows at most; a hundredth is left
    share = max(0.0, 1 - percent / 100 - 0.01)
    eligible = F.col("drawable") & (F.col("score") >= F.lit(
        scored.where("drawable").agg(F.percentile_approx("score", share, 10_000)).first()[0]
    ))
    best = numbered(scored.where(eligible), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()])
    top = best.select(*scored.columns, F.when(F.col("place") < keep, F.col("place") + 1).alias("rank"))
    rest = scored.where(~F.coalesce(eligible, F.lit(False)))
    return top.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = 5, min_words: int = 20, seed: int = 42,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_features, weight, score, rank``.

    Of the documents with at least ``min_words`` words, ``percent`` in a hundred
    are drawn (rounded down); ``rank`` numbers them from 1 and is null for all
    others.  Null and empty texts have no features; a null id comes last among
    ties; repeated rows are drawn each for itself, in any order among themselves;
    an empty table gives no rows, an empty target leaves smoothing alone to decide;
    other columns are not read.  Whole texts are read twice, once for the corpus's
    histogram and once for the weights.
    """
    prepare(docs.sparkSession)
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    scored = written(weighted(docs, gain, doc_id, text, seed), "scored").withColumn("drawable", F.col("n_words") >= min_words)
    keep = percent * scored.where("drawable").count() // 100
    if not keep:
        return scored.drop("drawable").withColumn("rank", F.lit(None).cast("long"))
    return ranked(scored, keep, percent).drop("drawable")


def resampling_report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """The registered columns of :func:`resample`."""
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
