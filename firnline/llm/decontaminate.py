"""Benchmark decontamination by embedded edit distance.

Texts and benchmark items are sequences of normalised words.  A window as long
as an item is embedded by a random walk (CGK): equal steps keep two sequences
together, an edit sets them apart only until the walks meet again, so edit
distance becomes Hamming distance.  Sampling a few steps of the embedding gives a
bucket; the sampling is repeated, with walks of its own each time, as often as a
target recall needs, which is measured on edited items when the job is planned.
What shares a bucket with an item is verified by exact edit distance.

Windows come from the count filter for 3-grams (a window within ``d`` edits of
``w`` words shares at least ``w - 2 - 3d`` of them), which loses nothing and
leaves little for the buckets to reject.  Items under four words are looked up as
whole word sequences.
The benchmark is read in blocks of bounded size; texts never move.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from firnline.llm.common import worker_slot

#: Least edit similarity, least words of an item that is searched with edits.
SIMILARITY, EDIT_WORDS, MIN_WORDS = 0.8, 6, 4
#: Sampled steps of a repetition, recall to reach, most repetitions, and bytes of
#: benchmark text in a block.
SAMPLED, RECALL, MOST, BLOCK_BYTES = 2, 0.9999, 64, 4 << 20
#: Hashes of words kept in a worker's memory, about 150 bytes each.
KNOWN_WORDS = 200_000
#: Windows embedded at once.
PIECE = 2048

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """Hash of a raw word's normal form: lower case, letters and digits only; 0 if empty."""

    def __missing__(self, word: str) -> int:
        plain = re.sub(r"[\W_]+", "", word.lower())
        self[word] = value = xxhash.xxh3_64_intdigest(plain) | 1 if plain else 0
        return value

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        found = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        return found[found != 0] if len(found) else found


def grams(words: np.ndarray) -> np.ndarray:
    """Hash of each 3 words running."""
    if len(words) < 3:
        return np.zeros(0, np.uint64)
    x = (words[:-2] * _ODD) ^ (words[1:-1] >> np.uint64(7))
    x = (x * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (words[2:] >> np.uint64(3))
    return x * np.uint64(0x165667B19E3779F9)


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` words running, for items too short for grams."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        out = (out ^ words[k : k + len(out)]) * _ODD
        out ^= out >> np.uint64(29)
    return out


class Walks:
    """Random walks for ``repeats`` repetitions over ``3 * width`` steps."""

    def __init__(self, width: int, repeats: int, sampled: int = SAMPLED):
        rng = np.random.default_rng(width * 1000 + 7)
        self.width, self.repeats = width, repeats
        self.steps = 3 * width
        self.bits = rng.integers(0, 1 << 63, (self.steps, repeats), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.picked = np.zeros((self.steps, repeats), bool)
        for r in range(repeats):
            self.picked[rng.choice(self.steps, min(sampled, self.steps), replace=False), r] = True
        self.last = int(np.flatnonzero(self.picked.any(1))[-1]) + 1

    def buckets(self, windows: np.ndarray) -> np.ndarray:
        """Bucket of every window (rows) in every repetition (columns)."""
        n = len(windows)
        padded = np.concatenate([windows, np.zeros((n, self.last + 1), np.uint64)], axis=1).ravel()
        stride = len(padded) // max(n, 1)
        at = np.repeat(np.arange(n) * stride, self.repeats).reshape(n, self.repeats)
        out = np.zeros((n, self.repeats), np.uint64)
        for t in range(self.last):
            letter = padded[at]
            if self.picked[t].any():
                out = np.where(self.picked[t], (out ^ (letter + np.uint64(t + 1))) * _ODD, out)
            at = at + ((letter * self.bits[t]) >> np.uint64(63)).astype(np.int64)
        return out


def fit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edits between ``item`` and any stretch of ``text``, and where it ends."""
    row = np.zeros(len(text) + 1, np.int64)
    steps = np.arange(len(text) + 1)
    for k, word in enumerate(item):
        new = np.minimum(row + 1, np.concatenate([[k + 1], row[:-1] + (text != word)]))
        row = np.minimum.accumulate(new - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


@dataclass
class Item:
    key: object
    words: np.ndarray
    edits: int
    need: int
    walks: Walks
    buckets: np.ndarray


def limit_of(n: int, similarity: float) -> int:
    return int(n * (1 - similarity) + 1e-9) if n >= EDIT_WORDS else 0


def repetitions(words: np.ndarray, edits: int, recall: float) -> int:
    """Repetitions that reach ``recall`` for this item at its full number of edits,
    from the measured share of repetitions that keep an edited item in its bucket."""
    if not edits:
        return 1
    rng = np.random.default_rng(len(words))
    changed = []
    for _ in range(24):
        w = list(words)
        for _ in range(edits):
            at, kind = int(rng.integers(0, len(w))), int(rng.integers(0, 3))
            if kind == 0:
                w[at] = np.uint64(rng.integers(1, 1 << 62))
            elif kind == 1 and len(w) > 1:
                del w[at]
            else:
                w.insert(at, np.uint64(rng.integers(1, 1 << 62)))
        changed.append(np.array((w + [np.uint64(0)] * len(words))[: len(words)], np.uint64))
    walks = Walks(len(words), MOST)
    with np.errstate(over="ignore"):
        kept = float((walks.buckets(np.array(changed)) == walks.buckets(words[None, :])).mean())
    return max(4, min(MOST, math.ceil(math.log(1 - recall) / math.log(1 - min(max(kept, 0.05), 0.99)))))


class Matcher:
    """Search of one block of items in texts; one per task."""

    def __init__(self, items: list[tuple[object, str]], repeats: dict[int, int], similarity: float):
        self.words = Words()
        self.items: list[Item] = []
        walks: dict[int, Walks] = {}
        short: dict[int, list] = {}
        with np.errstate(over="ignore"):
            for key, text in items:
                w = self.words.of(text)
                n = len(w)
                if n >= MIN_WORDS:
                    edits = limit_of(n, similarity)
                    walk = walks.setdefault(n, Walks(n, repeats.get(n, 4)))
                    self.items.append(Item(key, w, edits, max(1, n - 2 - 3 * edits), walk, walk.buckets(w[None, :])[0]))
                elif n:
                    short.setdefault(n, []).append((int(runs(w, n)[0]), key, w))
            pairs = [(g, k) for k, it in enumerate(self.items) for g in np.unique(grams(it.words))]
        #: Items under ``MIN_WORDS`` by length: sorted hashes, and (hash, key, words).
        self.short = {n: (np.array(sorted(x[0] for x in its), np.uint64), sorted(its, key=lambda x: x[0])) for n, its in short.items()}
        order = sorted(range(len(pairs)), key=lambda i: pairs[i][0])
        self.keys = np.array([pairs[i][0] for i in order], np.uint64)
        self.owner = np.array([pairs[i][1] for i in order], np.int64)
        self.needs = np.array([it.need for it in self.items], np.int64)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.keys & np.uint64((1 << 20) - 1)] = True

    def matches(self, text: str | None) -> list[tuple[object, int, int, int]]:
        """``(item, edits, words of the item, last word matched)`` of each item found."""
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()
        words = self.words.of(text)
        with np.errstate(over="ignore"):
            exact = self._exact(words)
            g = grams(words)
            at = np.flatnonzero(self.sieve[g & np.uint64((1 << 20) - 1)])
            if not len(at) or not len(self.keys):
                return exact
            lo, hi = np.searchsorted(self.keys, g[at], "left"), np.searchsorted(self.keys, g[at], "right")
            count = hi - lo
            if not count.any():
                return exact
            place = np.repeat(at, count)
            owner = self.owner[np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
            found = exact
            for k in np.flatnonzero(np.bincount(owner, minlength=len(self.items)) >= self.needs):
                best = self._verify(self.items[k], words, place[owner == k])
                if best:
                    found.append(best)
            return found

    def _exact(self, words: np.ndarray) -> list[tuple[object, int, int, int]]:
        """The items too short for edits whose words the text holds, at their first place."""
        found = []
        for n, (keys, items) in self.short.items():
            h = runs(words, n)
            lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
            done: set[int] = set()
            for p in np.flatnonzero(lo < hi):
                for k in range(lo[p], hi[p]):
                    if k not in done and (words[p : p + n] == items[k][2]).all():
                        done.add(k)
                        found.append((items[k][1], 0, n, int(p) + n))
                if len(done) == len(items):
                    break
        return found

    def _verify(self, item: Item, words: np.ndarray, hits: np.ndarray) -> tuple | None:
        w, d, need = len(item.words), item.edits, item.need
        first, last = hits[: len(hits) - need + 1], hits[need - 1 :]
        close = np.flatnonzero(last - first < w + d)
        best = None
        # ranges of possible starts, overlapping ones merged, cut to bounded pieces
        los, his = np.maximum(0, last[close] + 3 - w - d), np.minimum(first[close] + d, len(words) - 1)
        fine = los <= his
        los, his = los[fine], np.maximum.accumulate(his[fine])
        new = np.flatnonzero(np.concatenate([[True], los[1:] > his[:-1] + 1])) if len(los) else []
        ends = np.append(new[1:], len(los)) if len(los) else []
        for k, e in zip(new, ends):
            for lo in range(int(los[k]), int(his[e - 1]) + 1, PIECE):
                hi = min(lo + PIECE - 1, int(his[e - 1]))
                padded = np.concatenate([words[lo : hi + w], np.zeros(w, np.uint64)])
                windows = np.lib.stride_tricks.sliding_window_view(padded, w)[: hi - lo + 1]
                if (item.walks.buckets(windows) == item.buckets).any():
                    edits, end = fit_distance(item.words, words[max(0, lo - d) : hi + w + d])
                    if edits <= d and (best is None or edits < best[1]):
                        best = (item.key, edits, w, max(0, lo - d) + end)
        return best


def _matcher(block, similarity: float) -> Matcher:
    """The matcher of a broadcast block, built once per worker."""
    items, repeats = block.value
    return worker_slot(("leaks", tuple(items), similarity), lambda: Matcher(items, repeats, similarity))


def _blocks(benchmark: DataFrame, item_id: str, text: str, similarity: float, recall: float):
    """Items and repetitions, block by block; a block's size is bounded."""
    b = benchmark.select(F.col(item_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    for k in range(n):
        part = b.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else b
        items = [(r["id"], r["text"]) for r in part.collect()]
        words, repeats = Words(), {}
        with np.errstate(over="ignore"):
            for _, t in items:
                w = words.of(t)
                if len(w) >= MIN_WORDS and len(w) not in repeats:
                    repeats[len(w)] = repetitions(w, limit_of(len(w), similarity), recall)
        yield items, repeats


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL,
) -> DataFrame:
    """Rows ``(doc_id, item_id, edits, item_words, last_word)``: an item found in a
    text within its edit limit, at its best place.

    Words compare without case and punctuation.  Null or empty texts and items
    match nothing; items under six words match without edits, those under four by
    their word sequence alone.  Ids may be null or repeated: each document row and each item row is
    answered.  Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    kinds = dict(docs.dtypes)[doc_id], dict(benchmark.dtypes)[item_id]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, edits long, item_words long, last_word long"
    id_type = to_arrow_schema(StructType([benchmark.schema[item_id]])).field(0).type
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = None
    for items, repeats in _blocks(benchmark, item_id, item_text, similarity, recall):
        block = spark.sparkContext.broadcast((items, repeats))

        def search(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(block, similarity)
            for batch in batches:
                at, found = [], []
                for k, t in enumerate(batch.column(1)):
                    for m in matcher.matches(t.as_py()):
                        at.append(k)
                        found.append(m)
                if found:
                    item, edits, size, last = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), pa.array(item, id_type), *[pa.array(c, pa.int64()) for c in (edits, size, last)]],
                        names=["doc_id", "item_id", "edits", "item_words", "last_word"],
                    )

        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    similarity: float = SIMILARITY, recall: float = RECALL,
) -> DataFrame:
    """The rows of ``docs``, columns unchanged, in whose text no item is found."""
    at = docs.columns.index(text)
    for items, repeats in _blocks(benchmark, item_id, item_text, similarity, recall):
        block = docs.sparkSession.sparkContext.broadcast((items, repeats))

        def keep(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(block, similarity)
            for batch in batches:
                yield batch.filter(pa.array([not matcher.matches(t.as_py()) for t in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
