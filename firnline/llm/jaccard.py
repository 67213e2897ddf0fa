"""Exact Jaccard join of documents over word n-grams (universe partition).

A pair with ``100 * |A & B| >= t * |A | B|`` differs in at most
``H = (|A| + |B|) * (100 - t) / (100 + t)`` shingles.  For each size band the
hash range is cut into somewhat more than ``H + 1`` segments, and a set indexes the
``H + 1`` of them that come first by size and key.  Of the linked pair's set whose
last indexed segment ranks higher, one indexed segment is equal in the other
(pigeonhole), and ranks high enough there to be indexed too.  So empty and small
segments, which unlike sets share, are not indexed.  Where equal segments are
costly, allocation by cost skips the costliest and lets the cheapest differ by one
shingle instead (its one-deletion neighbourhood is indexed), which keeps the sum of
allowances.

Only connectivity is asked for, so buckets emit no pairs of all members: members
meet two members of their bucket first; the links found give components; then only
members of different components meet, behind lossless filters (sizes, and the
parity of shingles per hash range).  Every link between different components is
thus verified on whole sets.  Sets compare by 64-bit shingle hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firnline.llm.common import components, discard, prepare, written

#: Growth of the size bands, segments per one needed, cost of a candidate in index rows.
BAND, SPARE, CANDIDATE_COST = 1.25, 1.3, 4.0
#: 64-bit words of the parity filter.
PARITY = 8

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread of 64-bit values, even in their high bits."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class Shingles(dict):
    """Sorted distinct hashes of a text's n-word shingles; words end at ASCII white
    space, A-Z count as a-z."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self) > 1_000_000:
            self.clear()
        w = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        size = min(self.n, len(w))
        x = np.full(len(w) - size + 1, size, np.uint64)
        for k in range(size):
            x = mix(x * _A + w[k : len(w) - size + 1 + k])
        x.sort()
        keep = np.ones(len(x), bool)
        np.not_equal(x[1:], x[:-1], out=keep[1:])
        return x[keep]


def bands(largest: int, growth: float = BAND) -> list[tuple[int, int]]:
    """Least and greatest size of each band up to ``largest``."""
    out, lo = [], 1
    while lo <= largest:
        hi = max(lo, int(lo * growth))
        out.append((lo, hi))
        lo = hi + 1
    return out


class Plan:
    """Segments of the size bands for a threshold in hundredths."""

    def __init__(self, percent: int, growth: float = BAND):
        self.percent, self.growth = percent, growth
        self.known: list[tuple[int, int]] = []

    def band_of(self, n: int) -> int:
        if not self.known or self.known[-1][1] < n:
            self.known = bands(2 * n, self.growth)
        return int(np.searchsorted([hi for _, hi in self.known], n))

    def difference(self, a: int, b: int) -> int:
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def segments(self, band: int) -> int:
        hi = self.known[band][1]
        most = self.difference(hi, hi * 100 // self.percent)
        return math.ceil(SPARE * (most + 1)) if most else 1

    def needed(self, n: int, band: int) -> int:
        """Segments a set of ``n`` indexes: one more than it may differ from a partner
        where the smaller of the two is of the band."""
        smaller = min(n, self.known[band][1])
        return self.difference(smaller, max(n, smaller * 100 // self.percent)) + 1

    def chosen(self, keys: np.ndarray, ends: np.ndarray, count: int, but: np.ndarray | None = None) -> np.ndarray:
        """The first ``count`` segments by size and key, without those in ``but``."""
        rank = np.lexsort((keys, ends[:-1] - ends[1:]))
        if but is not None:
            rank = rank[~np.isin(rank, but)]
        return np.sort(rank[: max(count, 0)])

    def posted(self, n: int) -> list[int]:
        """Bands whose smaller partner a set of ``n`` may have."""
        top = self.band_of(n)
        low = self.band_of(max(1, -(-n * self.percent // 100)))
        return [b for b in range(low, top + 1) if self.segments(b) > 1]

    def signatures(self, x: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the segments in the sorted hashes, and the sum of each segment."""
        m = self.segments(band)
        edges = (np.arange(1, m, dtype=object) * (1 << 64) // m).astype(np.uint64)
        ends = np.concatenate([[0], np.searchsorted(x, edges), [len(x)]])
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        return ends, total[ends[1:]] - total[ends[:-1]]

    @staticmethod
    def key(sums: np.ndarray, band: int, segment: np.ndarray) -> np.ndarray:
        return mix(sums * _A + np.uint64(band << 32) + segment.astype(np.uint64)).astype(np.int64)


def _parity(x: np.ndarray) -> np.ndarray:
    bits = np.bincount((x >> np.uint64(64 - 6 - PARITY.bit_length() + 1)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


_LISTS = pa.list_(pa.int64())


def _sets(docs: DataFrame, doc_id: str, text: str, n: int, percent: int) -> DataFrame:
    """Per row: id, hash of its text, fingerprint and size of its set, parity, and the
    keys of its segments (once per set and task)."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, plan = Shingles(n), Plan(percent)
        seen: set[tuple] = set()
        with np.errstate(over="ignore"):
            for batch in batches:
                rows = []
                for t in batch.column(2):
                    x = shingles.of(t.as_py())
                    f1 = int(mix(x + _A).sum(dtype=np.uint64).astype(np.int64)) if len(x) else 0
                    f2 = int(mix(x ^ _C).sum(dtype=np.uint64).astype(np.int64)) if len(x) else 0
                    keys, codes, at = [], [], []
                    if (f1, f2) not in seen:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add((f1, f2))
                        for band in plan.posted(len(x)) if len(x) else []:
                            ends, sums = plan.signatures(x, band)
                            key = plan.key(sums, band, np.arange(len(sums)))
                            pick = plan.chosen(key, ends, plan.needed(len(x), band))
                            keys.append(key[pick])
                            codes.append(pick + (band << 32))
                            at.append((band, len(sums)))
                    none = np.zeros(0, np.int64)
                    rows.append((f1, f2, len(x), _parity(x), np.concatenate([none, *keys]), np.concatenate([none, *codes]), [v for p in at for v in p]))
                f1, f2, size, parity, keys, codes, at = zip(*rows) if rows else ((),) * 7
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(size, pa.int64()),
                     *[pa.array([p[k] for p in parity], pa.int64()) for k in range(PARITY)],
                     pa.array(keys, _LISTS), pa.array(codes, _LISTS), pa.array(at, _LISTS)],
                    names=["doc_id", "th", "f1", "f2", "n", *[f"p{k}" for k in range(PARITY)], "keys", "codes", "at"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("text"))
    parity = ", ".join(f"p{k} long" for k in range(PARITY))
    return rows.mapInArrow(run, f"doc_id {kind}, th long, f1 long, f2 long, n long, {parity}, keys array<long>, codes array<long>, at array<long>")


def _nodes(sets: DataFrame) -> DataFrame:
    """One row per distinct non-empty set.  ``node`` is ``f1``; sets that share it by
    chance get numbers of their own."""
    one = sets.where("n > 0").groupBy("f1", "f2").agg(
        F.min("doc_id").alias("least_id"), F.min("n").alias("n"), F.min("th").alias("th"), *[F.min(f"p{k}").alias(f"p{k}") for k in range(PARITY)]
    )
    twins = F.count("*").over(Window.partitionBy("f1"))
    return one.withColumn("node", F.when(twins > 1, F.xxhash64("f1", "f2")).otherwise(F.col("f1")))


def allocation(costs: DataFrame) -> DataFrame:
    """Allowance per ``(band, segment)``: -1 skipped, 0 equal, 1 one shingle apart.

    ``costs`` has ``band, segment, equal`` (cost of its candidates) and ``near``
    (cost of indexing and probing its one-deletion neighbourhood).  The k-th
    costliest segment is skipped and the k-th cheapest widened where that is
    cheaper; the sum of allowances, hence the guarantee, stays.
    """
    hot = Window.partitionBy("band").orderBy(F.desc("equal"), "segment")
    cold = Window.partitionBy("band").orderBy("near", F.desc("segment"))
    ranked = costs.select("*", F.row_number().over(hot).alias("hot"), F.row_number().over(cold).alias("cold"))
    h = ranked.select("band", F.col("segment").alias("skip"), F.col("equal").alias("saved"), F.col("hot").alias("rank"))
    c = ranked.select("band", F.col("segment").alias("widen"), (F.col("near") - F.col("equal")).alias("paid"), F.col("cold").alias("rank"), F.col("hot").alias("own"))
    count = ranked.groupBy("band").agg(F.count("*").alias("of"))
    swaps = h.join(c, ["band", "rank"]).join(count, "band").where("saved > paid and 2 * rank <= of and own > rank and 2 * own > of")
    # a swap counts only if its partner is not skipped itself, which the halves ensure
    skipped = swaps.select("band", F.col("skip").alias("segment"), F.lit(-1).alias("allow"))
    widened = swaps.select("band", F.col("widen").alias("segment"), F.lit(1).alias("allow"))
    kept = {"band": "band", "segment": "segment"}
    return skipped.union(widened).select(*kept, "allow")


def _postings(sets: DataFrame) -> DataFrame:
    """Rows ``(key, f1, band, segment)``."""
    flat = sets.where(F.size("keys") > 0).select("f1", F.inline(F.arrays_zip("keys", "codes")).alias("key", "code"))
    return flat.select("key", "f1", F.shiftright("code", 32).alias("band"), F.col("code").bitwiseAND(0xFFFFFFFF).alias("segment"))


def _widened(docs: DataFrame, text: str, n: int, percent: int, allow: dict[tuple[int, int], int]) -> DataFrame:
    """Keys ``(key, f1)`` of the bands with an allocation: equal segments, chosen from
    those neither skipped nor widened, and one-deletion neighbourhoods of widened ones,
    each of which stands for two equal ones."""
    wide: dict[int, list[int]] = {}
    off: dict[int, list[int]] = {}
    for (band, segment), a in allow.items():
        (wide if a == 1 else off).setdefault(band, []).append(segment)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, plan = Shingles(n), Plan(percent)
        with np.errstate(over="ignore"):
            for batch in batches:
                for t in batch.column(0):
                    x = shingles.of(t.as_py())
                    f1 = int(mix(x + _A).sum(dtype=np.uint64).astype(np.int64)) if len(x) else 0
                    out = []
                    for band in plan.posted(len(x)) if len(x) else []:
                        if band not in wide and band not in off:
                            continue
                        near = wide.get(band, [])
                        ends, sums = plan.signatures(x, band)
                        key = plan.key(sums, band, np.arange(len(sums)))
                        but = np.array([*near, *off.get(band, [])], np.int64)
                        out.append(key[plan.chosen(key, ends, plan.needed(len(x), band) - 2 * len(near), but)])
                        out.append(key[near])
                        for s in near:
                            out.append(plan.key(sums[s] - x[ends[s] : ends[s + 1]], band, np.array([s])))
                    if out:
                        keys = np.unique(np.concatenate(out))
                        yield pa.RecordBatch.from_pydict({"key": keys, "f1": np.full(len(keys), f1, np.int64)})

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "key long, f1 long")


def _differ(a: str, b: str) -> Column:
    bits = F.lit(0)
    for k in range(PARITY):
        bits = bits + F.bit_count(F.col(f"{a}.p{k}").bitwiseXOR(F.col(f"{b}.p{k}")))
    return bits


def _may_link(a: str, b: str, percent: int) -> Column:
    """True for every linked pair: sizes close enough, no more parities apart than
    shingles may differ."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (
        (na * percent <= nb * 100) & (nb * percent <= na * 100)
        & (_differ(a, b) * (100 + percent) <= (na + nb) * (100 - percent))
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                same = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                good.append(100 * same >= percent * (len(p) + len(q) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
    )
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def similar_sets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90,
    candidate_cost: float = CANDIDATE_COST,
) -> tuple[DataFrame, DataFrame]:
    """Per row ``(doc_id, th, n, f1, f2)`` and per distinct set ``(f1, f2, label,
    component_id)``; see :func:`jaccard_components`."""
    prepare(docs.sparkSession)
    sets = written(_sets(docs, doc_id, text, n, percent), "sets")
    nodes = written(_nodes(sets), "nodes")
    postings = _postings(sets)
    ends = written(
        postings.groupBy("key").agg(
            F.min("f1").alias("lo"), F.max("f1").alias("hi"), F.count("*").alias("members"), F.min("band").alias("band"), F.min("segment").alias("segment")
        ).where("lo < hi"), "buckets",
    )
    # cost of equal segments against that of their one-deletion neighbourhoods
    sizes = sets.where(F.size("keys") > 0).select(F.explode(F.array(
        F.struct(F.col("at")[0].alias("band"), F.col("n").alias("n"), F.col("at")[1].alias("m")),
        F.struct(F.get("at", F.lit(2)).alias("band"), F.col("n").alias("n"), F.get("at", F.lit(3)).alias("m")),
    )).alias("s")).where("s.band is not null").groupBy("s.band").agg(F.sum(F.col("s.n") / F.col("s.m")).alias("rows"))
    costs = (
        ends.groupBy("band", "segment").agg(F.sum("members").alias("c")).join(sizes, "band")
        .select("band", "segment", (F.col("c") * candidate_cost).alias("equal"), (F.col("rows") + F.col("c") * candidate_cost).alias("near"))
    )
    allow = {(r["band"], r["segment"]): r["allow"] for r in allocation(costs).collect()}
    if allow:
        keys = postings.where(~F.col("band").isin(sorted({band for band, _ in allow}))).select("key", "f1")
        keys = written(keys.union(_widened(docs, text, n, percent, allow)), "postings")
        ends = written(keys.groupBy("key").agg(F.min("f1").alias("lo"), F.max("f1").alias("hi")).where("lo < hi"), "buckets")
    else:
        keys = postings.select("key", "f1")
    parity = [f"p{k}" for k in range(PARITY)]
    members = written(keys.join(ends.select("key", "lo", "hi"), "key").distinct(), "members")
    # every member against the first and the last of its bucket
    first = members.select(F.col("f1").alias("b"), F.explode(F.array("lo", "hi")).alias("a")).where("a <> b")
    first = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = nodes.select("f1", "node", "n", *parity)
    first = written(
        first.alias("p").join(side.alias("x"), F.col("p.a") == F.col("x.f1")).join(side.alias("y"), F.col("p.b") == F.col("y.f1"))
        .where(_may_link("x", "y", percent)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), "pairs",
    )
    whole = _whole(docs, doc_id, text, n, nodes, first)
    links = written(_verified(first, whole, percent), "links")
    discard(whole)
    labels = components(links)
    # then only members of different components
    named = (
        members.select("key", "f1").join(side, "f1").join(labels, "node", "left")
        .select("key", "node", "n", *parity, F.coalesce("label", "node").alias("label"))
    )
    named = written(named, "named")
    discard(members, ends)
    mixed = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    open_ = named.join(mixed, "key", "left_semi")
    rest = (
        open_.alias("x").join(open_.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node"))
                              & (F.col("x.label") != F.col("y.label")) & _may_link("x", "y", percent))
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
        .join(first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    )
    rest = written(rest, "pairs")
    discard(named, first)
    whole = _whole(docs, doc_id, text, n, nodes, rest)
    more = written(_verified(rest, whole, percent), "links")
    discard(whole, rest)
    labels = components(links.unionByName(more)) if more.limit(1).count() else labels
    placed = nodes.join(labels, "node", "left").select("f1", "f2", "least_id", F.coalesce("label", "node").alias("label"))
    least = placed.groupBy("label").agg(F.min("least_id").alias("component_id"))
    rows = written(sets.select("doc_id", "th", "n", "f1", "f2"), "rows")
    discard(sets)
    return rows, placed.select("f1", "f2", "label").join(least, "label")


def _whole(docs: DataFrame, doc_id: str, text: str, n: int, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows ``(node, set)`` of the sets in ``pairs``, from one text of each."""
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = nodes.join(needed, "node", "left_semi").select("node", "f1", "f2", "th")
    texts = docs.select(F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("text"))
    found = wanted.join(texts, "th").groupBy("node", "f1", "f2").agg(F.any_value("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(n)
        with np.errstate(over="ignore"):
            for batch in batches:
                sets = [shingles.of(t.as_py()).tobytes() for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "set"])

    return written(found.select("node", "text").mapInArrow(run, "node long, set binary"), "whole")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90, **how) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their
    distinct n-word shingles; ``component_id`` is the smallest id reachable.  Null
    and word-less texts link with nothing and stand for themselves; shorter texts
    count as one shingle; null ids stand for themselves unless a document with an id
    is reachable; repeated rows are each answered; an empty table gives no rows;
    other columns are not read.
    """
    rows, sets = similar_sets(docs, doc_id, text, n, percent, **how)
    return rows.join(sets, ["f1", "f2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def keep_one_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs``, columns unchanged, one per component: the one with the
    smallest id (nulls last), then the smallest hash of its text; equal rows of that
    rank count once.  Rows without words all stay."""
    rows, sets = similar_sets(docs, doc_id, text, n, percent)
    ranked = rows.where("n > 0").join(sets, ["f1", "f2"])
    best = ranked.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("best"))
    # the id as text and whether it is null: plain keys, so that finding and
    # counting equal rows once share one exchange
    plain_id = lambda c: [c.isNull().alias("_no_id"), F.coalesce(c.cast("string"), F.lit("")).alias("_id")]
    best = written(best.select(F.col("best.th").alias("_th"), *plain_id(F.col("best.doc_id"))), "best")
    discard(rows)
    names = docs.columns
    whole = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), F.xxhash64(docs[text]).alias("_th"), *plain_id(docs[doc_id]))
    blank = ~F.coalesce(F.col(f"_row.`{text}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    keys = ["_th", "_no_id", "_id"]
    chosen = whole.where(~blank).join(best, keys, "left_semi").dropDuplicates(keys)
    return chosen.select("_row").unionByName(whole.where(blank).select("_row")).select(*[F.col(f"_row.`{c}`").alias(c) for c in names])
