"""Exact removal of long repeated byte strings by blockwise suffix sorting.

Suffixes matter up to ``width`` bytes.  A difference cover of period ``v`` marks
a few positions of every text such that for any two positions some offset below
``v`` puts both on marks.  The marks' strings of ``width - v + 1`` bytes are ranked
first (equal strings, equal rank); a suffix all of whose marks have a rank of their
own ties with nothing for ``width`` bytes and needs no sorting.  The other suffixes
are sorted one block at a time, so the entries on disk at once are bounded by a
share of the text, and inside a block in parts of bounded size per task.

Entries travel packed (64-bit hash of the string, text, position), and a string
that repeats inside one task's share is sent twice at most; its other places are
known to repeat on the spot.  Equal strings are told by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import discard, prepare, written

WIDTH = 200
# A perfect difference set modulo 133.
PERIOD = 133
COVER = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)
#: Bytes hashed at once, entries of a flush, entries of a part, and the share of
#: the text's bytes whose suffixes are sorted in one block.
CHUNK, FLUSH, PART, SHARE = 1 << 18, 1 << 21, 1 << 20, 1 / 10

_ODD = np.uint64(0x9E3779B97F4A7C15)


def string_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of the ``width`` bytes at each position that has them, built
    from hashes of 1, 2, 4, ... bytes."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    level = (data.astype(np.uint64) + np.uint64(1)) * _ODD
    out, done, k = np.zeros(n, np.uint64), 0, 1
    while True:
        if width & k:
            out *= np.uint64(0xBF58476D1CE4E5B9)
            out ^= out >> np.uint64(31)
            out += level[done : done + n]
            done += k
        if 2 * k > width:
            break
        nxt = level[:-k] * np.uint64(0x94D049BB133111EB + 2 * k)
        nxt ^= nxt >> np.uint64(29)
        nxt += level[k:]
        level, k = nxt, 2 * k
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out * _ODD


def pack(tids: np.ndarray, counts: np.ndarray, pos: np.ndarray, hashes: np.ndarray) -> bytes:
    head = np.array([len(tids), len(pos)], np.int64).tobytes()
    return head + tids.astype(np.int64).tobytes() + counts.astype(np.uint32).tobytes() + pos.astype(np.uint32).tobytes() + hashes.tobytes()


def unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    docs, n = np.frombuffer(blob, np.int64, 2)
    at = 16
    tids = np.frombuffer(blob, np.int64, docs, at)
    counts = np.frombuffer(blob, np.uint32, docs, at + 8 * docs)
    pos = np.frombuffer(blob, np.uint32, n, at + 12 * docs)
    hashes = np.frombuffer(blob, np.uint64, -1, at + 12 * docs + 4 * n) if len(blob) > at + 12 * docs + 4 * n else np.zeros(0, np.uint64)
    return np.repeat(tids, counts), pos, hashes


#: Texts whose places travel in one row: ``2 ** BUCKET``.
BUCKET = 9


def _by_bucket(tids: np.ndarray, pos: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Places packed by bucket of texts."""
    order = np.argsort(tids, kind="stable")
    tids, pos = tids[order], pos[order]
    names, out = [], []
    if len(tids):
        edge = np.concatenate([[0], np.flatnonzero(np.diff(tids >> BUCKET)) + 1, [len(tids)]])
        for lo, hi in zip(edge[:-1], edge[1:]):
            t = tids[lo:hi]
            new = np.concatenate([[0], np.flatnonzero(np.diff(t)) + 1])
            names.append(int(t[0]) >> BUCKET)
            out.append(pack(t[new], np.diff(np.append(new, len(t))), pos[lo:hi], np.zeros(0, np.uint64)))
    return names, out


def _places(found: DataFrame, as_runs: bool = False) -> DataFrame:
    """Rows ``(tid, pos)``: all packed positions found in each text, or the starts
    and ends (exclusive) of their runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blobs in batch.column(0):
                tids, pos = (np.concatenate(x) for x in list(zip(*(unpack(b.as_py()) for b in blobs)))[:2])
                order = np.lexsort((pos, tids)) if as_runs else np.argsort(tids, kind="stable")
                tids, pos = tids[order], pos[order].astype(np.uint32)
                if as_runs:
                    new = np.concatenate([[True], (np.diff(tids) != 0) | (np.diff(pos.astype(np.int64)) > 1)])
                    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(pos) - 1]])
                    tids, pos = tids[new], np.stack([pos[new], pos[last] + np.uint32(1)], axis=1)
                cut = np.flatnonzero(np.diff(tids)) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tids[np.concatenate([[0], cut])]), pa.array([p.tobytes() for p in np.split(pos, cut)], pa.binary())], names=["tid", "pos"])

    return found.groupBy("bucket").agg(F.collect_list("pos").alias("pos")).select("pos").mapInArrow(run, "tid long, pos binary")


ROWS = "part long, blob binary, bucket long, pos binary"


class Sender:
    """Collects entries and gives them out packed by part."""

    def __init__(self, parts: int):
        self.parts, self.held, self.size = parts, [], 0

    def add(self, tid: int, pos: np.ndarray, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(pos):
            self.held.append((tid, pos, hashes))
            self.size += len(pos)
            if self.size >= FLUSH:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        tids = np.repeat(np.array([t for t, _, _ in self.held], np.int64), [len(p) for _, p, _ in self.held])
        pos = np.concatenate([p for _, p, _ in self.held])
        hashes = np.concatenate([h for _, _, h in self.held])
        self.held, self.size = [], 0
        order = np.argsort(hashes, kind="stable")
        h = hashes[order]
        third = np.zeros(len(h), bool)
        third[2:] = (h[2:] == h[1:-1]) & (h[2:] == h[:-2])
        known = order[third]
        send = np.sort(order[~third])
        part = ((hashes[send] >> np.uint64(32)) * np.uint64(self.parts) >> np.uint64(32)).astype(np.int64)
        send = send[np.argsort(part, kind="stable")]
        cuts = np.cumsum(np.bincount(part, minlength=self.parts))
        names, blobs, lo = [], [], 0
        for p, hi in enumerate(cuts):
            if hi > lo:
                at = send[lo:hi]
                t = tids[at]
                new = np.concatenate([[0], np.flatnonzero(np.diff(t)) + 1])
                names.append(p)
                blobs.append(pack(t[new], np.diff(np.append(new, len(t))), pos[at], hashes[at]))
            lo = hi
        own, places = _by_bucket(tids[known], pos[known])
        # what is known travels with some part, so that one pass answers all
        yield pa.RecordBatch.from_arrays([
            pa.array(names + [t % self.parts for t in own], pa.int64()), pa.array(blobs + [None] * len(own), pa.binary()),
            pa.array([None] * len(names) + own, pa.int64()), pa.array([None] * len(names) + places, pa.binary()),
        ], names=["part", "blob", "bucket", "pos"])


def _pieces(data: bytes, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """The text in overlapping pieces; every string of ``width`` bytes lies in one."""
    for base in range(0, max(1, len(data) - width + 1), CHUNK):
        yield base, np.frombuffer(data, np.uint8, min(len(data) - base, CHUNK + width - 1), base)


def _repeated(entries: DataFrame) -> DataFrame:
    """Rows ``(bucket, pos)``: packed places whose string occurs elsewhere too."""
    def find(table: pa.Table) -> pa.Table:
        known = table.filter(table.column("bucket").is_valid()).select(["bucket", "pos"])
        blobs = [unpack(b.as_py()) for b in table.column("blob") if b.is_valid]
        if not blobs:
            return known
        tids, pos, hashes = (np.concatenate(x) for x in zip(*blobs))
        order = np.argsort(hashes, kind="stable")
        h = hashes[order]
        same = h[1:] == h[:-1]
        hit = np.zeros(len(h), bool)
        hit[1:] |= same
        hit[:-1] |= same
        own, places = _by_bucket(tids[order[hit]], pos[order[hit]])
        found = pa.Table.from_arrays([pa.array(own, pa.int64()), pa.array(places, pa.binary())], names=["bucket", "pos"])
        return pa.concat_tables([known, found.cast(known.schema)])

    return entries.groupBy("part").applyInArrow(find, "bucket long, pos binary")


def _entries(texts: DataFrame, columns: list[str], parts: int, take: Callable) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(parts)
        with np.errstate(over="ignore"):
            for batch in batches:
                for row in zip(*batch.columns):
                    for tid, pos, hashes in take(*row):
                        yield from sender.add(tid, pos, hashes)
            yield from sender.flush()

    return texts.select(*columns).mapInArrow(run, ROWS)


def runs_of(marked: np.ndarray) -> np.ndarray:
    """Starts and ends (exclusive) of the runs of true values, one pair per row."""
    edge = np.diff(np.concatenate([[0], marked.view(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the
    bytes that stay) and ``spans`` (removed runs, packed 64-bit starts and ends).

    A byte goes if a string of ``width`` bytes over it starts anywhere else too, in
    any document, itself included; strings are judged on the input.  Null texts
    count as empty; ids may be null or repeated, each row counts as a document of
    its own; an empty table gives no rows; other columns are not read.
    ``width`` must exceed the cover's period.
    """
    spark = prepare(docs.sparkSession)
    kind = dict(docs.dtypes)[doc_id]
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    cover = np.tile(cover, (CHUNK + width) // PERIOD + 2)
    short = width - PERIOD + 1
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    key = F.unhex(F.sha2("text", 256)).alias("key")
    copies = rows.where(F.octet_length("text") >= width).select(key, "text").groupBy("key").agg(
        F.any_value("text").alias("text"), F.count("*").alias("copies")
    )
    texts = written(copies.withColumn("tid", F.monotonically_increasing_id()), "texts")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts_for = lambda n: max(1, slots, -(-int(n) // PART))

    def marks(tid: pa.Scalar, t: pa.Scalar) -> Iterator[tuple]:
        data = t.as_py().encode("utf-8", "surrogatepass")
        for base, piece in _pieces(data, short):
            at = np.flatnonzero(cover[base % PERIOD :][: max(0, len(piece) - short + 1)])
            yield tid.as_py(), at + base, string_hashes(piece, short)[at]

    ranks = written(_repeated(_entries(texts, ["tid", "text"], parts_for(total * len(COVER) / PERIOD), marks)), "ranks")
    ranked = written(_places(ranks), "marks")
    discard(ranks)

    def open_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            opened, count = [], []
            for t, pos in zip(batch.column(1), batch.column(2)):
                n = len(t.as_py().encode("utf-8", "surrogatepass"))
                hit = np.zeros(n + PERIOD + 1, np.int32)
                hit[np.frombuffer(pos.as_buffer(), np.uint32) + 1] = 1
                hit = np.cumsum(hit)
                runs = runs_of(hit[PERIOD : PERIOD + n - width + 1] > hit[: n - width + 1])
                opened.append(runs.tobytes())
                count.append(int((runs[:, 1] - runs[:, 0]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(opened, pa.binary()), pa.array(count, pa.int64())],
                                             names=["tid", "text", "open", "n"])

    tied = written(texts.select("tid", "text").join(ranked, "tid").mapInArrow(open_suffixes, "tid long, text string, open binary, n long").where("n > 0"), "tied")
    discard(ranked)
    n_open = tied.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-int(n_open) // max(1, int(total * SHARE))))
    found, ties = None, []
    for block in range(blocks):
        def suffixes(tid: pa.Scalar, t: pa.Scalar, runs: pa.Scalar, block: int = block) -> Iterator[tuple]:
            data = t.as_py().encode("utf-8", "surrogatepass")
            for start, end in np.frombuffer(runs.as_buffer(), np.int64).reshape(-1, 2):
                for base in range(start, end, CHUNK):
                    piece = np.frombuffer(data, np.uint8, min(end - base, CHUNK) + width - 1, base)
                    hashes = string_hashes(piece, width)
                    at = np.flatnonzero(hashes % np.uint64(blocks) == block) if blocks > 1 else np.arange(len(hashes))
                    yield tid.as_py(), at + base, hashes[at]

        one = written(_repeated(_entries(tied, ["tid", "text", "open"], parts_for(n_open / blocks), suffixes)), "ties")
        found = one if found is None else found.unionByName(one)
        ties.append(one)
    discard(tied)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, spans, kept = [], [], [], []
            for t, copies, pos in zip(*batch.columns[1:]):
                data = np.frombuffer(t.as_py().encode("utf-8", "surrogatepass"), np.uint8)
                gone = np.ones(len(data), bool)
                if copies.as_py() < 2:
                    step = np.zeros(len(data) + 1, np.int32)
                    if pos.is_valid:
                        runs = np.frombuffer(pos.as_buffer(), np.uint32).reshape(-1, 2)
                        np.add.at(step, runs[:, 0], 1)
                        np.add.at(step, runs[:, 1] + np.uint32(width - 1), -1)
                    gone = np.cumsum(step)[:-1] > 0
                runs = runs_of(gone)
                size.append(len(data))
                removed.append(int(gone.sum()))
                spans.append(runs.tobytes())
                kept.append(data[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.binary()), pa.array(kept, pa.binary())],
                names=["key", "n_bytes", "n_removed", "spans", "kept"])

    judged = texts.join(_places(found, as_runs=True), "tid", "left").select("key", "text", "copies", "pos").mapInArrow(
        judge, "key binary, n_bytes long, n_removed long, spans binary, kept binary")
    judged = written(judged.where("n_removed > 0"), "judged")
    discard(texts, *ties)
    return rows.select("doc_id", key, "text").join(judged, "key", "left").select(
        F.col("doc_id").cast(kind), F.coalesce("n_bytes", F.octet_length("text").cast("long")).alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.floor(F.coalesce(F.octet_length("spans"), F.lit(0)) / 16).cast("long").alias("n_spans"),
        F.coalesce("kept", F.encode("text", "UTF-8")).alias("kept"), F.coalesce("spans", F.lit(b"")).alias("spans"),
    )


def dedup_report(docs: DataFrame) -> DataFrame:
    """Digest per document of :func:`repeated_spans`."""
    return repeated_spans(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

