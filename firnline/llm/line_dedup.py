"""Incremental, reversible line dedup over sharded cuckoo filters and exact counts.

A store keeps, in the shared folder and as ordinary tables, what has been inserted:

* *references*: one row per document and distinct long line;
* *counts*: exact changes of the number of documents that hold a line, one row per
  line and insertion or deletion; a line's count is the sum of its changes;
* *filters*: one cuckoo filter per shard of the lines' hashes, with every line
  whose count is above zero.

An insertion asks the filters which of its lines may be known.  What a filter does
not hold is certainly new; the rest alone is looked up in the exact counts, and a
line that a filter took for another one enters it as well, so that deletions stay
exact.  A line never met again has one row of counts, which is not summed.  A
deletion takes its documents' references away, lowers the counts and takes lines
that nobody holds any more out of the filters, which Bloom filters could not do.
Inserting and deleting the same documents leaves the answers as they were.

Every step appends a table or writes a new one; the old one stays until the new
one is complete, so a lost executor costs a task, not the store.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.llm.common import discard, prepare, written

#: White space stripped at both ends of a line.
SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 20, 3
#: Lines expected in a shard: sizes a task's filter (two to three bytes a line).
SHARD_LINES = 1 << 18
#: Lines held by more than one reference in so many are heavy: at most that many exist.
HEAVY = 10_000
#: Documents turned into rows at once.
ROWS = 256


class Cuckoo:
    """Cuckoo filter over 64-bit hashes; grows by further layers when full."""

    SLOTS, KICKS, MARKS = 4, 200, 0xFFFF

    def __init__(self, expected: int = 1 << 10):
        self.buckets = 1 << max(4, (max(1, int(expected / 0.9 / self.SLOTS)) - 1).bit_length())
        self.layers = [array("H", bytes(2 * self.SLOTS * self.buckets))]

    @classmethod
    def of(cls, packed: bytes) -> Cuckoo:
        self = cls.__new__(cls)
        self.buckets = int.from_bytes(packed[:8], "little")
        slots, size = array("H", packed[8:]), cls.SLOTS * self.buckets
        self.layers = [slots[i : i + size] for i in range(0, len(slots), size)]
        return self

    def packed(self) -> bytes:
        return self.buckets.to_bytes(8, "little") + b"".join(x.tobytes() for x in self.layers)

    def _places(self, h: int) -> tuple[int, int, int]:
        mark = (h >> 48) & self.MARKS or 1
        one = h & (self.buckets - 1)
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (self.buckets - 1)

    def __contains__(self, h: int) -> bool:
        mark, one, two = self._places(h)
        one, two = one * 4, two * 4
        for layer in self.layers:
            if mark in layer[one : one + 4] or mark in layer[two : two + 4]:
                return True
        return False

    def add(self, h: int) -> None:
        mark, one, two = self._places(h)
        layer = self.layers[-1]
        for bucket in (one, two):
            for slot in range(bucket * 4, bucket * 4 + 4):
                if not layer[slot]:
                    layer[slot] = mark
                    return
        trail, bucket = [], two
        for kick in range(self.KICKS):
            slot = bucket * 4 + (mark + kick) % 4
            trail.append((slot, layer[slot]))
            layer[slot], mark = mark, layer[slot]
            bucket = self._other(bucket, mark)
            for free in range(bucket * 4, bucket * 4 + 4):
                if not layer[free]:
                    layer[free] = mark
                    return
        for slot, old in reversed(trail):  # full: nothing moved after all
            layer[slot] = old
        self.layers.append(array("H", bytes(2 * self.SLOTS * self.buckets)))
        self.add(h)

    def discard(self, h: int) -> None:
        """Take one copy of a hash that was added before out again."""
        mark, one, two = self._places(h)
        for layer in reversed(self.layers):
            for bucket in (one, two):
                for slot in range(bucket * 4, bucket * 4 + 4):
                    if layer[slot] == mark:
                        layer[slot] = 0
                        return


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z in lower case."""
    return line.strip(SPACE).lower()


def is_long(key: bytes, least: int) -> bool:
    """At least ``least`` code points of UTF-8."""
    if len(key) < least or len(key) >= 4 * least:
        return len(key) >= least
    return len(key) - sum(0x80 <= b < 0xC0 for b in key) >= least


def hash_of(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def references(docs: DataFrame, doc_id: str, text: str, least: int) -> DataFrame:
    """Rows ``(doc_id, key)``: the 128-bit hashes of each document's distinct long lines."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows, keys = [], []
                for row, t in enumerate(part.column(1).cast(pa.binary())):
                    lines = {k for k in map(line_key, (t.as_py() or b"").split(b"\n")) if len(k) >= least}
                    found = [hash_of(k) for k in lines if is_long(k, least)]
                    rows += [row] * len(found)
                    keys += found
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int32())), pa.array(keys, pa.binary())], names=["doc_id", "key"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, key binary")


class LineStore:
    """Documents inserted so far and the lines they hold.

    ``shards`` is fixed when the store is made; with about one shard for each
    quarter of a million lines expected, a shard's filter takes under a megabyte.
    """

    def __init__(self, spark: SparkSession, shards: int, doc_id_type: str = "long", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS):
        prepare(spark)
        self.spark, self.shards, self.min_docs, self.min_chars = spark, shards, min_docs, min_chars
        self.refs: list[DataFrame] = []
        self.counts: list[DataFrame] = []
        self.filters = spark.createDataFrame([], "shard int, filter binary")
        self.kind = doc_id_type

    def _through_filters(self, lines: DataFrame, act: str) -> tuple[DataFrame, DataFrame]:
        """Each line's ``key`` with ``held`` (its filter had it before), and the
        filters afterwards.

        A shard's filter comes first in its partition, then its lines stream by.
        ``act``: ``meet`` enters lines the filter does not hold, ``add`` enters all,
        ``remove`` takes all out.
        """
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard, kept = None, None

            def out(shards: list, filters: list | None, keys: list | None, held: list | None) -> pa.RecordBatch:
                none = [None] * len(shards)
                return pa.RecordBatch.from_arrays([
                    pa.array(shards, pa.int32()), pa.array(filters or none, pa.binary()),
                    pa.array(keys or none, pa.binary()), pa.array(held or none, pa.bool_()),
                ], names=["shard", "filter", "key", "held"])

            for batch in batches:
                shards, keys, held = [], [], []
                for s, packed, key, h in zip(*(c.to_pylist() for c in batch.columns)):
                    if s != shard:
                        if kept is not None:
                            yield out([shard], [kept.packed()], None, None)
                        shard, kept = s, Cuckoo(SHARD_LINES) if packed is None else Cuckoo.of(packed)
                    if packed is not None:
                        continue
                    was = h in kept
                    if act == "remove":
                        kept.discard(h)
                    elif act == "add" or not was:
                        kept.add(h)
                    shards.append(s)
                    keys.append(key)
                    held.append(was)
                if shards:
                    yield out(shards, None, keys, held)
            if kept is not None:
                yield out([shard], [kept.packed()], None, None)

        none = F.lit(None)
        stream = self.filters.select("shard", "filter", none.cast("binary").alias("key"), none.cast("long").alias("h")).unionByName(
            lines.select(
                F.pmod(F.hash("key"), F.lit(self.shards)).alias("shard"), none.cast("binary").alias("filter"), "key", F.xxhash64("key").alias("h"))
        )
        passed = written(
            stream.repartition(self.shards, "shard").sortWithinPartitions("shard", F.col("filter").isNull())
            .mapInArrow(run, "shard int, filter binary, key binary, held boolean"), "passed"
        )
        return passed.where("key is not null").select("key", "held"), passed.where("filter is not null").select("shard", "filter")

    def add(self, refs: DataFrame) -> None:
        """Insert references that are a table already."""
        batch = written(refs.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("top")), "batch")
        met, self.filters = self._through_filters(batch.select("key"), "meet")
        maybe = written(
            met.where("held").select("key")
            .join(self._counts().select("key", F.lit(True).alias("known")).distinct(), "key", "left"), "maybe"
        )
        taken = maybe.where("known is null").select("key")
        if not taken.isEmpty():
            _, self.filters = self._through_filters(taken, "add")
        # one row a line on both sides
        known = F.coalesce("known", F.lit(False)).alias("known")
        self.counts.append(written(batch.join(maybe, "key", "left").select("key", "n", "top", known), "counts"))
        self.refs.append(refs)
        discard(batch, maybe)

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> None:
        """Insert documents; each row counts as a document.  Only this batch is read."""
        self.add(written(references(docs, doc_id, text, self.min_chars), "references"))

    def delete(self, ids: DataFrame) -> None:
        """Delete the documents whose ids are in the column ``doc_id`` of ``ids``
        (null deletes those without an id); unknown ids change nothing."""
        ids = written(ids.select(F.col("doc_id").cast(self.kind).alias("_id")).distinct(), "ids")
        gone = F.col("doc_id").eqNullSafe(F.col("_id"))
        left = written(self.references.join(ids, gone, "left_anti"), "references")
        lost = written(self.references.join(ids, gone, "left_semi").select("key").distinct(), "lost")
        # the lines concerned are counted anew over the documents that stay
        held = left.join(lost, "key", "left_semi").groupBy("key").agg(
            F.count("*").alias("n"), F.max("doc_id").alias("top"), F.lit(False).alias("known"))
        counts = written(self._counts().join(lost, "key", "left_anti").unionByName(held), "counts")
        emptied = lost.join(counts.select("key"), "key", "left_anti")
        _, self.filters = self._through_filters(emptied, "remove")
        self.counts, self.refs = [counts], [left]

    @property
    def references(self) -> DataFrame:
        return self._all(self.refs, f"doc_id {self.kind}, key binary")

    def _counts(self) -> DataFrame:
        return self._all(self.counts, f"key binary, n long, top {self.kind}, known boolean")

    def _all(self, tables: list[DataFrame], schema: str) -> DataFrame:
        return reduce(DataFrame.unionByName, tables) if tables else self.spark.createDataFrame([], schema)

    def exact_counts(self) -> DataFrame:
        """Rows ``(key, n, top)``: how many documents hold each line, and the
        greatest of their ids.  Lines never met again have one row and are not summed."""
        rows = self._counts()
        again = rows.where("known").select("key").distinct()
        summed = rows.join(again, "key", "left_semi").groupBy("key").agg(F.sum("n").alias("n"), F.max("top").alias("top"))
        return rows.where(~F.col("known")).select("key", "n", "top").join(again, "key", "left_anti").unionByName(summed)

    def dropped_lines(self) -> DataFrame:
        """Rows ``(doc_id, drop)``: the hashes of the lines each document loses.

        Heavy lines (at most ``HEAVY`` by their definition) meet their references
        by broadcast, so no task gets all documents of one line; any other line
        has a small share of the references.
        """
        repeated = written(self.exact_counts().where(F.col("n") >= self.min_docs), "repeated")
        heavy = F.col("n") > self.references.count() / HEAVY
        loses = F.col("top").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") < F.col("top")))
        many = repeated.where(heavy).select("key", "top")
        few = repeated.where(~heavy).select("key", "top")
        refs = self.references
        hit = refs.join(F.broadcast(many), "key").unionByName(refs.join(few, "key"))
        return hit.where(loses).groupBy("doc_id").agg(F.collect_set("key").alias("drop"))


def apply_drops(
    docs: DataFrame, dropped: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """Rows ``(doc_id, n_lines, n_dropped, kept)``; ``kept`` is the text (UTF-8) of
    the lines that stay, joined by line feeds."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                total, lost, kept = [], [], []
                for t, drop in zip(part.column(1).cast(pa.binary()), part.column(2)):
                    lines = (t.as_py() or b"").split(b"\n")
                    if drop.is_valid:
                        goes = set(drop.as_py())
                        stay = [x for x in lines if len(x) < min_chars or hash_of(line_key(x)) not in goes]
                    else:
                        stay = lines
                    total.append(len(lines))
                    lost.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_lines", "n_dropped", "kept"])

    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("text"))
    return rows.join(dropped, F.col("_id").eqNullSafe(F.col("doc_id")), "left").select("_id", "text", "drop").mapInArrow(
        run, f"doc_id {kind}, n_lines long, n_dropped long, kept binary"
    )


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", waves: int = 2) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, kept``.

    A long line (``MIN_CHARS`` code points) held by ``MIN_DOCS`` documents stays
    only in the one with the greatest id.  The documents enter a new store in
    ``waves`` by a hash of their id, so that later waves meet the filters of
    earlier ones; how many there are does not change the result.

    Null and empty texts are one empty line.  Each row counts as a document; rows
    that share the greatest id all keep the line; null ids count as smaller than
    any id, and a line held only without ids stays.  An empty table gives no rows;
    other columns are not read.  Lines compare by 128-bit hashes.
    """
    spark = prepare(docs.sparkSession)
    refs = written(references(docs, doc_id, text, MIN_CHARS), "references")
    store = LineStore(spark, max(8, -(-refs.count() // SHARD_LINES)), dict(docs.dtypes)[doc_id])
    for wave in range(waves):
        store.add(refs.where(F.pmod(F.hash("doc_id"), F.lit(waves)) == wave))
    return apply_drops(docs, store.dropped_lines(), doc_id, text)


def dedup_report(docs: DataFrame) -> DataFrame:
    """Digest per document of :func:`dedup_lines`."""
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
