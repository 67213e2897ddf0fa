"""Audit of how far the sources of each language diverge in their use of terms.

A first pass over the texts counts documents per term; terms in enough documents
are kept, sorted and numbered, and each run of sorted terms becomes one minimal
acyclic transducer: states that accept the same endings are one state, and the
outputs along a term's path add up to its ordinal in the order of UTF-8 bytes.  A
second pass streams the texts through the transducers and counts by ordinal; terms
come back as text only where a report names them, and ordinals break its ties.

All arithmetic is exact, in integers.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firnline.llm.common import numbered, prepare, written

#: A term in UTF-8: ASCII letters and everything beyond ASCII.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
MIN_DOCS, TOP = 10, 10
#: Terms of one transducer, and distinct terms a task counts before it sends them on.
BLOCK, HELD = 1 << 18, 1 << 19
#: Ordinals added up at once.
RANGE = 1 << 12
#: Texts up to so many bytes are taken apart in one step.
LONG = 1 << 20
#: Bytes of transducers that travel to all tasks; beyond, terms travel to them.
SENT = 64 << 20
#: Numbers in a task's table of sources and terms.
CELLS = 1 << 21
SCALE = 1_000_000_000


def terms_of(text: bytes | None) -> Iterable[bytes]:
    """The text's terms in lower case (A-Z alone)."""
    low = (text or b"").lower()
    return TERM.findall(low) if len(low) <= LONG else (m.group() for m in TERM.finditer(low))


class Transducer:
    """Minimal acyclic transducer over sorted distinct terms: term to ordinal."""

    def __init__(self, arcs: np.ndarray, targets: np.ndarray, outputs: np.ndarray, final: np.ndarray):
        self.arcs, self.targets, self.outputs, self.final = arcs, targets, outputs, final

    @classmethod
    def build(cls, terms: Sequence[bytes]) -> Transducer:
        """States are frozen, and merged with an equal one, as soon as no later
        term can add to them, so only one path is open at any time."""
        register: dict[tuple, int] = {}
        path: list[list] = [[False, []]]  # per open state: final, and its arcs; the last one's target is open

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                state = path.pop()
                arcs = path[-1][1]
                arcs[-1] = (arcs[-1], register.setdefault((state[0], *state[1]), len(register)))

        last = b""
        for term in terms:
            same = next((i for i, (a, b) in enumerate(zip(last, term)) if a != b), min(len(last), len(term)))
            close(same)
            for label in term[same:]:
                path[-1][1].append(label)
                path.append([False, []])
            path[-1][0] = True
            last = term
        close(0)
        register[(path[0][0], *path[0][1])] = root = len(register)

        accepted = [0] * (root + 1)  # terms that end at or beyond a state
        arcs, targets, outputs, final = [], [], [], np.zeros(root + 1, bool)
        for number, (ends, *out) in enumerate(register):
            final[number] = ends
            before = int(ends)
            for label, target in out:
                arcs.append(number << 8 | label)
                targets.append(target)
                outputs.append(before)
                before += accepted[target]
            accepted[number] = before
        return cls(np.array(arcs, np.int64), np.array(targets, np.int32), np.array(outputs, np.int32), final)

    def packed(self) -> bytes:
        head = np.array([len(self.arcs), len(self.final)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.arcs, self.targets, self.outputs, self.final))

    @classmethod
    def of(cls, packed: bytes) -> Transducer:
        arcs, states = np.frombuffer(packed, np.int64, 2)
        at = 16
        return cls(
            np.frombuffer(packed, np.int64, arcs, at), np.frombuffer(packed, np.int32, arcs, at + 8 * arcs),
            np.frombuffer(packed, np.int32, arcs, at + 12 * arcs), np.frombuffer(packed, bool, states, at + 16 * arcs),
        )

    def ordinals(self, terms: Sequence[bytes]) -> np.ndarray:
        """Each term's ordinal, -1 if it is not accepted; all advance byte by byte together."""
        data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.array(list(accumulate(map(len, terms))), np.int64)
        place = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        state = np.full(len(terms), len(self.final) - 1, np.int64)
        out = np.zeros(len(terms), np.int64)
        going = np.arange(len(terms))
        while len(going := going[place[going] < ends[going]]):
            arc = state[going] << 8 | data[place[going]]
            found = np.minimum(np.searchsorted(self.arcs, arc), len(self.arcs) - 1)
            fits = self.arcs[found] == arc if len(self.arcs) else np.zeros(len(arc), bool)
            state[going[~fits]] = -1
            going, found = going[fits], found[fits]
            state[going] = self.targets[found]
            out[going] += self.outputs[found]
            place[going] += 1
        return np.where((state >= 0) & self.final[state], out, -1)


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """Rows ``(lang, term, ordinal)``: each language's terms in at least
    ``min_docs`` documents, numbered in the order of their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counted in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counted), pa.string()), pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())],
                    names=["lang", "term", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                counted = held.setdefault(lang, Counter())
                size -= len(counted)
                counted.update(set(terms_of(text.as_py())))
                size += len(counted)
                if size >= HELD:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, term binary, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    kept = numbered(counted.where(F.col("n") >= min_docs).select("lang", "term"), [F.col("lang"), F.col("term")])
    # a row per language: as a table its size is known, so what is joined to it need not move
    first = written(kept.groupBy("lang").agg(F.min("place").alias("_first")), "first")
    return written(kept.join(first, "lang").select("lang", "term", (F.col("place") - F.col("_first")).alias("ordinal")), "kept")


def transducers(kept: DataFrame, block: int) -> DataFrame:
    """Rows ``(lang, block, start, packed)``: one transducer per run of ``block``
    sorted terms; ``start`` is its first term."""

    def build(table: pa.Table) -> pa.Table:
        terms = sorted(table.column("term").to_pylist())
        return pa.Table.from_arrays(
            [table.column("lang").slice(0, 1), table.column("block").slice(0, 1), pa.array([terms[0]]), pa.array([Transducer.build(terms).packed()])],
            names=["lang", "block", "start", "packed"])

    blocks = kept.select("lang", F.floor(F.col("ordinal") / block).cast("long").alias("block"), "term")
    return blocks.groupBy("lang", "block").applyInArrow(build, "lang string, block long, start binary, packed binary")


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, dict[str, Counter]]]:
    """Texts as distinct terms with their number per source, a language at a time, in portions."""
    held: dict[str, dict[str, Counter]] = {}
    size = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
            counted = held.setdefault(lang, {}).setdefault(source, Counter())
            size -= len(counted)
            counted.update(terms_of(text.as_py()))
            size += len(counted)
            if size >= HELD:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


PACKED = "lang string, source string, range long, at binary, n binary"


def _packed(lang: str, source: str, ordinal: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Counts of kept terms (ordinal not negative), packed by range of ordinals."""
    order = np.argsort(ordinal)
    order = order[np.searchsorted(ordinal[order], 0) :]
    ordinal, n = ordinal[order], n[order]
    ranges = ordinal // RANGE
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(ranges)) + 1, [len(ranges)]]) if len(ranges) else [0]
    at = (ordinal % RANGE).astype(np.uint16)
    parts = list(zip(cuts[:-1], cuts[1:]))
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * len(parts), pa.string()), pa.array([source] * len(parts), pa.string()), pa.array([ranges[i] for i, _ in parts], pa.int64()),
        pa.array([at[i:j].tobytes() for i, j in parts], pa.binary()), pa.array([n[i:j].tobytes() for i, j in parts], pa.binary()),
    ], names=["lang", "source", "range", "at", "n"])


def _merged(packed: DataFrame) -> DataFrame:
    """Rows ``(lang, source, ordinal, n)``: packed counts added up, one range at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(RANGE, np.int64)

        def out() -> pa.RecordBatch:
            hit = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]] * len(hit), pa.string()), pa.array([now[1]] * len(hit), pa.string()), pa.array(hit + now[2] * RANGE), pa.array(total[hit])],
                names=["lang", "source", "ordinal", "n"])

        for batch in batches:
            for *key, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    if now is not None:
                        yield out()
                    now, total = key, np.zeros(RANGE, np.int64)
                np.add.at(total, np.frombuffer(at, np.uint16), np.frombuffer(n, np.int64))
        if now is not None:
            yield out()

    key = ["lang", "source", "range"]
    return packed.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "lang string, source string, ordinal long, n long")


def recount(docs: DataFrame, built: DataFrame, block: int, sent: int) -> DataFrame:
    """Rows ``(lang, source, ordinal, n)``: occurrences of kept terms.

    While all transducers together take at most ``sent`` bytes, each task streams
    its texts through its own copy; beyond, tasks send their distinct terms to the
    one transducer whose run of terms can hold them.  The texts are read once.
    """
    spark = docs.sparkSession
    texts = docs.select("lang", "source", "text")
    index = built.select("lang", "block", "start", F.octet_length("packed").alias("size")).collect()  # a row per BLOCK terms
    if sum(r.size for r in index) <= sent:
        copy = spark.sparkContext.broadcast([(r.lang, r.block, bytes(r.packed)) for r in built.select("lang", "block", "packed").collect()])

        def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            by_lang: dict[str, list] = {}
            for lang, number, packed in copy.value:
                by_lang.setdefault(lang, []).append((number * block, Transducer.of(packed)))
            for lang, sources in _portions(batches):
                # a term of several sources goes through once
                terms = list(set().union(*sources.values()))
                ordinal = np.full(len(terms), -1)
                for base, one in by_lang.get(lang, ()):
                    found = one.ordinals(terms)
                    ordinal = np.where(found >= 0, found + base, ordinal)
                known = dict(zip(terms, ordinal.tolist()))
                for source, counted in sources.items():
                    size = len(counted)
                    yield _packed(lang, source, np.fromiter(map(known.__getitem__, counted), np.int64, size), np.fromiter(counted.values(), np.int64, size))

        return _merged(texts.mapInArrow(here, PACKED))

    starts: dict[str, list[bytes]] = {}
    for r in sorted(index, key=lambda r: (r.lang, r.block)):
        starts.setdefault(r.lang, []).append(bytes(r.start))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, sources in _portions(batches):
            first = starts.get(lang, [])
            for source, counted in sources.items():
                rows = [(at, term, n) for term, n in counted.items() if (at := bisect_right(first, term) - 1) >= 0]
                where, terms, n = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(rows), pa.string()), pa.array(where, pa.int64()), pa.array([source] * len(rows), pa.string()),
                     pa.array(terms, pa.binary()), pa.array(n, pa.int64())], names=["lang", "block", "source", "term", "n"])

    def there(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, one = None, None
        for batch in batches:
            rows: dict[tuple, list] = {}
            for lang, number, packed, source, term, n in zip(*(c.to_pylist() for c in batch.columns)):
                if packed is not None:
                    for key, found in rows.items():
                        yield _through(one, block, key, found)
                    rows, now, one = {}, (lang, number), Transducer.of(packed)
                elif (lang, number) == now:
                    rows.setdefault((lang, number, source), []).append((term, n))
            for key, found in rows.items():
                yield _through(one, block, key, found)

    none = F.lit(None)
    stream = built.select("lang", "block", "packed", none.cast("string").alias("source"), none.cast("binary").alias("term"), none.cast("long").alias("n")).unionByName(
        texts.mapInArrow(send, "lang string, block long, source string, term binary, n long").withColumn("packed", none.cast("binary"))
    )
    spread = stream.repartition("lang", "block").sortWithinPartitions("lang", "block", F.col("packed").isNull())
    return _merged(spread.mapInArrow(there, PACKED))


def _through(one: Transducer, block: int, key: tuple, found: list) -> pa.RecordBatch:
    lang, number, source = key
    ordinal = one.ordinals([t for t, _ in found])
    return _packed(lang, source, np.where(ordinal >= 0, ordinal + number * block, -1), np.array([n for _, n in found], np.int64))


def share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a count in units of 1 / ``SCALE``, from 1 up."""
    over = (count.cast("decimal(18,0)") + F.lit(2)).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    under = (total + F.lit(2) * terms).cast("decimal(19,0)")
    return F.call_function("div", over, under) + F.lit(1).cast("long")


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def pair_sums(counts: DataFrame, groups: DataFrame, vocabulary: DataFrame, cells: int) -> DataFrame:
    """Rows ``(lang, a, b, value)`` for two sources ``a < b`` (their numbers in
    ``groups``): the sum of the distances over all kept terms of the language.

    Runs of ordinals are tables of sources and terms, narrow enough for any number
    of sources; counts of zero are filled in there.
    """
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    width = max(1, cells // most)

    def add(given: pa.Table, sources: pa.Table) -> pa.Table:
        first = sources.column("block")[0].as_py() * width
        number = np.array(sources.column("number"))
        order = np.argsort(number)
        number = number[order]
        shares = np.repeat(np.array(sources.column("empty"))[order][:, None], min(width, sources.column("terms")[0].as_py() - first), axis=1)
        shares[np.searchsorted(number, np.array(given.column("number"))), np.array(given.column("ordinal")) - first] = np.array(given.column("p"))
        left, right, value = [], [], []
        for a in range(len(number) - 1):
            apart = shares[a + 1 :] - shares[a]
            value.append((apart * apart // (shares[a + 1 :] + shares[a])).sum(axis=1))
            left.append(np.full(len(number) - 1 - a, number[a]))
            right.append(number[a + 1 :])
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right, value)]
        lang = pa.array([sources.column("lang")[0].as_py()] * len(flat[0]), pa.string())
        return pa.Table.from_arrays([lang, *map(pa.array, flat)], names=["lang", "a", "b", "value"])

    blocks = vocabulary.select("lang", "terms", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("terms") - 1, F.lit(width).cast("long")))).alias("block"))
    each = blocks.join(groups.select("lang", "number", "empty"), "lang")
    rows = counts.select("lang", F.call_function("div", F.col("ordinal"), F.lit(width).cast("long")).alias("block"), "number", "ordinal", "p")
    sums = rows.groupBy("lang", "block").cogroup(each.groupBy("lang", "block")).applyInArrow(add, "lang string, a long, b long, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP,
    block: int = BLOCK, sent: int = SENT, cells: int = CELLS,
) -> DataFrame:
    """Rows ``(lang, source, part, item, value, rank)``.

    ``part`` ``pair``: ``item`` is each other source of the language, ``value`` the
    distance of the two sources' shares summed over the language's kept terms.
    ``part`` ``term``: ``item`` is a kept term the source uses more than the whole
    language does, ``value`` the distance of the two shares, at most ``top`` a
    source.  Ranks go by value, ties by UTF-8 bytes.

    Null text, language and source count as empty strings; each row counts as a
    document; a language without kept terms has pairs of value 0, one with a single
    source no pairs; an empty table gives no rows; other columns are not read.
    """
    prepare(docs.sparkSession)
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(named(lang).alias("lang"), named(source).alias("source"), named(text).alias("text"))
    kept = kept_terms(rows, min_docs)
    built = written(transducers(kept, block), "transducers")
    counts = written(recount(rows, built, block, sent), "recount")
    vocabulary = written(kept.groupBy("lang").agg(F.count("*").alias("terms")), "vocabulary")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = written(
        rows.select("lang", "source").distinct().join(vocabulary, "lang", "left").join(totals, ["lang", "source"], "left")
        .withColumns({"terms": F.coalesce("terms", F.lit(0)), "total": F.coalesce("total", F.lit(0))})
        .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long"))
        .withColumn("empty", F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms")))), "groups"
    )
    whole = written(groups.groupBy("lang").agg(F.any_value("terms").alias("terms"), F.sum("total").alias("all")), "languages")
    shares = written(
        counts.join(groups, ["lang", "source"]).select("lang", "source", "number", "terms", "ordinal", "n", share(F.col("n"), F.col("total"), F.col("terms")).alias("p")),
        "shares"
    )

    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    a, b = groups.select("lang", F.col("source"), F.col("number").alias("a")), groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"))
    sums = pair_sums(shares, groups, vocabulary, cells)
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = (
        a.join(b, "lang").where("a <> b").join(both, ["lang", "a", "b"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
    )

    usual = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n")).join(whole, "lang").select(
        "lang", "ordinal", share(F.col("n"), F.col("all"), F.col("terms")).alias("q"))
    by_ordinal = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("ordinal"))
    marked = (
        shares.select("lang", "source", "ordinal", "p").join(usual, ["lang", "ordinal"]).where("p > q")
        .select("lang", "source", "ordinal", distance(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(by_ordinal)).where(F.col("rank") <= top)
        .join(kept, ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank")
    )
    return pairs.unionByName(marked)
