"""Ordered rules without a closed form, over keys of any length.

Where a row's result depends on the state that all rows before it left, a whole
key would have to pass through one task.  Instead a key is cut into chunks of a
bounded number of rows, each chunk is turned into the map from the state it is
entered in to the state it is left in, the maps of a key are applied one after
the other, and every chunk then answers its own rows from its entry state.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from firnline.scale import CHUNK_BITS, stream_groups
from firnline.session import cut_lineage

State = list[int] | None


class OrderedRule(ABC):
    """A rule over the ordered rows of a key; rows are tuples in column order.

    A state is a list of integers, None before a key's first row.
    """

    @abstractmethod
    def summary(self, rows: list[tuple]) -> list[int]:
        """What the rows of a chunk do to any state they are entered in."""

    @abstractmethod
    def advance(self, state: State, summary: list[int]) -> State:
        """State behind a chunk that is entered in ``state``."""

    @abstractmethod
    def run(self, key: tuple, state: State, rows: Iterable[tuple]) -> Iterator[tuple]:
        """Output of the rows of a chunk that is entered in ``state``."""


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def ordered_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], schema: str, rule: OrderedRule, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """``rule`` over the rows of each key in their order.

    Rows are sorted over the cluster and kept once, so that every pass sees the same
    chunks of at most ``2 ** chunk_bits`` rows.  Only the first and the last key of a
    chunk can reach into another one, so at most two summaries a chunk are made and
    the second pass reads one row in some ten thousand; a task of the third pass
    holds no more than one chunk of a key.  An empty table gives no rows, rows that
    are equal in all of ``order`` pass in the sorted order of this run.
    """
    names = list(df.columns)
    chunk = F.shiftright("_at", chunk_bits)
    line = cut_lineage(df.orderBy(*keys, *order).withColumn("_at", F.monotonically_increasing_id())).withColumn("_chunk", chunk)
    at = [names.index(k) for k in keys]
    width = len(names)
    ends = T.StructType(
        [T.StructField(k, df.schema[k].dataType) for k in keys]
        + [T.StructField("_chunk", T.LongType()), T.StructField("_summary", T.ArrayType(T.LongType()))]
    )
    arrow = to_arrow_schema(ends)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(key: tuple, number: int, rows: list[tuple]) -> pa.RecordBatch:
            made = (*key, number, rule.summary(rows))
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(made, arrow)], schema=arrow)

        for number, rows in groupby(_rows(batches), key=lambda r: r[width + 1]):
            last = None
            for i, (key, part) in enumerate(groupby(rows, key=lambda r: tuple(r[j] for j in at))):
                held = [r[:width] for r in part]
                if i == 0:
                    yield table(key, number, held)
                else:
                    last = (key, held)
            if last:
                yield table(last[0], number, last[1])

    def entries(key: tuple, rows: Iterable[tuple]) -> Iterator[tuple]:
        state = None
        for i, row in enumerate(rows):
            if i:
                yield (*key, row[-2], state)
            state = rule.advance(state, row[-1])

    state_schema = ", ".join([f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys] + ["_chunk long", "_state array<long>"])
    states = stream_groups(line.mapInArrow(summaries, ends), list(keys), ["_chunk"], state_schema, entries)

    def answers(key: tuple, rows: Iterable[tuple]) -> Iterator[tuple]:
        state = None

        def own() -> Iterator[tuple]:
            nonlocal state
            for row in rows:
                if row[width] is None:
                    # the entry state of the chunk, sorted before its rows
                    state = row[-1]
                else:
                    yield row[:width]

        source = own()
        first = next(source, None)
        if first is not None:
            yield from rule.run(key[:-1], state, _with(first, source))

    both = line.select(*names, "_at", "_chunk", F.lit(None).cast("array<long>").alias("_state")).unionByName(states, allowMissingColumns=True)
    return stream_groups(both, [*keys, "_chunk"], [F.col("_at").asc_nulls_first()], schema, answers)


def _with(first: tuple, rest: Iterable[tuple]) -> Iterator[tuple]:
    yield first
    yield from rest
