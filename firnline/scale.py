"""Skew-safe building blocks shared by the operators.

A key may hold a large share of all rows, so nothing here sorts or gathers one
whole key in one task:

* ``latest_by`` / ``earliest_by`` are aggregates with map-side combine, used in
  place of ``row_number() = 1``;
* ``carry`` and ``running_sum`` cut each key into ordered chunks, run the window
  inside a chunk, and pass only one summary row per chunk across chunks;
  ``placed`` makes chunks of a bounded number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from firnline.session import cut_lineage

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(c: ColumnLike) -> Column:
    """Microseconds since 1970 of a timestamp, with or without zone."""
    return F.unix_micros(_col(c).cast("timestamp"))


def epoch_s(c: ColumnLike) -> Column:
    return F.unix_seconds(_col(c).cast("timestamp"))


def id_chunk(c: ColumnLike, bits: int = 20) -> Column:
    """Chunk of a unique integer id: at most ``2**bits`` rows in any chunk."""
    return F.shiftright(_col(c).cast("long"), bits)


#: Rows of a chunk made by :func:`placed`: ``2 ** CHUNK_BITS``.
CHUNK_BITS = 16


def placed(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with a column ``_chunk`` that does not decrease along the order of a
    key, and of which no value has more than ``2 ** CHUNK_BITS`` rows.

    The rows are sorted over the cluster, so neither a crowded key nor a crowded
    hour makes a large chunk, and kept once in the shared folder, because chunks
    counted twice could differ.
    """
    at = F.monotonically_increasing_id()
    return cut_lineage(df.orderBy(*keys, *order).withColumn("_chunk", F.shiftright(at, CHUNK_BITS)))


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike]) -> DataFrame:
    """Whole row with the greatest ``order`` for each key."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return (
        df.groupBy(*keys)
        .agg(F.max_by(row, F.struct(*[_col(c) for c in order])).alias("_row"))
        .select("_row.*")
    )


def earliest_by(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike]) -> DataFrame:
    """Whole row with the smallest ``order`` for each key."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return (
        df.groupBy(*keys)
        .agg(F.min_by(row, F.struct(*[_col(c) for c in order])).alias("_row"))
        .select("_row.*")
    )


#: Bits of a signed number of each type in a composite order; a timestamp counts
#: microseconds between the years 1 and 9999.
ORDER_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64, "timestamp": 59, "timestamp_ntz": 59, "date": 32, "boolean": 2}


def fold_order(df: DataFrame, order: Sequence[ColumnLike]) -> Column:
    """Composite order as one number, nulls first, where the types allow it.

    ``max_by`` over primitive values and numbers is a hash aggregate, over structs
    or strings a sort before and after the exchange.  Strings, and more than a
    decimal's 126 bits, keep the struct.
    """
    columns = [_col(c) for c in order]
    kinds = [kind for _, kind in df.select(*[c.alias(f"_{i}") for i, c in enumerate(columns)]).dtypes]
    bits = [ORDER_BITS.get(kind, 127) for kind in kinds]
    if sum(bits) > 125:
        return F.struct(*columns)
    number, used = None, 0
    for column, kind, width in zip(columns, kinds, bits):
        whole = F.unix_micros(column.cast("timestamp")) if kind.startswith("timestamp") else F.unix_date(column) if kind == "date" else column
        value = F.coalesce(whole.cast("long"), F.lit(-(1 << (width - 1))).cast("long"))
        if number is None:
            number = value
        elif used + width <= 63:
            number = number * F.lit(1 << width) + value
        else:
            number = (number.cast("decimal(38,0)") * F.lit(str(1 << width)).cast("decimal(20,0)")).cast("decimal(38,0)") + value.cast("decimal(19,0)")
        used += width
    return number.cast("decimal(38,0)") if used > 63 else number


#: Bits of the columns of a pixel that travel together: raster bytes, and seconds
#: for a thousand years.
PIXEL_BITS = {"value": 8, "qc": 8, "flags": 8, "acq_epoch": 35}


class Payload:
    """Columns of a row that an ordered fold takes along, as one number where they
    are the integer columns of a pixel, else as a struct.

    A pixel column outside its range (``PIXEL_BITS``, from 0) is an error.
    """

    def __init__(self, df: DataFrame, columns: dict[str, Column]):
        kinds = dict(df.select(*[c.alias(n) for n, c in columns.items()]).dtypes)
        self.kinds, self.columns = kinds, columns
        self.packs = all(n in PIXEL_BITS and kinds[n] in ("tinyint", "smallint", "int", "bigint") for n in columns)

    def packed(self) -> Column:
        if not self.packs:
            return F.struct(*[c.alias(n) for n, c in self.columns.items()])
        number = F.lit(0).cast("long")
        for name, column in self.columns.items():
            bits = PIXEL_BITS[name]
            fits = (
                F.when(column.isNull(), F.lit(1 << bits)).when(column.between(0, (1 << bits) - 1), column.cast("long"))
                .otherwise(F.raise_error(F.concat(F.lit(f"{name} out of range: "), column.cast("string"))).cast("long"))
            )
            number = F.shiftleft(number, bits + 1).bitwiseOR(fits)
        return number

    def struct(self, packed: Column) -> Column:
        """The columns again; null where ``packed`` is."""
        if not self.packs:
            return packed
        parts, shift = [], 0
        for name in reversed(self.columns):
            bits = PIXEL_BITS[name]
            part = F.shiftright(packed, shift).bitwiseAND(F.lit((2 << bits) - 1).cast("long"))
            parts.append(F.when(part < 1 << bits, part).cast(self.kinds[name]).alias(name))
            shift += bits + 1
        return F.when(packed.isNotNull(), F.struct(*reversed(parts)))


def carry(
    df: DataFrame,
    keys: Sequence[str],
    chunk: Column,
    order: Sequence[str],
    value: Column,
    name: str,
    inclusive: bool = False,
    backward: bool = False,
) -> DataFrame:
    """Last non-null ``value`` seen before each row in the order of its key.

    ``chunk`` must not decrease along ``order``.  Wrap a nullable value in a
    struct to tell "no earlier row" from "earlier row holding null".  With
    ``backward`` the next value is taken instead of the previous one.
    """
    keyed = df.withColumn("_chunk", chunk).withColumn("_value", value)
    last = F.max_by if not backward else F.min_by
    position = F.struct(*[F.col(c) for c in order])
    ends = keyed.groupBy(*keys, "_chunk").agg(
        last("_value", F.when(F.col("_value").isNotNull(), position)).alias("_end")
    )

    def sorted_by(cols: Sequence[str]) -> list[Column]:
        return [F.col(c).desc() if backward else F.col(c).asc() for c in cols]

    across = (
        Window.partitionBy(*keys)
        .orderBy(*sorted_by(["_chunk"]))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = ends.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_chunk").alias("_kc"),
        F.last("_end", ignorenulls=True).over(across).alias("_in"),
    )
    within = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(*sorted_by(order))
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    local = keyed.withColumn("_local", F.last("_value", ignorenulls=True).over(within))
    cond = F.col("_chunk") == F.col("_kc")
    for i, k in enumerate(keys):
        cond = cond & (F.col(k) == F.col(f"_k{i}"))
    return local.join(carried, cond, "left").select(
        *df.columns, F.coalesce("_local", "_in").alias(name)
    )


def running_sums(
    df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str], values: dict[str, Column]
) -> DataFrame:
    """Sum of each value over the rows of the key up to and including this one."""
    keyed = df.withColumn("_chunk", chunk)
    for name, value in values.items():
        keyed = keyed.withColumn(f"_v_{name}", value)
    across = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    within = (
        Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    totals = keyed.groupBy(*keys, "_chunk").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    bases = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_chunk").alias("_kc"),
        *[F.coalesce(F.sum(f"_t_{n}").over(across), F.lit(0)).alias(f"_b_{n}") for n in values],
    )
    local = keyed.select("*", *[F.sum(f"_v_{n}").over(within).alias(f"_l_{n}") for n in values])
    cond = F.col("_chunk") == F.col("_kc")
    for i, k in enumerate(keys):
        cond = cond & (F.col(k) == F.col(f"_k{i}"))
    return local.join(bases, cond, "left").select(
        *df.columns, *[(F.coalesce(f"_l_{n}", F.lit(0)) + F.col(f"_b_{n}")).alias(n) for n in values]
    )


def running_sum(
    df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str], value: Column, name: str
) -> DataFrame:
    """One running sum, see :func:`running_sums`."""
    return running_sums(df, keys, chunk, order, {name: value})


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, label``: each node with the least node it is linked with, itself
    included.  ``nodes``: ``node``; ``edges``: ``a, b``, undirected.

    A round takes the least label among a node and its neighbours, then the label
    of that label, so the rounds grow slowly with the longest path.  Each round is
    a checkpoint; only whether it changed anything comes to the driver.
    """
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = nodes.select("node", F.col("node").alias("label"))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near"))
        step = labels.join(near, "node", "left").select("node", "label", F.coalesce(F.least("label", "_near"), "label").alias("_to"))
        far = step.select(F.col("node").alias("_to"), F.col("_to").alias("_far"))
        new = cut_lineage(step.join(far, "_to").select("node", "label", F.least("_to", "_far").alias("_new")))
        if new.where("_new <> label").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", F.col("_new").alias("label"))


def distinct_days(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """One row per key and calendar day, so a key holds at most one row a day."""
    return df.select(*keys, day).distinct()


def python_partitions(df: DataFrame) -> int:
    """Partitions for work done in Python: as configured, because merging small
    ones by their bytes would leave few tasks for work heavy per row."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def stream_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    schema: str,
    fn: Callable[[tuple, Iterable[tuple]], Iterable[tuple]],
    out_rows: int = 20_000,
) -> DataFrame:
    """Ordered pass over each group for rules that depend on the row before.

    Spark shuffles by ``keys`` and sorts; ``fn(key, rows)`` then reads a group's
    rows (tuples in column order) one by one and yields output tuples.  Rows flow
    through Arrow batches, so no group is held whole.
    """
    columns = df.columns
    at = [columns.index(k) for k in keys]
    # explicit Arrow types keep large ids exact beside nulls
    target = to_arrow_schema(T.StructType.fromDDL(schema))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def table(out: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(c, type=f.type) for c, f in zip(zip(*out), target)]
        return pa.RecordBatch.from_arrays(arrays, schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for key, rows in groupby(rows_of(batches), key=lambda r: tuple(r[i] for i in at)):
            for made in fn(key, rows):
                out.append(made)
                if len(out) >= out_rows:
                    yield table(out)
                    out = []
        if out:
            yield table(out)

    spread = df.repartition(python_partitions(df), *keys)
    return spread.sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
