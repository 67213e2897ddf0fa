"""Radar slices of a data take chained into assemblies of at most two."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.folds import OrderedRule, State, ordered_fold
from firnline.operators.products import duplicate_slices
from firnline.scale import CHUNK_BITS, epoch_us

_OUT = (
    "stripe_id string, assembly_no int, position int, product_id string, "
    "exclude_first boolean, exclude_last boolean"
)
DAY_US = 86_400_000_000
# whole seconds are compared: a second and its fraction
REPEAT_US = 2_000_000


def _seconds(delta_us: int) -> int:
    """Second-of-day part of a time difference (a negative one wraps)."""
    return int(delta_us % DAY_US) // 1_000_000


def _repeats(before: int, start: int) -> bool:
    return _seconds(abs(start - before)) <= 1


class _Chain(OrderedRule):
    """Assemblies along a stripe, read in order of start.

    A slice that starts within a second of the last accepted one is left out.  A
    missing slice number or a pause above a second starts a new assembly; the slice
    that fills an assembly closes it and opens the next one as well.  A tile may not
    cross the outer border lines of the assembly it belongs to.

    State: start, stop and number of the last accepted slice, slices in the open
    assembly, its number.
    """

    def __init__(self, longest: int):
        self.longest = longest

    def _step(self, before: tuple, start: int, stop: int, piece: int, count: int) -> tuple[int, bool, bool]:
        """Slices in the open assembly after an accepted slice; whether it starts
        an assembly alone, or closes one and opens the next."""
        jump = piece != 0 and before[2] != 0 and piece - before[2] != 1
        if jump or _seconds(start - before[1]) > 1:
            return 1, True, False
        if count + 1 >= self.longest:
            return 1, False, True
        return count + 1, False, False

    def run(self, key: tuple, state: State, rows: Iterable[tuple]) -> Iterator[tuple]:
        before, count, number = (None, 0, 1) if state is None else (tuple(state[:3]), state[3], state[4])
        for _, product, start, stop, piece, total in rows:
            if before is not None and _repeats(before[0], start):
                continue
            last = not (piece != 0 and piece == total)
            if before is None:
                count = 1
                yield (*key, number, 0, product, piece != 1, last)
            else:
                place, (count, alone, both) = count, self._step(before, start, stop, piece, count)
                if both:
                    yield (*key, number, place, product, False, last)
                number += alone or both
                yield (*key, number, 0 if alone or both else place, product, alone or both, last)
            before = (start, stop, piece)

    def summary(self, rows: list[tuple]) -> list[int]:
        """Every slice of the chunk that may be the first accepted one, and for each
        count it is accepted with what the chunk leaves behind.

        Slices left out lie within two seconds of day behind one slice, so the
        candidates end where the chunk's first slices spread over more.  Behind a
        given slice the next accepted one is fixed, so one pass from the end answers
        all candidates.
        """
        starts = [r[2] for r in rows]
        low = high = 0
        candidates = 0
        for s in starts:
            candidates += 1
            offset = (s - starts[0] + REPEAT_US) % DAY_US - REPEAT_US
            low, high = min(low, offset), max(high, offset)
            if high - low >= REPEAT_US:
                break
        counts = range(1, max(self.longest, 2))
        # per slice and count: last accepted slice, its count, assemblies begun
        ends: list[list[tuple[int, int, int]]] = [[]] * len(rows)
        for i in range(len(rows) - 1, -1, -1):
            j = self._next(starts, i)
            here = []
            for count in counts:
                if j is None:
                    here.append((i, count, 0))
                    continue
                to, alone, both = self._step(rows[i][2:5], *rows[j][2:5], count)
                end, left, begun = ends[j][to - 1]
                here.append((end, left, begun + (alone or both)))
            ends[i] = here
        out = [candidates, len(counts)]
        for i in range(candidates):
            out += rows[i][2:5]
            for end, left, begun in ends[i]:
                out += [*rows[end][2:5], left, begun]
        return out

    @staticmethod
    def _next(starts: list[int], i: int) -> int | None:
        """First slice behind ``i`` that is accepted once ``i`` is."""
        j = bisect_left(starts, starts[i] + REPEAT_US, i + 1)
        while j < len(starts) and _repeats(starts[i], starts[j]):
            days = (starts[j] - starts[i]) // DAY_US
            j = bisect_left(starts, starts[i] + days * DAY_US + REPEAT_US, j)
        return j if j < len(starts) else None

    def advance(self, state: State, summary: list[int]) -> State:
        candidates, counts = summary[:2]
        width = 3 + 5 * counts
        for c in range(candidates):
            at = 2 + c * width
            start, stop, piece = summary[at:at + 3]
            if state is None:
                count, number = 1, 1
            elif _repeats(state[0], start):
                continue
            else:
                count, alone, both = self._step(tuple(state[:3]), start, stop, piece, state[3])
                number = state[4] + (alone or both)
            at += 3 + 5 * (count - 1)
            *last, left, begun = summary[at:at + 5]
            return [*last, left, number + begun]
        return state


def assemble_slices(acquisitions: DataFrame, longest: int = 2, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Assemblies per stripe (platform, data take, projection).

    ``acquisitions``: ``stripe_id, product_id, platform, take_id, slice,
    total_slices, start_ts, stop_ts``.  Stripes of any length: they are cut into
    chunks (see :func:`firnline.folds.ordered_fold`).  A slice without number counts
    as number 0; one without start or stop, or without stripe, belongs to no assembly.
    """
    narrow = acquisitions.select(
        F.col("stripe_id").cast("string").alias("stripe_id"), F.col("product_id").cast("string").alias("product_id"),
        epoch_us("start_ts").alias("start"), epoch_us("stop_ts").alias("stop"),
        F.coalesce(F.col("slice").cast("int"), F.lit(0)).alias("slice"), F.col("total_slices").cast("int").alias("total"),
    ).where("stripe_id IS NOT NULL AND start IS NOT NULL AND stop IS NOT NULL")
    return ordered_fold(narrow, ["stripe_id"], ["start", "product_id"], _OUT, _Chain(longest), chunk_bits)


def stripes(acquisitions: DataFrame, tiles_of: DataFrame) -> DataFrame:
    """One row per slice and projection zone of the tiles it meets."""
    zones = tiles_of.select("product_id", "epsg").distinct()
    unique = duplicate_slices(acquisitions)
    return unique.join(zones, "product_id").withColumn(
        "stripe_id", F.concat_ws("_", "platform", "take_id", F.col("epsg").cast("string"))
    )


def assembly_names(assemblies: DataFrame, acquisitions: DataFrame) -> DataFrame:
    """Assembly id made of the stripe, its first start and its last stop."""
    times = acquisitions.select("product_id", "start_ts", "stop_ts")
    named = assemblies.join(times, "product_id").groupBy("stripe_id", "assembly_no").agg(
        F.min_by("start_ts", "position").alias("_a"), F.max_by("stop_ts", "position").alias("_b")
    )
    fmt = "yyyyMMddHHmmss"
    return named.select(
        "stripe_id", "assembly_no",
        F.concat_ws("_", "stripe_id", F.date_format("_a", fmt), F.date_format("_b", fmt)).alias("assembly_id"),
    )
