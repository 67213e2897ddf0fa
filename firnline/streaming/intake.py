"""Product intake streams: de-duplication, late data, replaced versions, held triggers."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from firnline import codes
from firnline.operators.filters import split_reprocessed
from firnline.operators.reporting import days_in_bands

HOUR_MS = 3_600_000


#: Runs of stored ids that are merged into one of the next level.
FAN = 8


def runs_before(batch_id: int) -> list[tuple[int, int]]:
    """(level, first batch) of the runs that hold all batches before this one.

    A run of a level covers ``FAN ** level`` batches, so their number grows with
    the logarithm of the batches.
    """
    out, at, level = [], 0, 0
    while FAN ** (level + 1) <= batch_id:
        level += 1
    for step in range(level, -1, -1):
        while at + FAN**step <= batch_id:
            out.append((step, at))
            at += FAN**step
    return out


def _run(ids: str, level: int, first: int) -> str:
    return os.path.join(ids, f"level={level}", f"first={first}")


def _bucket(level: int):
    return F.pmod(F.xxhash64("product_id"), F.lit(FAN**level)).cast("int")


def stored_ids(wanted: DataFrame, ids: str, batch_id: int) -> DataFrame:
    """Ids of earlier batches from those files that may hold one of ``wanted``.

    A run of level n has ``FAN ** n`` buckets, each about as large as one batch, and
    only the buckets of the ids wanted are read, at most one a run and id.  What is
    read is therefore bounded by the batch (the source's admission limit), not by
    what was ever stored.  Bucket numbers pass the driver, no ids.
    """
    spark, kind = wanted.sparkSession, wanted.schema["product_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"product_id {kind}")
    for level, first in runs_before(batch_id):
        hit = [r[0] for r in wanted.select(_bucket(level)).distinct().collect()] if level else [0]
        run = spark.read.schema(f"product_id {kind}, bucket int").parquet(_run(ids, level, first))
        out = out.unionByName(run.where(F.col("bucket").isin(hit)).select("product_id"))
    return out


def _keep_ids(new: DataFrame, ids: str, batch_id: int) -> None:
    """Run of this batch, and the runs that end with it from those below."""

    def write(df: DataFrame, level: int, first: int) -> None:
        placed = df.withColumn("bucket", _bucket(level)).repartition("bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(_run(ids, level, first))

    spark, kind = new.sparkSession, new.schema["product_id"].dataType.simpleString()
    write(new, 0, batch_id)
    level = 1
    while (batch_id + 1) % FAN**level == 0:
        first, step = batch_id + 1 - FAN**level, FAN ** (level - 1)
        parts = [_run(ids, level - 1, first + i * step) for i in range(FAN)]
        write(spark.read.schema(f"product_id {kind}").option("basePath", ids).parquet(*parts), level, first)
        level += 1


def intake(out: str, published: str = "publication_date") -> Callable[[DataFrame, int], None]:
    """Batch writer adding each new product to ``out`` once, whenever it arrives.

    Sources are polled with an overlap, so products come again, also much later or
    behind newer ones; those stored by an earlier batch are left out, and of repeats
    within a batch the first published counts.  No row is dropped for its age.  Ids
    are kept beside the products in ``out + "_ids"``, see :func:`stored_ids`; a
    replayed batch reads earlier batches only and replaces its own folders.  Merged
    runs stay, so the ids take one copy a level.  Rows without id count as one product.
    """
    ids = out.rstrip("/") + "_ids"

    def write(batch: DataFrame, batch_id: int) -> None:
        names, spark = batch.columns, batch.sparkSession
        first = batch.groupBy("product_id").agg(F.min_by(F.struct(*names), F.struct(published, *[c for c in names if c != published])).alias("_row"))
        if batch_id:
            known = stored_ids(batch.select("product_id"), ids, batch_id).select(F.col("product_id").alias("_known"))
            first = first.join(known, F.col("product_id").eqNullSafe(F.col("_known")), "left_anti")
        folder = os.path.join(out, f"batch_id={batch_id}")
        first.select("_row.*").write.mode("overwrite").parquet(folder)
        _keep_ids(spark.read.schema(batch.schema).parquet(folder).select("product_id"), ids, batch_id)

    return write


def route_late(start: Any, out: str, measured: str = "measurement_date") -> Callable[[DataFrame, int], None]:
    """Batch writer putting old measurements published now into a side table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        new, old = split_reprocessed(batch, start, measured)
        new.write.mode("overwrite").parquet(os.path.join(out, "new", f"batch_id={batch_id}"))
        old.write.mode("overwrite").parquet(os.path.join(out, "late", f"batch_id={batch_id}"))

    return write


def incremental_days(out: str, done: Callable[[], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Batch writer listing days not computed yet and inputs missed on computed
    days.  ``done()`` gives ``day, product_id`` of the products already used."""

    def write(batch: DataFrame, batch_id: int) -> None:
        used = done()
        days = used.select("day").distinct()
        todo = batch.select("day").distinct().join(days, "day", "left_anti")
        missed = batch.select("day", "product_id").join(days, "day", "left_semi").join(
            used.select("day", "product_id"), ["day", "product_id"], "left_anti"
        )
        todo.write.mode("overwrite").parquet(os.path.join(out, "days", f"batch_id={batch_id}"))
        missed.write.mode("overwrite").parquet(os.path.join(out, "missed", f"batch_id={batch_id}"))

    return write


def _sorted(rows: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    """Rows of one key in this micro-batch, in order.

    Their number is bounded by the source's admission limit per batch.
    """
    return pd.concat(list(rows)).sort_values(by)


def _ms(ts: pd.Timestamp) -> int:
    return pd.Timestamp(ts).value // 1_000_000


#: Groups that the tile-days are dealt into.  A call of a stateful processor costs as
#: much as thousands of rows, so one call takes all tile-days of a group, and the
#: number of calls does not grow with tiles or days.
TILE_GROUPS = 256
#: Days whose entries are one value of a group's state.
SPAN_DAYS = 32


def _grouped(stream: DataFrame, day: Column, processor: StatefulProcessor, schema: str) -> DataFrame:
    group = F.pmod(F.xxhash64(F.col("tile_id"), day), F.lit(TILE_GROUPS)).cast("int")
    return stream.withColumn("_group", group).groupBy("_group").transformWithStateInPandas(processor, schema, "Append", "EventTime")


def _all_ms(times: pd.Series) -> list[int]:
    """:func:`_ms` of a whole column."""
    return (times.to_numpy("datetime64[ns]").astype("int64") // 1_000_000).tolist()


def _text(values: pd.Series) -> list[str | None]:
    return [None if v is None or v != v else v for v in values]


def _days(values: pd.Series) -> list[int | None]:
    """Dates as ordinals."""
    return [None if v is None or v != v else v.toordinal() for v in values]


class _Grouped(StatefulProcessor):
    """Entries of all tile-days of a group, as columns of one value per span of days,
    and a list of the spans with their first end.  A batch reads and writes the spans
    it meets; a group has one timer, that of the entry that ends first.

    ``entries`` names and types the columns; the last one is the time of the end.
    """

    entries: dict[str, str] = {}
    columns: list[str] = []

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        held = ", ".join(f"{name} array<{kind}>" for name, kind in self.entries.items())
        self.held = handle.getMapState("entries", "span long", held)
        self.index = handle.getValueState("spans", "spans array<long>, ends array<long>, timer long")

    def _spans(self) -> tuple[dict[int, int], int | None]:
        """First end of each span held, and the timer registered before."""
        state = self.index.get() if self.index.exists() else None
        return (dict(zip(state[0], state[1])), state[2]) if state else ({}, None)

    def _get(self, span: int, spans: dict[int, int]) -> list[tuple]:
        return list(zip(*self.held.getValue((span,)))) if span in spans else []

    def _put(self, span: int, entries: list[tuple], spans: dict[int, int]) -> None:
        if entries:
            self.held.updateValue((span,), tuple(map(list, zip(*entries))))
            spans[span] = min(e[-1] for e in entries)
        elif span in spans:
            self.held.removeKey((span,))
            del spans[span]

    def _keep(self, spans: dict[int, int], timer: int | None, timerValues) -> None:
        """Keeps the list of spans; ``timer`` is the one registered before."""
        if not spans:
            self.index.clear()
            return
        # a timer at the watermark itself may never be seen
        now = timerValues.getCurrentWatermarkInMs()
        first = max(min(spans.values()), now + 1)
        if timer is None or timer <= now or first < timer:
            self.handle.registerTimer(first)
            timer = first
        self.index.update((list(spans), list(spans.values()), timer))

    def _due(self, timerValues) -> list[tuple]:
        """Takes out the entries that ended before the watermark."""
        spans, _ = self._spans()
        now, due = timerValues.getCurrentWatermarkInMs(), []
        for span in [s for s, end in spans.items() if end < now]:
            entries = self._get(span, spans)
            due += [e for e in entries if e[-1] < now]
            self._put(span, [e for e in entries if e[-1] >= now], spans)
        self._keep(spans, None, timerValues)
        return due

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self.columns)

    def close(self) -> None:
        pass


class _Replace(_Grouped):
    """Keeps the reference product of a (tile, measurement), also after the valid
    time, so that a version published too late does not become a second one."""

    entries = {"tiles": "string", "measured": "long", "products": "string", "created": "long", "ends": "long"}
    columns = ["tile_id", "measured_ms", "product_id", "replaces"]

    def __init__(self, valid_hours: float, remember_hours: float):
        self.valid_ms = int(valid_hours * HOUR_MS)
        self.forget_ms = self.valid_ms + int(remember_hours * HOUR_MS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out = []
        spans, timer = self._spans()
        met: dict[int, dict] = {}
        r = _sorted(rows, ["publication_date", "product_id"])
        columns = _text(r.tile_id), _all_ms(r.measurement_date), _text(r.product_id), _all_ms(r.creation_date), _all_ms(r.publication_date)
        for tile, measured, product, created, published in zip(*columns):
            span = measured // (SPAN_DAYS * 24 * HOUR_MS)
            if span not in met:
                met[span] = {(t, m): (p, c, end) for t, m, p, c, end in self._get(span, spans)}
            refs = met[span]
            if (tile, measured) not in refs:
                refs[tile, measured] = (product, created, max(measured, published) + self.forget_ms)
                out.append((tile, measured, product, None))
                continue
            known, known_created, end = refs[tile, measured]
            if known != product and created != known_created and published - measured <= self.valid_ms:
                refs[tile, measured] = (product, created, end)
                out.append((tile, measured, product, known))
        for span, refs in met.items():
            self._put(span, [(*k, *v) for k, v in refs.items()], spans)
        self._keep(spans, timer, timerValues)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._due(timerValues)
        yield self._frame([])


def replace_codated(
    stream: DataFrame, valid_hours: float = 24.0, watermark: str = "1 hour", remember_hours: float = 24.0 * 365
) -> DataFrame:
    """Reference product per tile and measurement; a version made at another
    time and published within ``valid_hours`` of the measurement replaces it.
    State ends ``remember_hours`` of event time after that; only a version still
    later would count as new.

    ``stream``: ``product_id, tile_id string, measurement_date, creation_date,
    publication_date``.
    """
    return _grouped(
        stream.withWatermark("publication_date", watermark), F.to_date("measurement_date"), _Replace(valid_hours, remember_hours),
        "tile_id string, measured_ms long, product_id string, replaces string",
    ).select("tile_id", F.timestamp_millis("measured_ms").alias("measurement_date"), "product_id", "replaces")


class _Hold(_Grouped):
    """Optical triggers wait; others pass at once."""

    entries = {"tiles": "string", "days": "int", "products": "string", "ends": "long"}
    columns = ["tile_id", "product_date", "product_id", "fired_at_ms", "reason"]

    def __init__(self, hold_ms: int, early_release: bool):
        self.hold_ms = hold_ms
        self.early = early_release

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.partners = handle.getMapState("partners", "span long", "tiles array<string>, days array<int>")

    def _partners(self, span: int) -> set[tuple]:
        """Tile-days that had a partner."""
        state = self.partners.getValue((span,)) if self.early and self.partners.containsKey((span,)) else None
        return set(zip(*state)) if state else set()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out = []
        spans, timer = self._spans()
        met: dict[int, tuple[dict, set, int]] = {}
        r = _sorted(rows, ["publication_date", "product_id"])
        columns = _text(r.tile_id), _days(r.product_date), r.product_date, _text(r.product_id), _all_ms(r.publication_date), r.optical
        for tile, day, date, product, published, optical in zip(*columns):
            span = (day or 0) // SPAN_DAYS
            if span not in met:
                held: dict[tuple, dict] = {}
                for t, d, p, end in self._get(span, spans):
                    held.setdefault((t, d), {})[p] = end
                seen = self._partners(span)
                met[span] = held, seen, len(seen)
            waiting, seen, _ = met[span]
            if not optical:
                out.append((str(tile), date, product, published, "immediate"))
                if self.early:
                    seen.add((tile, day))
                    out += [(str(tile), date, p, published, "partner") for p in sorted(waiting.pop((tile, day), {}))]
            elif (tile, day) in seen:
                out.append((str(tile), date, product, published, "partner"))
            else:
                waiting.setdefault((tile, day), {})[product] = published + self.hold_ms
        for span, (waiting, seen, known) in met.items():
            if len(seen) > known:
                self.partners.updateValue((span,), tuple(map(list, zip(*seen))))
            self._put(span, [(*k, p, end) for k, some in waiting.items() for p, end in some.items()], spans)
        self._keep(spans, timer, timerValues)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = sorted(self._due(timerValues), key=lambda e: (e[3], str(e[0]), str(e[2])))
        yield self._frame([(str(t), None if d is None else dt.date.fromordinal(d), p, end, "held") for t, d, p, end in due])


def hold_trigger(
    stream: DataFrame, hours: float = codes.HOLD_HOURS, early_release: bool = False, watermark: str = "0 seconds"
) -> DataFrame:
    """Optical triggers fire ``hours`` after publication, others at once.

    As published, a same-day partner does not shorten the wait;
    ``early_release`` makes it do so.  ``stream``: ``product_id, tile_id,
    product_date date, publication_date, optical boolean``.
    """
    return _grouped(
        stream.withWatermark("publication_date", watermark), F.col("product_date"), _Hold(int(hours * HOUR_MS), early_release),
        "tile_id string, product_date date, product_id string, fired_at_ms long, reason string",
    )


def daily_counts(stream: DataFrame, time: str = "created", family: str = "family", late: str = "1 day") -> DataFrame:
    """Jobs created per family and calendar day."""
    return (
        stream.withWatermark(time, late)
        .groupBy(F.window(time, "1 day"), family)
        .agg(F.count("*").alias("n_jobs"))
        .select(F.to_date("window.start").alias("day"), family, "n_jobs")
    )


def production_days(out: str, bands: DataFrame | None = None, family: str = "family") -> Callable[[DataFrame, int], None]:
    """Batch writer of closed days (:func:`daily_counts`) against the nominal bands.

    Days close in order and all families of a day at once, so each batch gives every
    family with a band a row for each day behind the last reported one up to the
    newest closed day, silent days included; a family without band has rows for its
    own days.  A replayed batch looks at earlier batches only and replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        since = None
        if batch_id:
            # one row per family and day was ever written here
            earlier = batch.sparkSession.read.schema("day date, batch_id long").parquet(out).where(F.col("batch_id") < batch_id)
            since = earlier.agg(F.max("day")).first()[0]
        banded = days_in_bands(batch, bands, family, since)
        banded.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))

    return write
