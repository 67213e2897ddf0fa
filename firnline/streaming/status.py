"""Status-log streams: last status, validation, stuck jobs, publication retries."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from firnline import codes
from firnline.streaming.intake import _ms, _sorted


def status_state(stream: DataFrame) -> DataFrame:
    """Latest status per job, kept current (update mode)."""
    last = F.max_by(F.struct("job_status", "id", "time"), F.col("id"))
    return stream.groupBy(F.col("fk_parent_job_id").alias("parent_job_id")).agg(last.alias("r")).select(
        "parent_job_id", F.col("r.job_status").alias("status"), F.col("r.id").alias("change_id"), F.col("r.time").alias("time")
    )


#: Only an internal error may follow a cancelled job; a done one may still fail.
ENDED = (codes.STATUS["cancelled"],)
DAY_MS = 86_400_000


class _PerJob(StatefulProcessor):
    """Common state: last status of the job, dropped ``keep_days`` of event time
    after the job ended."""

    columns: list[str] = []

    def __init__(self, keep_days: float = 365.0):
        self.keep_ms = int(keep_days * DAY_MS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "status int, time_ms long, failures int")

    def _get(self) -> tuple[int, int, int]:
        return tuple(self.last.get()) if self.last.exists() else (0, 0, 0)

    def _put(self, status: int, time_ms: int, failures: int, needed: bool = True) -> None:
        """Keeps the state with its end, or nothing where nothing depends on it."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if not needed:
            self.last.clear()
            return
        self.last.update((status, time_ms, failures))
        if status in ENDED:
            self.handle.registerTimer(time_ms + self.keep_ms)

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield self._frame([])

    def close(self) -> None:
        pass


class _Validate(_PerJob):
    columns = ["parent_job_id", "change_id", "previous_status", "job_status", "accepted"]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out = []
        previous, time_ms, fails = self._get()
        for r in _sorted(rows, ["id"]).itertuples(index=False):
            accepted = int(r.job_status) in codes.ALLOWED_NEXT.get(previous, ())
            out.append((key[0], r.id, previous, int(r.job_status), accepted))
            # a refused change, too, shows that the job is not silent
            time_ms = _ms(r.time)
            if accepted:
                previous = int(r.job_status)
        self._put(previous, time_ms, fails, needed=previous != 0)
        yield self._frame(out)


class _Retry(_PerJob):
    """Only a done job and one that failed before have anything to keep."""

    columns = ["parent_job_id", "change_id", "failures", "permanent"]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out = []
        previous, time_ms, fails = self._get()
        for r in _sorted(rows, ["id"]).itertuples(index=False):
            status = int(r.job_status)
            if previous == 12 and status == 14:
                fails += 1
                out.append((key[0], r.id, fails, fails >= codes.PUBLICATION_RETRIES))
            previous, time_ms = status, _ms(r.time)
        self._put(previous, time_ms, fails, needed=fails > 0 or previous == 12)
        yield self._frame(out)


class _Stuck(_PerJob):
    """Only a job in a status with a limit has anything to keep."""

    columns = ["parent_job_id", "status", "since_ms", "alarm_ms"]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last_status, last_ms, fails = self._get()
        out = []
        for r in _sorted(rows, ["id"]).itertuples(index=False):
            now = _ms(r.time)
            due = last_ms + codes.STUCK_MINUTES.get(last_status, 0) * 60_000
            if last_status in codes.STUCK_MINUTES and now > due:
                out.append((key[0], last_status, last_ms, due))
            last_status, last_ms = int(r.job_status), now
        limited = last_status in codes.STUCK_MINUTES
        self._put(last_status, last_ms, fails, needed=limited)
        if limited:
            self.handle.registerTimer(last_ms + codes.STUCK_MINUTES[last_status] * 60_000)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        status, since, _ = self._get()
        out = []
        if status in codes.STUCK_MINUTES:
            due = since + codes.STUCK_MINUTES[status] * 60_000
            if expiredTimerInfo.getExpiryTimeInMs() >= due:
                out.append((key[0], status, since, due))
                # the alarm is raised once
                self.last.clear()
        yield self._frame(out)


def _apply(stream: DataFrame, processor: StatefulProcessor, schema: str, watermark: str) -> DataFrame:
    return (
        stream.withWatermark("time", watermark)
        .groupBy("fk_parent_job_id")
        .transformWithStateInPandas(processor, schema, "Append", "EventTime")
    )


def validate_stream(stream: DataFrame, watermark: str = "10 minutes", keep_days: float = 365.0) -> DataFrame:
    """Every change with its verdict; a refused change leaves the status as it was.

    A cancelled job silent for ``keep_days`` of event time is forgotten, so a still
    later change of it is judged as that of a new job.
    """
    return _apply(
        stream, _Validate(keep_days),
        "parent_job_id long, change_id long, previous_status int, job_status int, accepted boolean", watermark,
    )


def retry_stream(stream: DataFrame, watermark: str = "10 minutes", keep_days: float = 365.0) -> DataFrame:
    """Running count of failed publications; the third is permanent.

    The count ends ``keep_days`` of event time after the job was cancelled.
    """
    return _apply(stream, _Retry(keep_days), "parent_job_id long, change_id long, failures int, permanent boolean", watermark)


def stuck_alarm(stream: DataFrame, watermark: str = "0 seconds") -> DataFrame:
    """An alarm when a job stays in a status longer than allowed."""
    return _apply(stream, _Stuck(), "parent_job_id long, status int, since_ms long, alarm_ms long", watermark)


def feed_stream(products: DataFrame, out: str, checkpoint: str):
    """One publication document per finished product, as a JSON-lines file sink."""
    from firnline.sinks.tables import publication_feed

    documents, _ = publication_feed(products)
    return (
        documents.select(F.col("document").alias("value"))
        .writeStream.format("text")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
