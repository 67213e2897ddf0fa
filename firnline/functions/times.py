"""Columns over times.  All times are naive UTC."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: time spellings met in catalogues and metadata
TIME_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][.SSSSSSSS][.SSSSSSS][.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS][.SSSSSSSS][.SSSSSSS][.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]",
    "yyyyMMdd'T'HHmmss",
    "yyyy-MM-dd",
    "yyyyMMdd",
)


def parse_time(text: Column) -> Column:
    """Timestamp from any known spelling, with or without ``Z`` / ``+00:00``."""
    bare = F.regexp_replace(F.trim(text), r"(Z|\+00:?00)$", "")
    return F.coalesce(*[F.try_to_timestamp(bare, F.lit(fmt)) for fmt in TIME_FORMATS])


def add_months_keep_offset(ts: Column, months: Column) -> Column:
    """Shift whole months and keep the offset from the start of the month."""
    start = F.date_trunc("month", ts)
    offset_us = F.unix_micros(ts.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    shifted = F.add_months(start, months).cast("timestamp")
    return F.timestamp_micros(F.unix_micros(shifted) + offset_us)


def day_window(day: Column) -> Column:
    """Struct with the first and last microsecond of a day."""
    start = F.date_trunc("day", day).cast("timestamp")
    return F.struct(
        start.alias("start"),
        F.timestamp_micros(F.unix_micros(start) + F.lit(86_400_000_000 - 1)).alias("end"),
    )


def snow_season(year: Column) -> Column:
    """Season of a hydrological year: 1 May to 1 October."""
    return F.struct(
        F.make_date(year, F.lit(5), F.lit(1)).alias("start"),
        F.make_date(year, F.lit(10), F.lit(1)).alias("end"),
    )


def month_bounds(year: Column, month: Column) -> Column:
    start = F.make_date(year, month, F.lit(1))
    return F.struct(start.alias("start"), F.add_months(start, F.lit(1)).alias("end"))


def packed_day(ts: Column) -> Column:
    """``YYYYMMDD`` as an integer."""
    return F.date_format(ts, "yyyyMMdd").cast("int")


def packed_time(ts: Column) -> Column:
    """``HHMMSS`` as an integer."""
    return F.date_format(ts, "HHmmss").cast("int")


def hours_between(start: Column, end: Column) -> Column:
    return (
        F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    ) / F.lit(3_600_000_000.0)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
