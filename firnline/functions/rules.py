"""Status, priority and sensor rules as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firnline import codes
from firnline.functions.times import hours_between


def sensor_code(name: Column) -> Column:
    expr = F.lit(codes.SENSOR_OTHER)
    for label, code in codes.SENSOR_CODES:
        expr = F.when(name == label, F.lit(code)).otherwise(expr)
    return expr


def simple_status(status: Column) -> Column:
    """Five-way summary; a job without status counts as just initialised."""
    s = F.coalesce(status.cast("int"), F.lit(1))
    return (
        F.when(s.isin(11, 12), "successful")
        .when(s < 11, "in_progress")
        .when(s == 14, "system_error")
        .when(s.isin(15, 16), "definitive_error")
        .otherwise("error")
    )


def priority(
    nrt: Column, measured: Column, published: Column, on_hub: Column, current: Column | None = None
) -> Column:
    """``reprocessing`` / ``nrt`` / ``delayed``; a priority already set is kept
    where the near-real-time test fails."""
    in_time = (
        measured.isNotNull()
        & published.isNotNull()
        & on_hub.isNotNull()
        & (hours_between(measured, published) < codes.NRT_SOURCE_HOURS)
        & (hours_between(published, on_hub) < codes.NRT_HUB_HOURS)
    )
    late = F.lit("delayed") if current is None else F.coalesce(current, F.lit("delayed"))
    return (
        F.when(~F.coalesce(nrt, F.lit(False)), "reprocessing")
        .when(F.coalesce(in_time, F.lit(False)), "nrt")
        .otherwise(late)
    )


def status_name(status: Column) -> Column:
    expr = F.lit(None).cast("string")
    for code, name in codes.JOB_STATUS:
        expr = F.when(status == code, F.lit(name)).otherwise(expr)
    return expr
