"""Operations report built from the job tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame

from firnline.operators import jobs as jb
from firnline.operators import reporting as rp


def operations_report(
    optical: DataFrame,
    parents: DataFrame,
    log: DataFrame,
    tiles: DataFrame,
    low: Any,
    high: Any,
    now: Column,
    made: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All report tables of a period.

    ``optical`` needs the columns of the optical family plus ``tile_id`` and
    ``product_publication_date``.  ``made`` (``family, created``) holds the jobs of
    all families; with it the report has ``bands``, silent days included.
    """
    unique = jb.dedup_jobs(optical)
    monthly = rp.monthly_report(unique, low, high)
    times = rp.turnaround(unique)
    last = jb.last_status(log)
    report = {
        "monthly": monthly,
        "turnaround": times,
        "turnaround_hist": rp.turnaround_hist(times, "hours_total"),
        "kpi": rp.turnaround_kpi(times),
        "coverage": rp.coverage_stats(optical, tiles),
        "all_products": jb.all_products({"optical": optical}, parents),
        "duplicates": jb.duplicate_products(optical, "snow_path"),
        "stuck": jb.stuck_jobs(last, now),
        "publication_failures": jb.publication_failures(log),
    }
    if made is not None:
        report["bands"] = rp.production_bands(made)
    return report
