"""Operations reports: turnaround, coverage, production counts, monthly table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firnline import codes
from firnline.functions.times import hours_between
from firnline.operators.filters import in_range


def turnaround(jobs: DataFrame) -> DataFrame:
    """Hours from source to hub publication and from hub arrival to completion,
    for nominal standard jobs; both null when nothing was produced."""
    made = F.col("snow_path").isNotNull()
    return (
        jobs.where((F.col("processing_type") == "standard") & (F.col("run_mode") == "nominal"))
        .withColumn(
            "hours_total",
            F.when(made, hours_between(F.col("source_publication_date"), F.col("product_publication_date"))),
        )
        .withColumn(
            "hours_processing",
            F.when(made, hours_between(F.col("hub_publication_date"), F.col("completion_date"))),
        )
        .withColumn("made", made)
    )


def turnaround_hist(df: DataFrame, hours: str, minutes: int = 5) -> DataFrame:
    """Counts per bin of ``minutes``, empty bins included, up to the ceiling of
    the largest value but at least three hours."""
    bin_of = F.floor(F.col(hours) * F.lit(60.0) / F.lit(float(minutes)))
    per_hour = 60 // minutes
    known = df.where(F.col(hours).isNotNull())
    counts = known.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n_jobs"))
    top = known.agg(F.greatest(F.lit(codes.KPI_HOURS), F.ceil(F.max(hours)).cast("int")).alias("top"))
    bins = top.select(
        F.explode(
            F.sequence(F.lit(0).cast("long"), (F.coalesce("top", F.lit(codes.KPI_HOURS)) * per_hour).cast("long"))
        ).alias("bin")
    )
    return bins.join(counts, "bin", "left").select(
        "bin",
        (F.col("bin") * minutes).alias("from_minute"),
        F.coalesce("n_jobs", F.lit(0)).cast("long").alias("n_jobs"),
    )


def turnaround_kpi(df: DataFrame, hours: int = codes.KPI_HOURS) -> DataFrame:
    """Share of products within the target and share of jobs with a product."""
    return df.agg(
        F.count("*").alias("n_jobs"),
        F.count_if("made").alias("n_made"),
        (F.count_if("made") / F.count("*")).alias("success_ratio"),
        F.avg((F.col("hours_total") < hours).cast("double")).alias("share_total"),
        F.avg((F.col("hours_processing") < hours).cast("double")).alias("share_processing"),
    )


def production_bands(jobs: DataFrame, bands: DataFrame | None = None, family: str = "family", time: str = "created") -> DataFrame:
    """Jobs created per family and day against the nominal band.

    Every family of the bands has a row for every day from the first to the last
    of ``jobs``, so a day on which it made nothing is reported too.  Families
    without a band have rows for their own days.
    """
    return days_in_bands(jobs.groupBy(family, F.to_date(time).alias("day")).agg(F.count("*").alias("n_jobs")), bands, family)


def days_in_bands(daily: DataFrame, bands: DataFrame | None = None, family: str = "family", since: Any = None) -> DataFrame:
    """Counts per family and day (``day, n_jobs``) against the bands, see
    :func:`production_bands`; days are reported from the one behind ``since`` on."""
    start = F.min("day") if since is None else F.date_add(F.lit(since).cast("date"), 1)
    days = daily.agg(start.alias("d0"), F.max("day").alias("d1")).where("d0 <= d1")
    if bands is None:
        rows = [F.struct(F.lit(n).alias("family"), F.lit(lo).alias("lower"), F.lit(hi).alias("upper")) for n, lo, hi in codes.PRODUCTION_BANDS]
        listed = days.select("d0", "d1", F.explode(F.array(*rows)).alias("b"))
    else:
        # one row each, so this makes no pairs
        row = F.struct(F.col(family).alias("family"), F.col("lower"), F.col("upper"))
        every = bands.agg(F.collect_list(row).alias("bs"), F.lit(1).alias("one"))
        listed = days.withColumn("one", F.lit(1)).join(every, "one").select("d0", "d1", F.explode("bs").alias("b"))
    calendar = listed.where("d0 is not null").select(
        F.col("b.family").alias(family), "b.lower", "b.upper", F.explode(F.sequence("d0", "d1")).alias("day")
    )
    daily = daily.join(calendar, [family, "day"], "full").withColumn("n_jobs", F.coalesce("n_jobs", F.lit(0)).cast("long"))
    return daily.withColumn(
        "verdict",
        F.when(F.col("n_jobs") < F.col("lower"), "below")
        .when(F.col("n_jobs") > F.col("upper"), "above")
        .otherwise("nominal"),
    )


def coverage_per_tile(jobs: DataFrame, tiles: DataFrame) -> DataFrame:
    """Products per tile of the area of interest, zero included."""
    counts = jobs.groupBy("tile_id").agg(F.count("*").alias("n_products"))
    return (
        tiles.select("tile_id")
        .distinct()
        .join(counts, "tile_id", "left")
        .select("tile_id", F.coalesce("n_products", F.lit(0)).cast("long").alias("n_products"))
    )


def coverage_stats(jobs: DataFrame, tiles: DataFrame) -> DataFrame:
    """Number of tiles for each number of products."""
    return (
        coverage_per_tile(jobs, tiles)
        .groupBy("n_products")
        .agg(F.count("*").alias("n_tiles"))
    )


def area_share(jobs: DataFrame, tiles: DataFrame) -> DataFrame:
    """Percent of jobs lying on tiles of the area of interest."""
    known = tiles.select("tile_id").distinct().withColumn("_in", F.lit(True))
    return jobs.join(known, "tile_id", "left").agg(
        F.count("*").alias("n_jobs"),
        (F.lit(100.0) * F.count_if(F.coalesce("_in", F.lit(False))) / F.count("*")).alias("percent_in_area"),
    )


def monthly_report(
    jobs: DataFrame, low: Any, high: Any, tracked_on: str = "source_publication_date", made_on: str = "completion_date"
) -> DataFrame:
    """Jobs tracked by source publication together with jobs generated in the
    period.  ``jobs`` must be de-duplicated (one per source and type).

    Generated jobs win; a tracked source without any generated job is added.
    """
    standard = F.col("processing_type") == "standard"
    tracked = jobs.where(in_range(F.col(tracked_on), F.lit(low), F.lit(high)) & standard)
    made = jobs.where(in_range(F.col(made_on), F.lit(low), F.lit(high)))
    tracked_ids = tracked.select("l1c_id").distinct().withColumn("_tracked", F.lit(True))
    labelled = made.join(tracked_ids, "l1c_id", "left").select(
        *jobs.columns,
        F.when(standard & F.col("_tracked"), "both").otherwise("generated_within_period").alias("request_selection"),
    )
    rest = tracked.join(made.select("l1c_id"), "l1c_id", "left_anti").withColumn(
        "request_selection", F.lit("l1c_tracking")
    )
    return labelled.unionByName(rest.select(*labelled.columns))


def share_within_group(df: DataFrame, keys: list[str], count: str) -> Column:
    """Share of ``count`` in its group (for use on already aggregated rows)."""
    return F.col(count) / F.sum(count).over(Window.partitionBy(*keys))
