"""Catalogue products: de-duplication, matching, planning inputs, lineage."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firnline.functions.ids import curation_stamp, toggled_mode_id
from firnline.functions.times import hours_between
from firnline.scale import distinct_days, earliest_by, epoch_us, latest_by

DAY_US = 86_400_000_000


# --- one product per group ---------------------------------------------------
def best_per_tile_day(
    products: DataFrame,
    keys: Sequence[str] = ("tile_id", "day"),
    version: str = "version",
    mode: str = "mode",
    sensed: str = "sensing_time",
    product: str = "product_id",
) -> DataFrame:
    """Highest version, then mode, then latest sensing; ties go to the later id."""
    return latest_by(products, keys, [version, mode, sensed, product])


def latest_version(products: DataFrame, keys: Sequence[str], published: str, product: str) -> DataFrame:
    """Latest publication of each acquisition."""
    return latest_by(products, keys, [published, product])


def newest_by_curation(products: DataFrame, keys: Sequence[str] = ("tile_id",)) -> DataFrame:
    """Gap-filled product with the greatest curation stamp in its id."""
    stamped = products.withColumn("_stamp", curation_stamp(F.col("product_id")))
    return latest_by(stamped, keys, ["_stamp", "product_id"]).drop("_stamp")


def split_products(
    products: DataFrame, n: int = 2, keys: Sequence[str] = ("tile_id", "day"), product: str = "product_id"
) -> DataFrame:
    """Products of tile-days holding ``n`` or more, one row per product.

    The group size travels with each product instead of an array per group.
    """
    sizes = products.groupBy(*keys).agg(F.count("*").alias("n_products")).where(F.col("n_products") >= n)
    return products.join(sizes, list(keys)).select(*keys, product, "n_products")


def match_tile_day(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("tile_id", "day")) -> DataFrame:
    """Pair the best product of each side per tile-day."""
    return a.join(b, list(keys))


def missing(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.join(present.select(*keys), list(keys), "left_anti")


def common_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))


def drop_obsolete(inputs: DataFrame, obsolete: DataFrame, keys: Sequence[str]) -> DataFrame:
    return inputs.join(obsolete.select(*keys), list(keys), "left_anti")


# --- new jobs against known ones ------------------------------------------------
def new_jobs(
    candidates: DataFrame,
    existing: DataFrame,
    valid_hours: float = 24.0,
    tile: str = "tile_id",
    measured: str = "measurement_date",
    source: str = "source_id",
    created: str = "creation_date",
    published: str = "publication_date",
    order: str = "seq",
) -> tuple[DataFrame, DataFrame]:
    """Candidates to keep, and the existing rows that stop being the reference.

    A candidate passes when its tile and measurement are unknown, or when it is
    another version (new id, other creation date) published within
    ``valid_hours`` of its measurement.  Each source id is kept once: its first row
    that passes, so a row refused before does not hide it.
    """
    known = existing.groupBy(tile, measured).agg(
        F.min(created).alias("_c0"), F.max(created).alias("_c1")
    )
    known_ids = existing.select(source).distinct().withColumn("_same_id", F.lit(True))
    joined = candidates.join(known, [tile, measured], "left").join(known_ids, source, "left")
    fresh = F.col("_c0").isNull()
    late = hours_between(F.col(measured), F.col(published)) <= valid_hours
    other = (F.col("_c0") != F.col(created)) | (F.col("_c1") != F.col(created))
    version = ~fresh & F.col("_same_id").isNull() & late & other
    kept = earliest_by(joined.withColumn("_version", version).where(fresh | version), [source], [order])
    new = kept.select(*candidates.columns)
    versions = (
        kept.where("_version")
        .groupBy(tile, measured)
        .agg(F.min(created).alias("_n0"), F.max(created).alias("_n1"))
    )
    superseded = (
        existing.join(versions, [tile, measured])
        .where((F.col("_n0") != F.col(created)) | (F.col("_n1") != F.col(created)))
        .select(*existing.columns)
    )
    return new, superseded


def drop_twin_triggers(jobs: DataFrame, trigger: str = "triggering_product_id", inputs: str = "input_ids") -> DataFrame:
    """Drop a nominal trigger whose provisional twin is already an input."""
    twin = toggled_mode_id(F.col(trigger))
    nominal = F.element_at(F.split(F.col(trigger), "_"), -1) == "1"
    hit = F.coalesce(nominal & F.array_contains(F.col(inputs), twin), F.lit(False))
    return jobs.where(~hit)


def twin_triggers(
    triggers: DataFrame, inputs: DataFrame, job: str = "job_id", trigger: str = "twin_id", product: str = "product_id"
) -> DataFrame:
    """Long-form variant: triggers whose twin is among the job's input rows."""
    used = inputs.select(job, F.col(product).alias(trigger))
    return triggers.join(used, [job, trigger], "left_semi")


def one_trigger(jobs: DataFrame, keys: Sequence[str], optical: Column, order: Sequence[str]) -> DataFrame:
    """One trigger per tile and date, non-optical triggers first."""
    ranked = jobs.withColumn("_optical", optical.cast("int"))
    return earliest_by(ranked, keys, ["_optical", *order]).drop("_optical")


def supersede(jobs: DataFrame, keys: Sequence[str], curated: str, job: str = "id") -> DataFrame:
    """Marks jobs overridden by another of the group with the same or a newer
    curation time; the greatest (time, id) survives."""
    top = jobs.groupBy(*keys).agg(F.max_by(F.col(job), F.struct(curated, job)).alias("overriding_job_id"))
    joined = jobs.join(top, list(keys))
    return joined.withColumn("cancelled", F.col("overriding_job_id") != F.col(job))


def elect_master(
    jobs: DataFrame, existing: DataFrame, assembly: str = "assembly_id", order: str = "id"
) -> DataFrame:
    """Live existing master of the assembly, else the first job of the batch.

    The master itself gets 0.  ``existing`` holds live masters only.
    """
    known = existing.groupBy(assembly).agg(F.max("id").alias("_known"))
    first = jobs.groupBy(assembly).agg(F.min_by("id", F.col(order)).alias("_first"))
    masters = first.join(known, assembly, "left").select(
        assembly, F.coalesce("_known", "_first").alias("_master")
    )
    return jobs.join(masters, assembly).select(
        *jobs.columns,
        F.when(F.col("_master") == F.col("id"), F.lit(0).cast("long"))
        .otherwise(F.col("_master"))
        .alias("assembly_master_job_id"),
    )


# --- pairing in time ---------------------------------------------------------------
def mean_time_of_day(ts: str) -> Column:
    """Mean as microseconds after the start of the day (exact in a double)."""
    return F.avg((epoch_us(ts) % F.lit(DAY_US)).cast("double"))


def nearest_satellite(radar: DataFrame, optical: DataFrame) -> DataFrame:
    """Per tile-day the radar satellite whose mean sensing time is closest to
    the optical mean; ties go to the first satellite."""
    keys = ["tile_id", "day"]
    r = radar.groupBy(*keys, "satellite").agg(
        mean_time_of_day("sensing_time").alias("radar_mean"), F.count("*").alias("n_radar")
    )
    o = optical.groupBy(*keys).agg(
        mean_time_of_day("sensing_time").alias("optical_mean"), F.count("*").alias("n_optical")
    )
    pairs = r.join(o, keys).withColumn("distance_us", F.abs(F.col("radar_mean") - F.col("optical_mean")))
    return earliest_by(pairs, keys, ["distance_us", "satellite"])


def pairing_days(
    radar: DataFrame,
    optical: DataFrame,
    now: Column,
    earliest: Column,
    max_search_days: int | None = None,
    min_delay_hours: int | None = None,
    literal_delay: bool = True,
) -> DataFrame:
    """Days holding both kinds of job, newest first day and the walk-back window.

    ``literal_delay`` keeps the published delay test, which can never hold for a
    past day; switch it off to test against the end of the day instead.
    """
    yesterday = F.date_sub(F.to_date(now), 1)
    start = yesterday
    if min_delay_hours is not None:
        day_start = yesterday.cast("timestamp")
        waited = F.unix_micros(now.cast("timestamp")) - F.unix_micros(day_start)
        waited = waited + F.lit(DAY_US) if literal_delay else waited - F.lit(DAY_US)
        start = F.when(
            waited < F.lit(min_delay_hours * 3_600_000_000), F.date_sub(yesterday, 1)
        ).otherwise(yesterday)
    both = common_keys(radar, optical, ["day"])
    both = both.where((F.col("day") <= start) & (F.col("day") >= F.to_date(earliest)))
    # One row per calendar day at most, so the whole-table window stays small.
    out = both.withColumn("start_day", F.max("day").over(Window.partitionBy(F.lit(1))))
    if max_search_days is not None:
        out = out.where(F.datediff("start_day", "day") <= max_search_days)
    return out


def walk_back(start: DataFrame, made: DataFrame, min_days: int, max_days: int) -> DataFrame:
    """Days visited when walking back from ``start_day``: the walk stops beyond
    ``min_days`` as soon as the day visited before gave nothing.

    ``start``: one row with ``start_day``; ``made``: one row per day that gave
    something.  At most ``max_days + 1`` rows are handled.
    """
    line = start.select("start_day", F.explode(F.sequence(F.lit(0), F.lit(max_days))).alias("back"))
    line = line.withColumn("day", F.date_sub("start_day", F.col("back")))
    line = line.join(made.select("day").distinct().withColumn("_made", F.lit(True)), "day", "left")
    ends = F.when(F.col("_made").isNull() & (F.col("back") + 1 > min_days), F.col("back") + 1)
    stop = F.min(ends).over(Window.partitionBy(F.lit(1)))
    line = line.withColumn("_stop", F.coalesce(stop, F.lit(max_days + 1)))
    return line.where(F.col("back") < F.col("_stop")).select("day", "start_day", "back")


def inputs_in_window(
    triggers: DataFrame,
    products: DataFrame,
    span: int = 7,
    product_columns: Sequence[str] = ("product_id", "measurement_date"),
) -> DataFrame:
    """All products of the trigger's tile inside its aggregation window.

    The window ends at the curation time on the curation day, else at the end of
    the product day, and starts at midnight ``span - 1`` days earlier.  It is
    cut into days so the join is an equi-join on tile and day.
    """
    product_day = F.to_date("product_date")
    same_day = product_day == F.to_date("curation_timestamp")
    day_end = F.timestamp_micros(epoch_us(F.date_add(product_day, 1).cast("timestamp")) - F.lit(1))
    end = F.when(same_day, F.col("curation_timestamp").cast("timestamp")).otherwise(day_end)
    t = triggers.withColumn("window_end", end).withColumn(
        "window_start", F.date_sub(F.to_date("window_end"), span - 1).cast("timestamp")
    )
    t = t.withColumn(
        "_day", F.explode(F.sequence(F.to_date("window_start"), F.to_date("window_end")))
    )
    p = products.select(
        "tile_id", F.to_date("measurement_date").alias("_day"), *product_columns
    )
    inside = (F.col("measurement_date").cast("timestamp") >= F.col("window_start")) & (
        F.col("measurement_date").cast("timestamp") <= F.col("window_end")
    )
    return t.join(p, ["tile_id", "_day"]).where(inside).drop("_day")


def wet_snow_candidates(
    radar: DataFrame, snow: DataFrame, existing: DataFrame, keys: Sequence[str] = ("tile_id", "day")
) -> DataFrame:
    """Radar tiles with a snow product on the day, less those already made."""
    return radar.join(snow, list(keys)).join(existing.select(*keys).distinct(), list(keys), "left_anti")


def allowed_tracks(df: DataFrame, tracks: DataFrame, tile: str = "tile_id", track: str = "track") -> DataFrame:
    """Acquisitions whose tile and track have auxiliary data.

    ``tracks`` holds one array of tracks per tile.
    """
    allowed = tracks.select(F.col("tile_id").alias(tile), F.explode("tracks").alias(track))
    return df.join(allowed, [tile, track], "left_semi")


def idle_tiles(
    tiles: DataFrame,
    inputs: DataFrame,
    gap_filled: DataFrame,
    day: Any,
    span: int = 7,
) -> DataFrame:
    """Tiles without input, with their newest gap-filled product.

    Skipped when that product is at least ``span`` days older than the start of
    the day, or already of the day.
    """
    idle = tiles.select("tile_id").join(inputs.select("tile_id"), "tile_id", "left_anti")
    newest = newest_by_curation(gap_filled.join(idle, "tile_id", "left_semi"))
    day_col = F.lit(day).cast("date")
    recent = epoch_us(day_col) < epoch_us("measurement_date") + F.lit(span * DAY_US)
    return newest.where(recent & (F.to_date("measurement_date") != day_col)).withColumn("product_date", day_col)


def add_publication(
    jobs: DataFrame, catalogue: DataFrame, product: str = "product_id", published: str = "publication_date"
) -> tuple[DataFrame, DataFrame]:
    """Jobs with their hub publication date, and the jobs whose product is absent."""
    dates = catalogue.groupBy(product).agg(F.max(published).alias("hub_publication_date"))
    joined = jobs.join(dates, product, "left")
    known = F.col("hub_publication_date").isNotNull()
    return joined.where(known), joined.where(~known).drop("hub_publication_date")


def latest_input(jobs: DataFrame, job: str, date: str) -> DataFrame:
    """Latest date over the input rows of each job."""
    return jobs.groupBy(job).agg(F.max(date).alias("latest_date"))


def latest_of_array(dates: Column) -> Column:
    return F.array_max(dates)


def collect_inputs(products: DataFrame, keys: Sequence[str], product: str, date: str) -> DataFrame:
    """Inputs per group in long form, with the group's size and latest date.

    Rows stay separate so that a crowded group is never held by one task.
    """
    summary = products.groupBy(*keys).agg(
        F.count("*").alias("n_inputs"), F.max(date).alias("latest_date")
    )
    return products.select(*keys, product, date).join(summary, list(keys))


# --- lineage ------------------------------------------------------------------------
def product_span(edges: DataFrame, product: str = "product_id") -> DataFrame:
    """First begin and last end over the distinct inputs of each product."""
    return (
        edges.dropDuplicates([product, "input_id"])
        .groupBy(product)
        .agg(F.min("begin").alias("span_begin"), F.max("end").alias("span_end"), F.count("*").alias("n_inputs"))
    )


def obsolete_inputs(inputs: DataFrame, edges: DataFrame, job: str = "job_id") -> DataFrame:
    """Inputs of dates that are wholly part of the job's gap-filled input.

    ``inputs``: job, product_id, day.  ``edges``: job, product_id of the inputs
    already inside.  A date counts only when all of its products are inside.
    """
    inside = edges.select(job, "product_id").distinct().withColumn("_hit", F.lit(True))
    marked = inputs.join(inside, [job, "product_id"], "left").withColumn(
        "_hit", F.coalesce("_hit", F.lit(False))
    )
    whole = marked.groupBy(job, "day").agg(F.bool_and("_hit").alias("_all")).where("_all")
    return inputs.join(whole.select(job, "day"), [job, "day"], "left_semi")


# --- days -----------------------------------------------------------------------------
def search_intervals(days: DataFrame, keys: Sequence[str] = (), day: str = "day", gap: int = 5) -> DataFrame:
    """Runs of days with no hole above ``gap`` days.

    Days are made distinct first: a key then holds at most one row per calendar
    day, which bounds the ordered window whatever the input size.
    """
    d = distinct_days(df=days, keys=keys, day=day)
    w = Window.partitionBy(*keys).orderBy(day)
    broken = F.coalesce((F.datediff(F.col(day), F.lag(day).over(w)) > gap).cast("int"), F.lit(0))
    return (
        d.withColumn("_break", broken)
        .withColumn("_run", F.sum("_break").over(w))
        .groupBy(*keys, "_run")
        .agg(F.min(day).alias("date_min"), F.max(day).alias("date_max"), F.count("*").alias("n_days"))
        .drop("_run")
    )


def check_support(products: DataFrame, error: int = 5, warning: int = 20) -> DataFrame:
    """Products per tile against the minimum support of a season statistic."""
    level = F.when(F.col("n_products") < error, "error").when(F.col("n_products") < warning, "warning")
    return (
        products.groupBy("tile_id")
        .agg(F.count("*").alias("n_products"))
        .withColumn("level", level.otherwise("ok"))
    )


def duplicate_slices(acquisitions: DataFrame) -> DataFrame:
    """First acquisition per platform, data take and slice (or start time when
    the slice number is 0)."""
    tag = F.when(F.col("slice") != 0, F.col("slice").cast("string")).otherwise(
        F.date_format("start_ts", "yyyyMMddHHmmss")
    )
    return earliest_by(
        acquisitions.withColumn("_tag", tag), ["platform", "take_id", "_tag"], ["seq"]
    ).drop("_tag")
