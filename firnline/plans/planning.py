"""Planning jobs: gap-fill triggers, radar assemblies, optical series."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline import codes
from firnline.functions.geometry import overlap_in_utm
from firnline.functions.ids import id_token
from firnline.functions.rules import priority
from firnline.operators import jobs as jobs_ops
from firnline.operators import products as pr
from firnline.operators import series, slices, spatial
from firnline.operators.filters import split_reprocessed
from firnline.scale import earliest_by, epoch_us
from firnline.session import cut_lineage

OPTICAL_TYPE = "FSC"  # fixed value: product type of the optical snow product
GAP_FILLED_TYPE = "GFSC"  # fixed value: product type of the gap-filled product
OPEN = (1, 2, 3)  # initialized, configured, ready


# --- gap-fill planning ------------------------------------------------------------
def plan_gap_filling(
    new_products: DataFrame,
    catalogue: DataFrame,
    known_jobs: DataFrame,
    curation: Column,
    start: Any,
    span: int = 7,
) -> dict[str, DataFrame]:
    """Gap-fill jobs from newly published products.

    ``new_products`` / ``catalogue``: ``product_id, tile_id, measurement_date,
    publication_date``.  ``known_jobs``: ``triggering_product_id, tile_id,
    product_date``.  Gives ``jobs``, their ``inputs`` in long form, and
    ``reprocessed`` jobs of measurements before ``start``.
    """
    fresh = new_products.join(
        known_jobs.select(F.col("triggering_product_id").alias("product_id")), "product_id", "left_anti"
    )
    jobs = fresh.select(
        F.col("product_id").alias("triggering_product_id"),
        "tile_id",
        F.to_date("measurement_date").alias("product_date"),
        "measurement_date",
        F.col("publication_date").alias("triggering_product_publication_date"),
        curation.cast("timestamp").alias("curation_timestamp"),
    )
    optical = id_token(F.col("triggering_product_id"), 0) == OPTICAL_TYPE
    single = pr.one_trigger(
        jobs, ["product_date", "tile_id"], optical, ["triggering_product_publication_date", "triggering_product_id"]
    )
    valid, reprocessed = split_reprocessed(single, start)
    inputs = pr.inputs_in_window(
        valid.drop("measurement_date"), catalogue, span, ("product_id", "measurement_date", "publication_date")
    ).select("triggering_product_id", "tile_id", "product_date", "product_id", "measurement_date", "publication_date")
    return {
        "jobs": valid.orderBy("triggering_product_publication_date"),
        "inputs": inputs,
        "reprocessed": reprocessed,
    }


def configure_gap_filling(
    jobs: DataFrame, inputs: DataFrame, now: Column, early_release: bool = False, job: str = "triggering_product_id"
) -> DataFrame:
    """State of each planned job.

    cancelled: a nominal trigger whose provisional twin is an input, or another
    job of the tile and date is curated later; ready: not optical, or held for
    three hours; waiting: otherwise.  The published rule lets an optical trigger
    wait the full time even when a radar product of the day is there;
    ``early_release`` releases it then.  ``job`` is the column that tells jobs apart
    where one product triggers several.
    """
    trigger = F.col("triggering_product_id")
    twin = F.when(
        F.element_at(F.split(trigger, "_"), -1) == "1", F.regexp_replace(trigger, "1$", "0")
    )
    used = inputs.select(job, F.col("product_id").alias("_twin")).distinct()
    doomed = (
        jobs.withColumn("_twin", twin)
        .join(used, [job, "_twin"], "left_semi")
        .select(job)
        .distinct()
        .withColumn("twin_used", F.lit(True))
    )
    ranked = pr.supersede(jobs, ["tile_id", "product_date"], "curation_timestamp", job)
    optical = id_token(trigger, 0) == OPTICAL_TYPE
    same_day_radar = (
        inputs.where((id_token(F.col("product_id"), 0) != OPTICAL_TYPE) & (F.to_date("measurement_date") == F.col("product_date")))
        .select(job)
        .distinct()
        .withColumn("partner", F.lit(True))
    )
    waited = epoch_us(now) - epoch_us("triggering_product_publication_date")
    held = waited >= F.lit(codes.HOLD_HOURS * 3_600_000_000)
    if early_release:
        held = held | F.coalesce("partner", F.lit(False))
    state = (
        F.when(F.coalesce("twin_used", F.lit(False)) | F.col("cancelled"), "cancelled")
        .when(~optical | held, "ready")
        .otherwise("waiting")
    )
    return (
        ranked.join(doomed, job, "left")
        .join(same_day_radar, job, "left")
        .withColumn("state", state)
        .drop("twin_used", "partner")
    )


def daily_gap_jobs(
    tiles: DataFrame, catalogue: DataFrame, gap_filled: DataFrame, day: Any, now: Column, published: Column, span: int = 7
) -> DataFrame:
    """One job per tile that got no product on ``day``, made from its newest
    gap-filled product; none at all when no tile got any (an interruption)."""
    date = F.lit(day).cast("date")
    of_day = catalogue.where(F.to_date("measurement_date") == date)
    recent = gap_filled.where(
        (F.to_date("measurement_date") >= F.date_sub(date, 2 * span)) & (F.to_date("measurement_date") <= date)
    )
    running = of_day.agg((F.count("*") > 0).alias("any")).scalar()
    return pr.idle_tiles(tiles, of_day, recent, day, span).where(running).select(
        F.col("product_id").alias("triggering_product_id"), "tile_id", "product_date",
        published.alias("triggering_product_publication_date"), now.cast("timestamp").alias("curation_timestamp"),
    )


def gap_filling_round(
    catalogue: DataFrame,
    gap_filled: DataFrame,
    contents: DataFrame,
    known: DataFrame,
    tiles: DataFrame,
    now: Any,
    start: Any,
    day: Any = None,
    span: int = 7,
    early_release: bool = False,
) -> dict[str, DataFrame]:
    """One round of gap-fill planning: search, new and daily jobs, states, inputs.

    ``catalogue``: optical and radar snow products (``product_id, tile_id,
    measurement_date, publication_date``); ``gap_filled``: ``product_id, tile_id,
    measurement_date``; ``contents``: ``product_id, input_id`` of the products inside a
    gap-filled one; ``known``: jobs made before (``triggering_product_id, tile_id,
    product_date, curation_timestamp, triggering_product_publication_date,
    last_status_id``); ``tiles``: ``tile_id``.  ``day``: day to make daily jobs for,
    None for a round without.

    The search goes on where the last job's product was published, a second
    earlier, or at midnight a day before ``now`` when no job was ever made.  Jobs not
    yet started are judged again together with the new ones.  A ready job takes the
    newest gap-filled product of its tile along, and a date whose products are all
    inside that one leaves its inputs.

    Gives ``jobs`` (``origin`` new, open or daily; ``state``; ``gap_filled_id``),
    ``inputs`` in long form with ``used``, and ``reprocessed`` jobs.
    """
    at = F.lit(now).cast("timestamp")
    mark = jobs_ops.high_water_mark(known, "triggering_product_publication_date", at, 1, whole_days=True)
    since = mark.select("date_min").scalar()
    optical = id_token(F.col("product_id"), 0) == OPTICAL_TYPE
    fresh = catalogue.where(
        (F.col("publication_date") > since) & (F.col("publication_date") < at)
        & (~optical | (epoch_us("measurement_date") >= epoch_us(since) - F.lit(span * 86_400_000_000)))
    ).join(tiles.select("tile_id").distinct(), "tile_id", "left_semi")
    planned = plan_gap_filling(fresh, catalogue, known, at, start, span)
    columns = ["triggering_product_id", "tile_id", "product_date", "triggering_product_publication_date", "curation_timestamp"]
    jobs = planned["jobs"].select(*columns, F.lit("new").alias("origin")).unionByName(
        known.where(F.col("last_status_id").isin(*OPEN)).select(*columns, F.lit("open").alias("origin"))
    )
    if day is not None:
        last = known.agg(F.max("triggering_product_publication_date").cast("timestamp").alias("t")).scalar()
        daily = daily_gap_jobs(tiles, catalogue, gap_filled, day, at, F.coalesce(last, since), span)
        unknown = daily.join(known.select("triggering_product_id", "product_date"), ["triggering_product_id", "product_date"], "left_anti")
        jobs = jobs.unionByName(unknown.select(*columns, F.lit("daily").alias("origin")))
    # one gap-filled product may trigger jobs of several days
    jobs = jobs.withColumn("job_id", F.concat_ws("@", "triggering_product_id", F.date_format("product_date", "yyyyMMdd")))
    from_gaps = id_token(F.col("triggering_product_id"), 0) == GAP_FILLED_TYPE
    inputs = cut_lineage(
        pr.inputs_in_window(
            jobs.where(~from_gaps), catalogue, span, ("product_id", "measurement_date")
        ).select("job_id", "triggering_product_id", "product_date", "product_id", "measurement_date", F.to_date("measurement_date").alias("day"))
    )
    judged = configure_gap_filling(jobs, inputs, at, early_release, "job_id")
    counts = inputs.groupBy("job_id").agg(F.count("*").alias("n_inputs"))
    judged = judged.join(counts, "job_id", "left").withColumn("n_inputs", F.coalesce("n_inputs", F.lit(0).cast("long")))
    # without inputs the job is looked at again in a later round
    empty = (F.col("state") == "ready") & (F.col("n_inputs") == 0) & ~from_gaps
    judged = cut_lineage(judged.withColumn("state", F.when(empty, "waiting").otherwise(F.col("state"))))
    ready = judged.where("state = 'ready'")
    searched = pr.inputs_in_window(
        ready.where(~from_gaps).select("job_id", "tile_id", "product_date", "curation_timestamp"), gap_filled, 2 * span + 1,
        ("product_id", "measurement_date"),
    )
    newest = pr.newest_by_curation(searched, ["job_id"]).select("job_id", F.col("product_id").alias("gap_filled_id"))
    own = ready.where(from_gaps).select("job_id", F.col("triggering_product_id").alias("gap_filled_id"))
    taken = newest.unionByName(own)
    inside = taken.join(contents.select(F.col("product_id").alias("gap_filled_id"), "input_id"), "gap_filled_id").select(
        "job_id", F.col("input_id").alias("product_id")
    )
    gone = pr.obsolete_inputs(inputs, inside, "job_id").select("job_id", "product_id").distinct().withColumn("_gone", F.lit(True))
    return {
        "jobs": judged.join(taken, "job_id", "left").select("job_id", *columns, "origin", "state", "gap_filled_id", "n_inputs"),
        "inputs": inputs.join(gone, ["job_id", "product_id"], "left").select(
            "job_id", "product_id", "measurement_date", "day", F.col("_gone").isNull().alias("used")
        ),
        "reprocessed": planned["reprocessed"],
    }


# --- radar assemblies and wet-snow planning ---------------------------------------------
def plan_wet_snow(
    acquisitions: DataFrame,
    tiles: DataFrame,
    tracks: DataFrame,
    mountain_tiles: DataFrame,
    snow: DataFrame,
    existing: DataFrame,
    cell: float = 1.0,
    min_area: float = codes.MIN_OVERLAP_M2,
) -> dict[str, DataFrame]:
    """Wet-snow jobs from radar slices and optical snow products.

    ``acquisitions``: slices with a ring in degrees; ``tiles``: ``tile_id, epsg,
    ring``; ``snow``: ``tile_id, product_id, measurement_date``; ``existing``:
    ``name, wet_snow, wet_dry``.
    """
    lines = spatial.border_lines(slices.duplicate_slices(acquisitions))
    slices_ok = lines.where("valid").drop("valid")
    # two narrow tables many steps read: kept once in the shared folder
    meets = cut_lineage(
        spatial.intersecting(slices_ok.select("product_id", "ring"), tiles, cell).select(
            F.col("a_product_id").alias("product_id"), F.col("b_tile_id").alias("tile_id"), F.col("b_epsg").alias("epsg")
        )
    )
    parts = slices.assemble_slices(slices.stripes(slices_ok, meets))
    names = slices.assembly_names(parts, slices_ok)
    keyed = cut_lineage(parts.join(names, ["stripe_id", "assembly_no"]))

    # tiles of every part, minus those crossing a border line of their part
    part_tiles = (
        keyed.withColumn("epsg", F.element_at(F.split("stripe_id", "_"), -1).cast("int"))
        .join(meets, ["product_id", "epsg"])
        .join(tiles.select("tile_id", F.col("ring").alias("_ring")), "tile_id")
    )
    borders = slices_ok.select("product_id", "line_first", "line_last")
    limits = keyed.join(borders, "product_id").select(
        "assembly_id", "product_id",
        F.explode(
            F.filter(
                F.array(F.when(F.col("exclude_first"), F.col("line_first")), F.when(F.col("exclude_last"), F.col("line_last"))),
                lambda x: x.isNotNull(),
            )
        ).alias("ring"),
    )
    kept = spatial.exclude_crossing(
        part_tiles.select("assembly_id", "product_id", "tile_id", F.col("_ring").alias("ring")),
        limits, ["assembly_id", "product_id"], cell,
    ).select("assembly_id", "tile_id").distinct()

    # overlap in metres over all slices of the assembly meeting the tile
    source = slices_ok.select("product_id", F.col("ring").alias("_slice"), "start_ts", "stop_ts", "published", "rel_orbit", "platform", "take_id")
    members = keyed.select("assembly_id", "product_id").distinct()
    pairs = (
        kept.join(members, "assembly_id")
        .join(meets, ["product_id", "tile_id"])
        .join(source, "product_id")
        .join(tiles.select("tile_id", F.col("ring").alias("_tile")), "tile_id")
    )
    a, b = F.col("_slice"), F.col("_tile")
    grouped = (
        pairs.withColumn("area", overlap_in_utm(a["x"], a["y"], b["x"], b["y"], F.col("epsg")))
        .groupBy("assembly_id", "tile_id", "platform", "take_id")
        .agg(
            F.sum("area").alias("area"), F.min("start_ts").alias("measurement_date"), F.max("stop_ts").alias("stop"),
            F.max("published").alias("published"), F.max("rel_orbit").alias("track"), F.count("*").alias("n_slices"),
        )
    )
    # one assembly per tile and data take: the first in order, even when its
    # overlap then proves too small
    first = earliest_by(grouped, ["platform", "take_id", "tile_id"], ["assembly_id"])
    unique = first.where(F.col("area") >= min_area)
    named = unique.withColumn("name", F.upper(F.concat_ws("_", "tile_id", "take_id", "platform")))
    made = existing.groupBy("name").agg(F.bool_or("wet_snow").alias("_ws"), F.bool_or("wet_dry").alias("_wd"))
    on_mountain = mountain_tiles.select("tile_id").distinct().withColumn("_mountain", F.lit(True))
    # the first snow product of the tile and day is taken by the job
    day_snow = earliest_by(
        snow.withColumn("_day", F.to_date("measurement_date")).select("tile_id", "_day", "product_id", "publication_date"),
        ["tile_id", "_day"], ["publication_date", "product_id"],
    ).withColumnRenamed("product_id", "snow_id").withColumnRenamed("publication_date", "snow_published")
    planned = (
        named.join(made, "name", "left")
        .join(on_mountain, "tile_id", "left")
        .withColumn("_day", F.to_date("measurement_date"))
        .join(day_snow, ["tile_id", "_day"], "left")
        .withColumn("wet_snow", F.coalesce("_mountain", F.lit(False)) & ~F.coalesce("_ws", F.lit(False)))
        .withColumn("wet_dry", F.col("snow_id").isNotNull() & ~F.coalesce("_wd", F.lit(False)))
        .where(F.col("wet_snow") | F.col("wet_dry"))
        .drop("_ws", "_wd", "_mountain", "_day")
    )
    jobs = pr.allowed_tracks(planned, tracks)
    return {"jobs": jobs, "assemblies": keyed}


def readiness_on_master(jobs: DataFrame) -> DataFrame:
    """State of wet-snow jobs from the master job of their assembly.

    ``jobs``: ``id, assembly_master_job_id`` (0 for a master), ``last_status_id,
    assembly_status``.
    """
    master = jobs.select(
        F.col("id").alias("assembly_master_job_id"),
        F.col("last_status_id").alias("_ms"),
        F.col("assembly_status").alias("_ma"),
    )
    state = (
        F.when(F.col("assembly_master_job_id") == 0, "ready")
        .when(F.col("_ms").isNull(), "internal_error")
        .when(F.col("_ms") < codes.STATUS["processed"], "configured")
        .when(F.col("_ma") == "generated", "ready")
        .when(F.col("_ma").isin("empty", "generation_aborted", "deleted"), "cancelled")
        .otherwise("configured")
    )
    return jobs.join(master, "assembly_master_job_id", "left").withColumn("readiness", state).drop("_ms", "_ma")


# --- optical series ------------------------------------------------------------------------
def plan_optical(
    candidates: DataFrame, existing: DataFrame, publication: DataFrame, start: Any
) -> dict[str, DataFrame]:
    """New optical jobs with hub publication date and priority.

    ``candidates``: ``seq, source_id, tile_id, measurement_date, creation_date,
    source_publication_date, nrt``; ``publication``: ``product_id,
    publication_date`` of the hub.
    """
    dated, absent = pr.add_publication(
        candidates.withColumn("product_id", F.col("source_id")), publication
    )
    dated = dated.withColumn("publication_date", F.col("hub_publication_date"))
    new, superseded = pr.new_jobs(dated, existing)
    valid, reprocessed = split_reprocessed(new, start)
    ranked = valid.withColumn(
        "priority",
        priority(F.col("nrt"), F.col("measurement_date"), F.col("source_publication_date"), F.col("hub_publication_date")),
    )
    return {"jobs": ranked, "absent": absent, "superseded": superseded, "reprocessed": reprocessed}


def configure_optical(jobs: DataFrame, allow_backward: bool = True, required: int = codes.BACKWARD_JOBS) -> dict[str, DataFrame]:
    """Predecessor, readiness, mode and backward plan of the open jobs."""
    is_open = F.col("run_mode").isNull()
    previous = series.previous_usable(jobs, asking=is_open)
    state = series.readiness(jobs, previous, is_open)
    # waiting jobs are left out; every other row may serve as predecessor or follower
    waiting = state.where(F.col("readiness") != "ready").select("id")
    modes = series.assign_mode(
        jobs.join(waiting, "id", "left_anti"), previous, required, allow_backward=allow_backward
    )
    long_enough = modes.where(F.col("n_l2a_produced_since_last_init") >= required).join(
        jobs.select("id", F.col("measurement_date").alias("trigger_measurement")), "id"
    )
    issued, replaced = series.backward_plan(jobs, long_enough.select("tile_id", "trigger_measurement"), required)
    return {"state": state, "modes": modes, "reissued": issued, "replaced": replaced}

