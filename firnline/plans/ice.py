"""River-ice jobs: radar/optical pairing, product matching, statistics query."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline import codes
from firnline.functions.ids import id_day, id_time, id_token
from firnline.operators import products as pr
from firnline.operators import reaches as rc
from firnline.operators import spatial
from firnline.scale import epoch_us
from firnline.sources.store import scan_products


def pair_radar_optical(
    radar: DataFrame,
    optical: DataFrame,
    done: DataFrame,
    tiles: DataFrame,
    now: Column,
    earliest: Column,
    max_search_days: int = 30,
    min_delay_hours: int | None = None,
    max_wait_hours: int = 48,
    min_search_days: int | None = None,
    literal_delay: bool = True,
) -> dict[str, DataFrame]:
    """Pair radar and optical ice products of a tile-day.

    Both: ``job_id, tile_id, day, sensing_time, path, published, status``, radar
    with ``satellite``.  A day with unfinished radar jobs is skipped until
    ``max_wait_hours`` after its end.  With ``min_search_days`` the search walks
    back from the newest day and stops, beyond that many days, after a day that
    gave no pair.  Gives ``pairs`` (one row per tile-day)
    and ``inputs`` in long form.
    """
    usable = ~F.col("status").isin(13, 16)
    radar, optical = radar.where(usable), optical.where(usable)
    candidates = pr.pairing_days(
        radar, optical, now, earliest, max_search_days, min_delay_hours, literal_delay
    )
    pending = radar.groupBy("day").agg(
        F.count_if(F.col("path").isNull() | F.col("published").isNull()).alias("_pending")
    )
    end_offset = pr.DAY_US if literal_delay else -pr.DAY_US
    waited = epoch_us(now) - epoch_us(F.col("day")) + F.lit(end_offset)
    settled = pending.where(
        (F.col("_pending") == 0) | (waited > F.lit(max_wait_hours * 3_600_000_000))
    ).select("day")
    days = candidates.select("day").join(settled, "day", "left_semi")
    ok = F.col("path").isNotNull() & F.col("published").isNotNull()
    open_tiles = tiles.select("tile_id").distinct()
    r = radar.where(ok).join(days, "day", "left_semi").join(open_tiles, "tile_id", "left_semi")
    o = optical.where(ok).join(days, "day", "left_semi").join(open_tiles, "tile_id", "left_semi")
    r = pr.missing(r, done.select("tile_id", "day").distinct(), ["tile_id", "day"])
    pairs = pr.nearest_satellite(r, o)
    if min_search_days is not None:
        newest = candidates.groupBy().agg(F.max("start_day").alias("start_day"))
        visited = pr.walk_back(newest, pairs.select("day"), min_search_days, max_search_days)
        pairs = pairs.join(visited.select("day"), "day", "left_semi")
    inputs = (
        r.join(pairs.select("tile_id", "day", "satellite"), ["tile_id", "day", "satellite"])
        .select("tile_id", "day", F.lit("radar").alias("kind"), "path", "published")
        .unionByName(
            o.join(pairs.select("tile_id", "day"), ["tile_id", "day"], "left_semi").select(
                "tile_id", "day", F.lit("optical").alias("kind"), "path", "published"
            )
        )
    )
    latest = inputs.groupBy("tile_id", "day").agg(
        F.max(F.when(F.col("kind") == "radar", F.col("published"))).alias("radar_published"),
        F.max(F.when(F.col("kind") == "optical", F.col("published"))).alias("optical_published"),
    )
    return {"pairs": pairs.join(latest, ["tile_id", "day"]).orderBy("day", "tile_id"), "inputs": inputs}


def with_id_tokens(products: DataFrame) -> DataFrame:
    """Tile, day, version, mode and time columns read from the product id."""
    pid = F.col("product_id")
    return products.select(
        "product_id",
        F.substring(id_token(pid, 3), 2, 5).alias("tile_id"),
        id_day(pid).alias("day"),
        F.substring(id_token(pid, 4), 2, 8).cast("int").alias("version"),
        F.element_at(F.split(pid, "_"), -1).alias("mode"),
        id_time(pid).alias("sensing_time"),
        F.expr("left(split(product_id, '_')[2], 2)").alias("sensor"),
    )


def match_products(ref: DataFrame, search: DataFrame) -> DataFrame:
    """Best product of each side per tile-day, matched."""
    a = pr.best_per_tile_day(with_id_tokens(ref)).select("tile_id", "day", F.col("product_id").alias("ref_id"))
    b = pr.best_per_tile_day(with_id_tokens(search)).select("tile_id", "day", F.col("product_id").alias("search_id"))
    return pr.match_tile_day(a, b)


def match_stores(
    spark: SparkSession, ref_root: str, search_root: str, start: dt.date, end: dt.date, tile_id: str | None = None
) -> DataFrame:
    """The same over two partitioned stores; dates prune the scan."""
    return match_products(
        scan_products(spark, ref_root, start, end, tile_id), scan_products(spark, search_root, start, end, tile_id)
    )


def river_ice(
    reaches: DataFrame,
    values: DataFrame,
    start: Any,
    end: Any,
    polygon: Sequence[tuple[float, float]] | None = None,
    hydro_id: str | None = None,
    cloud_max: int = 100,
    only_size: bool = False,
    limit: int = codes.REACH_LIMIT,
    split: bool = False,
) -> DataFrame:
    """Ice measurements of the reaches meeting a polygon or of one river.

    Exactly one of ``polygon`` and ``hydro_id`` must be given.  A request over
    ``limit`` reaches is refused unless only the size is asked; with ``split`` it is
    given whole in several answers (column ``answer``) of at most ``limit`` reaches.
    """
    if (polygon is None) == (hydro_id is None):
        raise ValueError("give either a polygon or a hydrological id")
    wanted = (
        rc.reaches_by_hydro_id(reaches, hydro_id)
        if hydro_id is not None
        else spatial.intersecting_query(reaches, polygon, "geometry")
    )
    if only_size:
        return rc.measurement_count(values, wanted, start, end, cloud_max)
    if split:
        return rc.measurements(values, rc.in_answers(wanted.select("id").distinct(), limit), start, end, cloud_max)
    rc.guard_size(wanted.select("id"), limit)
    return rc.measurements(values, wanted, start, end, cloud_max)


def river_geometries(
    reaches: DataFrame, polygon: Sequence[tuple[float, float]], ids_only: bool = False, limit: int = codes.REACH_LIMIT,
    split: bool = False,
) -> DataFrame:
    """Reaches meeting a polygon: ids only, or all attributes (size-checked; with
    ``split`` as in :func:`river_ice`)."""
    wanted = spatial.intersecting_query(reaches, polygon, "geometry")
    if ids_only:
        return wanted.select("id")
    if split:
        wanted = rc.in_answers(wanted, limit)
    else:
        rc.guard_size(wanted.select("id"), limit)
    return wanted.withColumn("area", F.expr("floor(area * 100) / 100"))


def missed_inputs(jobs: DataFrame, used: DataFrame) -> DataFrame:
    """Ice products of computed days that the computation did not use."""
    days = used.select("day").distinct()
    return jobs.join(days, "day", "left_semi").join(used.select("day", "product_id"), ["day", "product_id"], "left_anti")


def open_days(jobs: DataFrame, used: DataFrame) -> DataFrame:
    """Days with products but no computation yet."""
    return jobs.select("day").distinct().join(used.select("day").distinct(), "day", "left_anti")
