"""Snow jobs: gap filling, wet/dry classes, quality layers, season maps."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline import codes
from firnline.functions.bits import set_bit
from firnline.functions.quality import expert_flags, snow_quality
from firnline.operators import pixels as px
from firnline.operators import spatial
from firnline.operators.products import check_support, drop_obsolete, product_span
from firnline.scale import Payload, fold_order


# --- gap-filled snow cover -----------------------------------------------------
def gap_filled_day(
    snow: DataFrame,
    wet: DataFrame,
    water: DataFrame,
    day: Any,
    span: int = 7,
    scale: int = 3,
    previous: DataFrame | None = None,
    obsolete: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Gap-filled snow cover of one day for every tile given.

    ``snow``: fine pixels (``product_id, product_ts, tile_id, row, col, value,
    qc, flags, acq_epoch``); ``wet``: coarse wet-snow pixels; ``water``: coarse
    water mask; ``previous``: earlier gap-filled pixels at the coarse size;
    ``obsolete``: product ids already inside ``previous``.
    """
    day_col = F.lit(day).cast("date")
    if obsolete is not None:
        snow = drop_obsolete(snow, obsolete, ["product_id"])
        wet = drop_obsolete(wet, obsolete, ["product_id"])
    first_day = F.date_sub(day_col, span - 1)

    def in_window(df: DataFrame) -> DataFrame:
        dated = df.withColumn("day", F.to_date("product_ts"))
        return dated.where((F.col("day") >= first_day) & (F.col("day") <= day_col))

    snow = in_window(snow)
    if scale > 1:
        snow = px.upscale_layers(snow, scale, ["tile_id", "day", "product_id"], carry=["product_ts", "acq_epoch"])
    # From here on every step is keyed by the pixel or by pixel and day: placed by
    # pixel once, the daily fill, the water join and the window fill move nothing.
    daily = fill_days(snow, in_window(wet))
    flagged = px.flag_water(daily, water.repartition(*px.PIXEL))
    # a day's own result is stamped at midnight, an earlier gap-filled product at its
    # date; of the same date the day's own result is the newer one
    own = flagged.select(
        *px.PIXEL, F.col("day").cast("timestamp").alias("product_ts"), F.lit(1).alias("own"), "value", "qc", "flags", "acq_epoch"
    )
    if previous is None:
        result = px.temporal_fill(own, day_col, span, order=("product_ts",))
    else:
        earlier = previous.select(*px.PIXEL, "product_ts", F.lit(0).alias("own"), "value", "qc", "flags", "acq_epoch", "product_id")
        stack = own.withColumn("product_id", F.lit(None).cast(dict(previous.dtypes)["product_id"])).unionByName(earlier)
        result = px.temporal_fill(stack, day_col, span, order=("product_ts", "own", "product_id"))
    return {
        "pixels": result.withColumn("day", day_col),
        "cloud": px.cloud_percent(result),
        "daily": flagged,
    }


def fill_days(snow: DataFrame, wet: DataFrame) -> DataFrame:
    """Daily fill of both sources, then wet-snow evidence into the snow gaps.

    The sources are stacked and read by one aggregate per pixel and day; a day
    with radar only starts from an empty snow layer.
    """
    keys = ["tile_id", "day", "row", "col"]

    ids = {dict(df.dtypes)["product_id"] for df in (snow, wet)}
    id_kind = "bigint" if ids <= {"tinyint", "smallint", "int", "bigint"} else "string"

    def tagged(df: DataFrame, radar: bool, flags: Column) -> DataFrame:
        return df.select(
            *keys, F.lit(radar).alias("radar"), "product_ts", F.col("product_id").cast(id_kind).alias("product_id"),
            F.col("value").cast("int").alias("value"), F.col("qc").cast("int").alias("qc"),
            flags.cast("int").alias("flags"), F.col("acq_epoch").cast("long").alias("acq_epoch"),
        )

    rows = tagged(snow, False, F.col("flags")).unionByName(tagged(wet, True, F.lit(0)))
    payload = Payload(rows, {c: F.col(c) for c in ("value", "qc", "flags", "acq_epoch")})

    def newest(radar: bool, gaps: tuple[int, ...]) -> Column:
        valid = ~px.is_gap(F.col("value"), gaps)
        mine = F.col("radar") if radar else ~F.col("radar")
        return F.max_by(payload.packed(), F.when(mine, fold_order(rows, [valid, "product_ts", "product_id"])))

    both = rows.repartition(*px.PIXEL).groupBy(*keys).agg(
        newest(False, codes.SNOW_GAPS).alias("_s"), newest(True, codes.WET_SNOW_GAPS).alias("_w")
    ).select(*keys, *[payload.struct(F.col(c)).alias(c) for c in ("_s", "_w")])
    empty = F.struct(
        F.lit(codes.NODATA).alias("value"), F.lit(codes.NODATA).alias("qc"), F.lit(0).alias("flags"),
        F.lit(0).cast("long").alias("acq_epoch"),
    )
    snow_px = F.coalesce(F.col("_s"), empty)
    take = px.is_gap(snow_px["value"]) & F.coalesce(F.col("_w.value") == codes.WET, F.lit(False))
    return both.select(
        *keys,
        F.when(take, F.lit(100)).otherwise(snow_px["value"]).alias("value"),
        F.when(take, F.col("_w.qc")).otherwise(snow_px["qc"]).alias("qc"),
        F.when(take, set_bit(snow_px["flags"], 6, F.lit(1))).otherwise(snow_px["flags"]).alias("flags"),
        F.when(take, F.col("_w.acq_epoch")).otherwise(snow_px["acq_epoch"]).alias("acq_epoch"),
    )


def gap_fill_metadata(edges: DataFrame, result: DataFrame, extents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Time span over the inputs, and the footprint of the valid pixels."""
    return product_span(edges), spatial.valid_footprint(result, extents, keys=("tile_id",))


# --- wet / dry snow ------------------------------------------------------------------
def wet_dry_snow(radar: DataFrame, snow: DataFrame, scale: int = 3) -> DataFrame:
    """Wet/dry/free classes from a radar stack and fine optical snow scenes.

    ``radar``: ``tile_id, row, col, vh, vv, vh_ref, vv_ref, inc_angle, mask,
    shadow``.  ``snow``: ``tile_id, product_id, scene_order, row, col, value``;
    later scenes overwrite earlier ones.
    """
    keys = ["tile_id", "row", "col"]
    ratio = px.wet_snow_ratio(radar)
    scenes = px.observed_blocks(snow, scale)
    state, wet = F.col("state"), F.col("wet_value")
    joined = ratio.join(scenes, keys, "left")
    value = (
        F.when((state == "snow") & (wet == codes.WET), codes.WET)
        .when((state == "snow") & (wet == codes.NOT_WET), codes.DRY)
        .when(state == "free", codes.SNOW_FREE)
        .when(state == "cloud", codes.CLOUD)
    )
    qc = F.when((state == "snow") & (wet == codes.WET), F.col("wet_qc")).when(
        value.isNotNull(), codes.MASKED
    )
    seen = F.when(state.isin("snow", "free"), 1).when(state == "cloud", 2)
    # the place of a scene in its tile's stack, so an int holds it
    place = F.col("scene_order").cast("int") if dict(joined.dtypes)["scene_order"] == "bigint" else F.col("scene_order")
    order = fold_order(joined, [place, "product_id"])
    seen_value = Payload(joined, {"value": value.cast("int"), "qc": qc.cast("int")})
    folded = joined.groupBy(*keys).agg(
        F.max_by(seen_value.packed(), F.when(value.isNotNull(), order)).alias("_p"),
        F.max_by(seen, F.when(seen.isNotNull(), order)).alias("_seen"),
        F.max(px.merged_mask(F.col("mask"), F.col("shadow"))).alias("_mask"),
        F.bool_and("valid").alias("_valid"),
    ).withColumn("_p", seen_value.struct(F.col("_p")))
    masked = (F.col("_seen") == 1) & (F.col("_mask") != 0)
    out_value = F.when(masked, F.col("_mask")).otherwise(F.coalesce("_p.value", F.lit(codes.NODATA)))
    out_qc = F.when(masked, F.lit(codes.MASKED)).otherwise(F.coalesce("_p.qc", F.lit(codes.NODATA)))
    return folded.select(
        *keys,
        F.when(F.col("_valid"), out_value).otherwise(codes.NODATA).cast("int").alias("value"),
        F.when(F.col("_valid"), out_qc).otherwise(codes.NODATA).cast("int").alias("qc"),
    )


def wet_snow(radar: DataFrame) -> DataFrame:
    """Wet-snow map over mountains; needs ``mountain`` and ``snowmask`` besides
    the radar stack."""
    ratio = px.wet_snow_ratio(radar)
    mask = px.merged_mask(F.col("mask"), F.col("shadow"))
    value = F.when(mask != 0, mask).otherwise(F.col("wet_value"))
    qc = F.when(mask != 0, codes.MASKED).otherwise(F.col("wet_qc"))
    value, qc = (
        F.when(F.col("mountain") != 0, codes.NON_MOUNTAIN).otherwise(value),
        F.when(F.col("mountain") != 0, codes.MASKED).otherwise(qc),
    )
    bare = (F.col("snowmask") < 30) & (value == codes.WET)
    value, qc = F.when(bare, codes.NOT_WET).otherwise(value), F.when(bare, codes.MASKED).otherwise(qc)
    return ratio.select(
        "tile_id", "row", "col",
        F.when(F.col("valid"), value).otherwise(codes.NODATA).cast("int").alias("value"),
        F.when(F.col("valid"), qc).otherwise(codes.NODATA).cast("int").alias("qc"),
    )


# --- quality layers ---------------------------------------------------------------------
def snow_quality_layers(layers: DataFrame) -> DataFrame:
    """Expert flags and both quality layers from an aligned stack with
    ``geo_flags, water, tcd, cloud_mask, snow_toc, snow_og``."""
    flagged = layers.withColumn(
        "flags",
        expert_flags(F.col("geo_flags"), F.col("water"), F.col("tcd"), F.col("cloud_mask"), F.col("snow_toc")),
    )
    return flagged.select(
        "tile_id", "row", "col", "flags",
        snow_quality(F.col("flags"), F.col("snow_toc")).alias("qc_toc"),
        snow_quality(F.col("flags"), F.col("snow_og"), F.col("tcd")).alias("qc_og"),
    )


# --- persistent snow -------------------------------------------------------------------
class NotEnoughProducts(ValueError):
    """A tile has too few products for a season statistic."""


def season_map(snow: DataFrame, start: Column, end: Column, strict: bool = True) -> DataFrame:
    """Persistent snow per tile over a season (both dates inclusive)."""
    day = F.to_date("product_ts")
    season = snow.where((day >= start) & (day <= end))
    if strict:
        per_tile = check_support(season.select("tile_id", "product_id").distinct())
        if not per_tile.where(F.col("level") == "error").isEmpty():
            raise NotEnoughProducts(f"a tile has fewer than {codes.SUPPORT_ERROR} products")
    return px.persistent_snow(season)


def season_mosaic(
    tiles_map: DataFrame, sources: DataFrame, targets: DataFrame, source_size: float = 20.0, target_size: float = 20.0
) -> DataFrame:
    """Equal-area mosaic of the tile maps: 1 beats 0 beats nodata.

    ``targets``: ``target_id, ulx, uly, nrows, ncols`` and the LAEA ``ring``.
    The empty target grid takes part as the weakest source, so pixels no tile
    covers come out as nodata without a join back.
    """
    pairs = spatial.target_sources(targets.select("target_id", "ring"), sources)
    hits = spatial.regrid_nearest(targets, tiles_map, pairs, source_size, target_size)
    ordered = hits.select(
        "target_id", F.col("target_row").alias("row"), F.col("target_col").alias("col"), "value", "qc",
        # sources are taken in the order of their names
        F.conv(F.hex(F.col("tile_id").cast("string")), 16, 10).cast("long").alias("source_order"),
    )
    nodata = spatial.target_pixels(targets, target_size).select(
        "target_id", "row", "col", F.lit(codes.NODATA).alias("value"), F.lit(codes.NODATA).alias("qc"),
        F.lit(-1).cast("long").alias("source_order"),
    )
    return px.mosaic(ordered.unionByName(nodata), keys=("target_id", "row", "col"))
