"""Raster algebra on long pixel tables (tile, row, col, value, ...).

Ordered folds over product stacks are expressed as aggregates with a composite
order, so Spark combines them on the map side and needs one exchange per
pixel key; no stack is ever gathered in memory.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firnline import codes
from firnline.functions import radar
from firnline.functions.bits import get_bit, set_bit
from firnline.functions.quality import support_quality
from firnline.operators.filters import above_noise, is_clear, is_gap, is_snow
from firnline.scale import Payload, fold_order

PIXEL = ("tile_id", "row", "col")


# --- gap filling -------------------------------------------------------------
def daily_fill(
    px: DataFrame,
    keys: Sequence[str] = PIXEL,
    gap_codes: Sequence[int] = codes.SNOW_GAPS,
    payload: Sequence[str] = ("value", "qc", "flags", "acq_epoch"),
    order: Sequence[str] = ("product_ts", "product_id"),
) -> DataFrame:
    """Newest valid pixel wins, else the newest pixel; its quality, flags and
    time travel with it.

    Validity leads the composite order, so a single ``max_by`` does both steps.
    """
    valid = ~is_gap(F.col("value"), gap_codes)
    rows = Payload(px, {c: F.col(c) for c in payload})
    best = F.max_by(rows.packed(), fold_order(px, [valid, *order]))
    return px.groupBy(*keys).agg(best.alias("_p")).select(*keys, rows.struct(F.col("_p")).alias("_p")).select(*keys, "_p.*")


def fill_from_wet(snow: DataFrame, wet: DataFrame, keys: Sequence[str] = PIXEL) -> DataFrame:
    """Where snow is a gap and the radar says wet snow: value 100, quality and
    time from radar, flag bit 6 set."""
    w = wet.select(*keys, F.col("value").alias("_wv"), F.col("qc").alias("_wq"), F.col("acq_epoch").alias("_wt"))
    take = F.coalesce(is_gap(F.col("value")) & (F.col("_wv") == codes.WET), F.lit(False))
    return snow.join(w, list(keys), "left").select(
        *keys,
        F.when(take, F.lit(100)).otherwise(F.col("value")).alias("value"),
        F.when(take, F.col("_wq")).otherwise(F.col("qc")).alias("qc"),
        F.when(take, set_bit(F.col("flags"), 6, F.lit(1))).otherwise(F.col("flags")).alias("flags"),
        F.when(take, F.col("_wt")).otherwise(F.col("acq_epoch")).alias("acq_epoch"),
    )


def flag_water(px: DataFrame, water: DataFrame, keys: Sequence[str] = PIXEL) -> DataFrame:
    """Flag bit 2 says whether the water mask reads 210."""
    w = water.select(*keys, (F.col("water") == codes.WATER).alias("_w"))
    joined = px.join(w, list(keys), "left")
    return joined.withColumn(
        "flags", set_bit(F.col("flags"), 2, F.coalesce("_w", F.lit(False)))
    ).select(*px.columns)


def temporal_fill(
    px: DataFrame,
    day: Column,
    span: int,
    keys: Sequence[str] = PIXEL,
    order: Sequence[str] = ("product_ts", "product_id"),
) -> DataFrame:
    """Fill inside the window ending with ``day`` and ``span`` days long.

    Newest valid value in the window; else the oldest cloud in the window; else
    the newest product itself when it lies in the window, else nodata.
    """
    cutoff = F.unix_seconds(F.date_add(day, 1).cast("timestamp")) - F.lit(1 + span * 86400)
    rows = Payload(px, {
        "value": F.col("value").cast("int"), "qc": F.col("qc").cast("int"),
        "flags": F.col("flags").cast("int"), "acq_epoch": F.col("acq_epoch").cast("long"),
    })
    payload, pos = rows.packed(), fold_order(px, order)
    inside = F.col("acq_epoch") > cutoff
    grouped = px.groupBy(*keys).agg(
        F.max_by(payload, pos).alias("_first"),
        F.max_by(payload, F.when(inside & ~is_gap(F.col("value")), pos)).alias("_valid"),
        F.min_by(payload, F.when(inside & (F.col("value") == codes.CLOUD), pos)).alias("_cloud"),
    ).select(*keys, *[rows.struct(F.col(c)).alias(c) for c in ("_first", "_valid", "_cloud")])
    empty = F.struct(
        F.lit(codes.NODATA).alias("value"),
        F.lit(codes.NODATA).alias("qc"),
        F.lit(0).alias("flags"),
        F.lit(0).cast("long").alias("acq_epoch"),
    )
    first_in = F.col("_first.acq_epoch") >= cutoff
    first_valid = first_in & ~is_gap(F.col("_first.value"))
    best = (
        F.when(first_valid, F.col("_first"))
        .when(F.col("_valid").isNotNull(), F.col("_valid"))
        .when(F.col("_cloud").isNotNull(), F.col("_cloud"))
        .when(first_in, F.col("_first"))
        .otherwise(empty)
    )
    return grouped.select(*keys, best.alias("_b")).select(*keys, "_b.*")


def mosaic(
    px: DataFrame, keys: Sequence[str] = ("row", "col"), order: str = "source_order"
) -> DataFrame:
    """1 beats 0 beats 255; quality from the first source giving the final
    value, except all-255, which keeps the last."""
    rank = F.when(F.col("value") == 1, 0).when(F.col("value") == 0, 1).otherwise(2)
    position = F.when(F.col("value") == codes.NODATA, -F.col(order)).otherwise(F.col(order))
    rows = Payload(px, {"value": F.col("value"), "qc": F.col("qc")})
    best = F.min_by(rows.packed(), fold_order(px, [rank.cast("tinyint"), position]))
    return px.groupBy(*keys).agg(best.alias("_p")).select(*keys, rows.struct(F.col("_p")).alias("_p")).select(*keys, "_p.*")


def fill_report(before: DataFrame, after: DataFrame, keys: Sequence[str] = PIXEL) -> DataFrame:
    """Gap pixels before and after, and how many were filled."""
    b = before.select(*keys, is_gap(F.col("value")).alias("_b"))
    a = after.select(*keys, is_gap(F.col("value")).alias("_a"))
    return b.join(a, list(keys)).agg(
        F.count_if("_b").alias("gaps_before"),
        F.count_if("_a").alias("gaps_after"),
        F.count_if(F.col("_b") & ~F.col("_a")).alias("filled"),
    )


# --- block resampling -----------------------------------------------------------
def _blocks(keys: Sequence[str], scale: int, row: str, col: str) -> list[Column]:
    return [
        *[F.col(k) for k in keys],
        F.floor(F.col(row) / scale).cast("int").alias("row"),
        F.floor(F.col(col) / scale).cast("int").alias("col"),
    ]


def upscale(
    px: DataFrame,
    scale: int,
    value_min: int = 0,
    value_max: int = 100,
    classes: Sequence[int] = (codes.CLOUD, codes.NODATA),
    nodata: int = codes.NODATA,
    keys: Sequence[str] = ("tile_id",),
) -> DataFrame:
    """Half-even mean of the values in range; without any, the most frequent
    listed class (earlier listed wins ties); without any, nodata."""
    v = F.col("value")
    counts = [F.count_if(v == c).alias(f"_n{i}") for i, c in enumerate(classes)]
    mean = F.avg(F.when(v.between(value_min, value_max), v))
    grouped = px.groupBy(*_blocks(keys, scale, "row", "col")).agg(F.rint(mean).alias("_m"), *counts)
    if not classes:
        fallback = F.lit(nodata)
    else:
        names = [F.col(f"_n{i}") for i in range(len(classes))]
        top = F.greatest(*names) if len(names) > 1 else names[0]
        fallback = F.lit(nodata)
        for name, code in reversed(list(zip(names, classes))):
            fallback = F.when((name == top) & (top > 0), F.lit(code)).otherwise(fallback)
    return grouped.select(
        *keys, "row", "col", F.coalesce(F.col("_m").cast("int"), fallback).alias("value")
    )


def upscale_mean(px: DataFrame, scale: int, keys: Sequence[str] = ("tile_id",)) -> DataFrame:
    """Plain block mean, truncated to the integer type."""
    return px.groupBy(*_blocks(keys, scale, "row", "col")).agg(
        F.avg("value").cast("int").alias("value")
    )


def upscale_bits(
    px: DataFrame, scale: int, n_bits: int = 8, flags: str = "flags", keys: Sequence[str] = ("tile_id",)
) -> DataFrame:
    """A bit is set when at least half of the block has it."""
    half = scale * scale / 2.0
    sums = [F.sum(get_bit(F.col(flags), b)).alias(f"_b{b}") for b in range(n_bits)]
    bits = [F.when(F.col(f"_b{b}") >= half, F.lit(1 << b)).otherwise(F.lit(0)) for b in range(n_bits)]
    return (
        px.groupBy(*_blocks(keys, scale, "row", "col"))
        .agg(*sums)
        .select(*keys, "row", "col", reduce(lambda a, b: a + b, bits).alias(flags))
    )


def upscale_layers(px: DataFrame, scale: int, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Snow value, quality and flags of one product together, in one exchange.

    ``carry`` are columns constant within ``keys``.
    """
    v, q = F.col("value"), F.col("qc")
    half = scale * scale / 2.0

    def pick(name: str, classes: Sequence[int]) -> Column:
        out = F.lit(codes.NODATA)
        top = F.greatest(*[F.col(f"_{name}{c}") for c in classes])
        for c in reversed(classes):
            out = F.when((F.col(f"_{name}{c}") == top) & (top > 0), F.lit(c)).otherwise(out)
        return F.coalesce(F.col(f"_{name}").cast("int"), out)

    classes = (codes.CLOUD, codes.NODATA)
    bits = [F.sum(get_bit(F.col("flags"), b)).alias(f"_b{b}") for b in range(8)]
    grouped = px.groupBy(*_blocks(keys, scale, "row", "col")).agg(
        F.rint(F.avg(F.when(v.between(0, 100), v))).alias("_v"),
        F.rint(F.avg(F.when(q.between(0, 3), q))).alias("_q"),
        *[F.count_if(v == c).alias(f"_v{c}") for c in classes],
        *[F.count_if(q == c).alias(f"_q{c}") for c in classes],
        *bits,
        *[F.max(c).alias(c) for c in carry],
    )
    packed = reduce(
        lambda a, b: a + b,
        [F.when(F.col(f"_b{b}") >= half, F.lit(1 << b)).otherwise(F.lit(0)) for b in range(8)],
    )
    return grouped.select(
        *keys,
        "row",
        "col",
        pick("v", classes).alias("value"),
        pick("q", classes).alias("qc"),
        packed.alias("flags"),
        *carry,
    )


# --- season statistics -------------------------------------------------------------
def snow_counts(px: DataFrame, keys: Sequence[str] = PIXEL) -> DataFrame:
    return px.groupBy(*keys).agg(
        F.count_if(is_clear(F.col("value"))).alias("n_clear"),
        F.count_if(is_snow(F.col("value"))).alias("n_snow"),
    )


def persistent_snow(
    px: DataFrame, ratio: float = codes.PERSISTENT_RATIO, keys: Sequence[str] = PIXEL
) -> DataFrame:
    """1 where snow on at least ``ratio`` of the clear observations, 255 where
    never clear; quality from the number of clear observations."""
    value = (
        F.when(F.col("n_clear") == 0, F.lit(codes.NODATA))
        .when(F.col("n_snow") >= F.col("n_clear") * F.lit(ratio), F.lit(1))
        .otherwise(F.lit(0))
    )
    return snow_counts(px, keys).select(
        *keys, value.alias("value"), support_quality(F.col("n_clear")).alias("qc")
    )


# --- layer statistics -----------------------------------------------------------------
def cloud_percent(px: DataFrame, keys: Sequence[str] = ("tile_id",)) -> DataFrame:
    """Cloud share of the scene as a whole percent (half to even)."""
    share = F.avg((F.col("value") == codes.CLOUD).cast("double"))
    return px.groupBy(*keys).agg(F.rint(F.lit(100.0) * share).cast("int").alias("cloud_percent"))


def cloud_ratios(px: DataFrame, keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """Cloud against valid and all pixels, and cloud or nodata against all."""
    cloud = F.count_if(F.col("value") == codes.CLOUD)
    hole = F.count_if(F.col("value") == codes.NODATA)
    total = F.count("*")
    return px.groupBy(*keys).agg(
        F.when(total > hole, cloud * 100.0 / (total - hole)).alias("cloud_vs_valid"),
        (cloud * 100.0 / total).alias("cloud_vs_all"),
        ((cloud + hole) * 100.0 / total).alias("not_clear_vs_all"),
    )


def value_histogram(px: DataFrame, keys: Sequence[str] = ("product_id",), nodata: int = codes.NODATA) -> DataFrame:
    """Pixels per value and their share of the product; nodata left out of the
    values but kept in the total."""
    counts = px.groupBy(*keys, "value").agg(F.count("*").alias("n_pixels"))
    # at most one row per code value is left in each product here
    w = Window.partitionBy(*keys)
    return (
        counts.withColumn("n_total", F.sum("n_pixels").over(w))
        .withColumn("n_valid", F.sum(F.when(F.col("value") != nodata, F.col("n_pixels")).otherwise(0)).over(w))
        .where(F.col("value") != nodata)
        .withColumn("percent", F.col("n_pixels") * 100.0 / F.col("n_total"))
    )


def layer_stats(px: DataFrame, keys: Sequence[str], value: str = "value", nodata: float = -10000) -> DataFrame:
    v = F.col(value)
    return px.groupBy(*keys).agg(
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("stddev"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.count_if(v == nodata).alias("n_nodata"),
        F.count_if(v == 0).alias("n_zero"),
        F.count_if(v < 0).alias("n_negative"),
    )


def row_extents(px: DataFrame, keys: Sequence[str] = ("product_id",), nodata: int = codes.NODATA, axis: str = "row") -> DataFrame:
    """First and last valid pixel of each row (or column)."""
    along = "col" if axis == "row" else "row"
    return (
        px.where(F.col("value") != nodata)
        .groupBy(*keys, axis)
        .agg(F.min(along).alias("first"), F.max(along).alias("last"))
    )


def merge_masks(layers: Sequence[DataFrame], keys: Sequence[str] = PIXEL) -> DataFrame:
    """Later layers override where they are non-zero."""
    tagged = [
        layer.select(*keys, "value").withColumn("_order", F.lit(i)) for i, layer in enumerate(layers)
    ]
    union = reduce(DataFrame.unionByName, tagged)
    set_value = F.max_by("value", F.when(F.col("value") != 0, F.col("_order")))
    return union.groupBy(*keys).agg(F.coalesce(set_value, F.lit(0)).alias("value"))


def merge_any(layers: Sequence[DataFrame], keys: Sequence[str] = PIXEL) -> DataFrame:
    """Water where any layer says water."""
    union = reduce(DataFrame.unionByName, [layer.select(*keys, "value") for layer in layers])
    return union.groupBy(*keys).agg(F.max((F.col("value") != 0).cast("int")).alias("value"))


# --- alignment --------------------------------------------------------------------------
def stack(layers: dict[str, DataFrame], keys: Sequence[str] = PIXEL, how: str = "inner") -> DataFrame:
    """One row per pixel with one column per layer.

    All joins share the pixel key, so one hash partitioning serves them all.
    """
    named = [
        df.select(*keys, F.col("value").alias(name)) for name, df in layers.items()
    ]
    return reduce(lambda a, b: a.join(b, list(keys), how), named)


def align_grid(px: DataFrame, src: dict[str, float], dst: dict[str, float]) -> DataFrame:
    """Cut one grid onto another of the same pixel size (offsets truncated).

    Grids: ``ulx``, ``uly``, ``size``, ``nrows``, ``ncols``.  Raises when they
    do not overlap.
    """
    if src["size"] != dst["size"]:
        raise ValueError("pixel sizes differ")
    size = dst["size"]

    def axis(src0: float, dst0: float, n_src: int, n_dst: int) -> tuple[int, int, int]:
        """First source index, first target index, length (origin grows with index)."""
        skip = int((dst0 - src0) / size) if dst0 > src0 else 0
        put = int((src0 - dst0) / size) if src0 > dst0 else 0
        end = min(src0 + n_src * size, dst0 + n_dst * size)
        return skip, put, int((end - (src0 + skip * size)) / size)

    cs, cd, cn = axis(src["ulx"], dst["ulx"], src["ncols"], dst["ncols"])
    rs, rd, rn = axis(-src["uly"], -dst["uly"], src["nrows"], dst["nrows"])
    if cn < 1 or rn < 1:
        raise ValueError("no overlap between the grids")
    return (
        px.where(F.col("row").between(rs, rs + rn - 1) & F.col("col").between(cs, cs + cn - 1))
        .withColumn("row", (F.col("row") - F.lit(rs - rd)).cast("int"))
        .withColumn("col", (F.col("col") - F.lit(cs - cd)).cast("int"))
    )


# --- terrain ------------------------------------------------------------------------------
def gradients(dem: DataFrame, resolution: float, tile: str = "tile_id", z: str = "z") -> DataFrame:
    """Sobel gradients along columns and rows, edges reflected.

    The stencil is separable: one ordered pass along rows, one along columns,
    each over groups no longer than a raster side.
    """
    along_row = Window.partitionBy(tile, "row").orderBy("col")
    along_col = Window.partitionBy(tile, "col").orderBy("row")

    def neighbour(name: str, w, axis: str, step: int) -> Column:
        shifted = F.lag(name, step) if step > 0 else F.lead(name, -step)
        index = F.lag(axis, step) if step > 0 else F.lead(axis, -step)
        return F.when(index.over(w) == F.col(axis) - step, shifted.over(w)).otherwise(F.col(name))

    left, right = neighbour(z, along_row, "col", 1), neighbour(z, along_row, "col", -1)
    first = dem.select(
        tile, "row", "col", F.col(z),
        (left - right).alias("_d"),
        (left + F.lit(2.0) * F.col(z) + right).alias("_s"),
    )
    d_up, d_down = neighbour("_d", along_col, "row", 1), neighbour("_d", along_col, "row", -1)
    s_up, s_down = neighbour("_s", along_col, "row", 1), neighbour("_s", along_col, "row", -1)
    scale = F.lit(8.0 * resolution)
    return first.select(
        tile, "row", "col", F.col(z),
        ((d_up + F.lit(2.0) * F.col("_d") + d_down) / scale).alias("dz_dc"),
        ((s_down - s_up) / scale).alias("dz_dl"),
    )


def slope_aspect(dem: DataFrame, resolution: float, tile: str = "tile_id", z: str = "z") -> DataFrame:
    """Slope and aspect in hundredths of a radian (truncated)."""
    g = gradients(dem, resolution, tile, z)
    c, l = F.col("dz_dc"), F.col("dz_dl")
    norm = F.sqrt(c * c + l * l)
    ratio = F.when(norm > 0, l / norm)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio)))
    aspect = F.when(norm == 0, F.lit(0.0)).otherwise(
        F.when(c > 0, angle).otherwise(F.lit(2.0) * F.pi() - angle)
    )
    return g.withColumn("slope", (F.atan(norm) * 100.0).cast("int")).withColumn(
        "aspect", (F.coalesce(aspect, F.lit(0.0)) * 100.0).cast("int")
    )


def terrain_water(gradient: DataFrame, z: str = "z", limit: float = 1e5) -> DataFrame:
    """Water where the elevation is below zero and both gradients are small."""
    flat = (F.abs("dz_dc") <= limit) & (F.abs("dz_dl") <= limit)
    return gradient.withColumn("water", ((F.col(z) < 0) & flat).cast("int"))


# --- radar classes -----------------------------------------------------------------------------
def wet_snow_ratio(px: DataFrame, remove_noise: bool = True, fill: float = 0.0) -> DataFrame:
    """Class, quality and validity from backscatter, reference and angle.

    Needs ``vh, vv, vh_ref, vv_ref, inc_angle``; ``fill`` is the nodata value of
    all of them.
    """
    ref_ok = (F.col("vh_ref") > 0) & (F.col("vv_ref") > 0) & (F.col("vh_ref") != fill) & (F.col("vv_ref") != fill)
    obs_ok = above_noise(F.col("vh"), F.col("vv"), remove_noise) & (F.col("vh") != fill) & (F.col("vv") != fill)
    angle_ok = (F.col("inc_angle") > -180) & (F.col("inc_angle") < 180) & (F.col("inc_angle") != fill)
    valid = F.coalesce(ref_ok & obs_ok & angle_ok, F.lit(False))
    rvh = radar.to_db(F.col("vh")) - radar.to_db(F.col("vh_ref"))
    rvv = radar.to_db(F.col("vv")) - radar.to_db(F.col("vv_ref"))
    rc = F.when(valid, radar.weighted_ratio(rvh, rvv, radar.angle_weight(F.col("inc_angle"))))
    return (
        px.withColumn("valid", valid)
        .withColumn("rc", rc)
        .withColumn("wet_value", radar.wet_class(F.col("rc")))
        .withColumn("wet_qc", radar.wet_quality(F.col("rc")))
    )


def observed_blocks(snow: DataFrame, scale: int, keys: Sequence[str] = ("tile_id", "product_id", "scene_order")) -> DataFrame:
    """Per block and scene: ``snow``, ``free``, ``cloud`` or ``none``."""
    v = F.col("value")
    n = scale * scale
    observed, cloud = F.count_if(v.between(0, 100)), F.count_if(v == codes.CLOUD)
    mean = F.avg(F.when(v.between(0, 100), v))
    state = (
        F.when((observed > n // 2) & (mean >= 90), "snow")
        .when(observed > n // 2, "free")
        .when(cloud > n - observed - cloud, "cloud")
        .otherwise("none")
    )
    return snow.groupBy(*_blocks(keys, scale, "row", "col")).agg(state.alias("state"))


def merged_mask(mask: Column, shadow: Column) -> Column:
    """Shadow overrides the first mask."""
    return F.when(shadow != 0, shadow).otherwise(mask)
