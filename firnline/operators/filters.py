"""Row filters and data-quality rules."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline import codes
from firnline.functions.radar import noise_floor
from firnline.functions.times import all_of


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def equal_to(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Equality on several columns; a ``None`` value means IS NULL."""
    return df.where(
        all_of([F.col(c).isNull() if v is None else F.col(c) == v for c, v in values.items()])
    )


def among(df: DataFrame, column: str, values: Sequence[Any] | DataFrame) -> DataFrame:
    """Membership: a literal list, or a (possibly large) one-column table."""
    if isinstance(values, DataFrame):
        wanted = values.select(F.col(values.columns[0]).alias(column))
        return df.join(wanted, column, "left_semi")
    return df.where(F.col(column).isin(list(values)))


def in_range(column: Column, low: Any, high: Any, closed: bool = False) -> Column:
    """``[low, high)``; ``[low, high]`` when closed (the wet-snow family)."""
    upper = column <= high if closed else column < high
    return (column >= low) & upper


def jobs_with_status(jobs: DataFrame, parents: DataFrame, statuses: Sequence[int]) -> DataFrame:
    """Jobs whose parent has one of the statuses."""
    wanted = parents.where(F.col("last_status_id").isin(list(statuses))).select(
        F.col("id").alias("fk_parent_job_id")
    )
    return jobs.join(wanted, "fk_parent_job_id", "left_semi")


def jobs_status_tile_date(
    jobs: DataFrame,
    parents: DataFrame,
    statuses: Sequence[int],
    tile_id: str,
    low: Any,
    high: Any,
    date_column: str = "measurement_date",
) -> DataFrame:
    """Status, tile and half-open date range together."""
    wanted = parents.where(
        F.col("last_status_id").isin(list(statuses)) & (F.col("tile_id") == tile_id)
    ).select(F.col("id").alias("fk_parent_job_id"))
    return jobs.where(in_range(F.col(date_column), low, high)).join(
        wanted, "fk_parent_job_id", "left_semi"
    )


def jobs_tile_time(
    jobs: DataFrame, parents: DataFrame, tile_id: str, time: Any, date_column: str = "measurement_date"
) -> DataFrame:
    """Jobs of one tile at exactly one measurement time."""
    wanted = parents.where(F.col("tile_id") == tile_id).select(F.col("id").alias("fk_parent_job_id"))
    return jobs.where(F.col(date_column) == time).join(wanted, "fk_parent_job_id", "left_semi")


def filter_products(
    df: DataFrame,
    tile_id: Any = None,
    published_after: Any = None,
    published_before: Any = None,
    measured_from: Any = None,
    measured_to: Any = None,
    published: str = "publication_date",
    measured: str = "measurement_date",
    tile: str = "tile_id",
) -> DataFrame:
    """Publication bounds are strict, measurement bounds inclusive."""
    if tile_id is not None:
        df = df.where(F.col(tile) == tile_id)
    if published_after is not None:
        df = df.where(F.col(published) > published_after)
    if published_before is not None:
        df = df.where(F.col(published) < published_before)
    if measured_from is not None:
        df = df.where(F.col(measured) >= measured_from)
    if measured_to is not None:
        df = df.where(F.col(measured) <= measured_to)
    return df


def split_reprocessed(
    df: DataFrame, start: Any, measured: str = "measurement_date"
) -> tuple[DataFrame, DataFrame]:
    """New products, and old ones published again (measured before ``start``)."""
    old = F.coalesce(F.col(measured) < F.lit(start), F.lit(False))
    return df.where(~old), df.where(old)


def radar_ground_range(df: DataFrame) -> DataFrame:
    """Dual-polarised high-resolution ground-range scenes of the wide swath mode."""
    return df.where(F.col("polarisation").isin("DV", "DH") & (F.col("product_type") == "IW_GRDH"))


def is_gap(value: Column, gap_codes: Sequence[int] = codes.SNOW_GAPS) -> Column:
    return value.isin(list(gap_codes))


def is_clear(value: Column) -> Column:
    return value.between(0, 100)


def is_snow(value: Column) -> Column:
    return value.between(1, 100)


def above_noise(vh: Column, vv: Column, remove_noise: bool = True) -> Column:
    floor_vh = noise_floor(codes.NOISE_VH_DB) if remove_noise else 0.0
    floor_vv = noise_floor(codes.NOISE_VV_DB) if remove_noise else 0.0
    return (vh > F.lit(floor_vh)) & (vv > F.lit(floor_vv))


def clean_elevation(z: Column) -> Column:
    """Values below -1000 (and missing ones) become the fill value -10000."""
    bad = z.isNull() | F.isnan(z.cast("double")) | (z < -1000)
    return F.when(bad, F.lit(-10000.0)).otherwise(z)


def reach_filter(df: DataFrame, start: Any, end: Any, cloud_max: int = 100) -> DataFrame:
    """Both dates inclusive, cloud share up to ``cloud_max``."""
    return df.where(
        (F.col("datetime") >= F.lit(start))
        & (F.col("datetime") <= F.lit(end))
        & (F.col("cloud_perc") <= cloud_max)
    )


def bad_names(df: DataFrame, column: str = "name") -> DataFrame:
    """Rows whose name holds whitespace."""
    return df.where(F.col(column).rlike(r"\s"))


def domain_violations(df: DataFrame, rules: dict[str, Sequence[str]], key: str = "id") -> DataFrame:
    """One row per value outside its column's allowed set (null passes)."""
    checks = [
        F.when(
            F.col(c).isNotNull() & ~F.col(c).isin(list(allowed)),
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")),
        )
        for c, allowed in rules.items()
    ]
    return (
        df.select(F.col(key), F.explode(F.array(*checks)).alias("v"))
        .where(F.col("v").isNotNull())
        .select(key, "v.column", "v.value")
    )


def apply_mask(
    layer: DataFrame,
    mask: DataFrame,
    keys: Sequence[str] = ("tile_id", "row", "col"),
    value: str = "value",
    mask_value: str = "mask",
    nodata: int = codes.NODATA,
) -> DataFrame:
    """Set the layer to nodata where the mask layer is nodata."""
    holes = mask.select(*keys, (F.col(mask_value) == nodata).alias("_hole"))
    masked = F.when(F.coalesce(F.col("_hole"), F.lit(False)), F.lit(nodata)).otherwise(F.col(value))
    return (
        layer.join(holes, list(keys), "left").withColumn(value, masked).select(*layer.columns)
    )
