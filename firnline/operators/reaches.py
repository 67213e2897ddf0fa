"""River reaches: geometry look-up, measurements, zonal shares."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline import codes
from firnline.functions.rules import sensor_code
from firnline.functions.times import packed_day, packed_time
from firnline.operators.filters import reach_filter


class TooManyReaches(ValueError):
    """The query covers more reaches than one answer may hold."""


def over_size(ids: DataFrame, limit: int = codes.REACH_LIMIT) -> bool:
    """Whether ``ids`` has more than ``limit`` rows; counts ``limit + 1`` at most."""
    return ids.limit(limit + 1).count() > limit


def guard_size(ids: DataFrame, limit: int = codes.REACH_LIMIT) -> DataFrame:
    """Fail when ``ids`` has more than ``limit`` rows."""
    if over_size(ids, limit):
        raise TooManyReaches(f"more than {limit} reaches requested, ask for a smaller area")
    return ids


def in_answers(reaches: DataFrame, limit: int = codes.REACH_LIMIT) -> DataFrame:
    """``reaches`` with ``answer``, the number of the answer each comes with: one
    answer (0) within the limit, else as many as hold all reaches, none of them with
    more than ``limit`` rows.

    Rows are numbered inside their partition, so nothing is sorted or gathered.
    """
    if not over_size(reaches.select("id"), limit):
        return reaches.withColumn("answer", F.lit(0).cast("long"))
    at = F.monotonically_increasing_id()
    row = at.bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    first = at - row  # of the partition
    spread = reaches.repartition("id")
    return spread.withColumn("answer", first + F.floor(row / F.lit(limit)))


def reaches_by_id(reaches: DataFrame, ids: Sequence[int] | str) -> DataFrame:
    """Reaches by explicit ids (list, or comma-separated text)."""
    wanted = [int(i) for i in ids.split(",")] if isinstance(ids, str) else list(ids)
    return reaches.where(F.col("id").isin(wanted))


def reaches_by_hydro_id(reaches: DataFrame, hydro_id: str) -> DataFrame:
    return reaches.where(F.col("eu_hydro_id") == hydro_id)


def measurements(
    values: DataFrame, reaches: DataFrame, start: Any, end: Any, cloud_max: int = 100
) -> DataFrame:
    """Ice measurements of the selected reaches with packed date and time; ids with
    ``answer`` (:func:`in_answers`, each id once) pass it on."""
    found = reach_filter(values, start, end, cloud_max)
    numbered = ["answer"] if "answer" in reaches.columns else []
    wanted = reaches.select(F.col("id").alias("river_km_id"), *numbered)
    return (
        found.join(wanted, "river_km_id", "inner" if numbered else "left_semi")
        .select(
            *numbered,
            "river_km_id",
            packed_day(F.col("datetime")).alias("day"),
            packed_time(F.col("datetime")).alias("time"),
            "water_perc",
            "ice_perc",
            "other_perc",
            "cloud_perc",
            "nd_perc",
            "qc",
            sensor_code(F.col("type")).alias("sensor"),
        )
    )


def measurement_count(
    values: DataFrame, reaches: DataFrame, start: Any, end: Any, cloud_max: int = 100
) -> DataFrame:
    """Size of the answer only."""
    wanted = reaches.select(F.col("id").alias("river_km_id"))
    return (
        reach_filter(values, start, end, cloud_max)
        .join(wanted, "river_km_id", "left_semi")
        .agg(F.count("*").alias("n_rows"))
    )


def zonal_shares(
    pixels: DataFrame,
    reach_pixels: DataFrame,
    keys: Sequence[str] = ("tile_id", "row", "col"),
    time: str = "datetime",
    value: str = "value",
) -> DataFrame:
    """Percent of each river-ice class per reach and time.

    The join key is the pixel, so a long reach is spread over all tasks, and the
    counts are combined on the map side before they meet.
    """
    joined = pixels.join(reach_pixels, list(keys))
    n = F.count("*")
    v = F.col(value)

    def percent(cond: Column) -> Column:
        return F.rint(F.lit(100.0) * F.count_if(cond) / n).cast("int")

    other = ~v.isin(codes.ICE_WATER, codes.ICE_ICE, codes.ICE_CLOUD, codes.NODATA)
    return joined.groupBy("river_km_id", time).agg(
        percent(v == codes.ICE_WATER).alias("water_perc"),
        percent(v == codes.ICE_ICE).alias("ice_perc"),
        percent(other).alias("other_perc"),
        percent(v == codes.ICE_CLOUD).alias("cloud_perc"),
        percent(v == codes.NODATA).alias("nd_perc"),
        n.alias("n_pixels"),
    )


def id_list(ids: DataFrame, limit: int = codes.REACH_LIMIT) -> DataFrame:
    """One row holding the distinct ids, allowed only below ``limit``."""
    distinct = ids.select("id").distinct()
    return guard_size(distinct, limit).agg(F.array_sort(F.collect_list("id")).alias("ids"))
