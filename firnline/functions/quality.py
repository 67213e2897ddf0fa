"""Quality values derived from expert flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firnline import codes
from firnline.functions.bits import bandmath, get_bit


def expert_flags(
    geo_flags: Column, water: Column, tree_cover: Column, cloud_mask: Column, snow: Column
) -> Column:
    """Flag byte: low sun, tangent sun, water, dense forest, snow below thin
    cloud, tree cover unknown (bits 0 to 5)."""
    return bandmath(
        {
            0: get_bit(geo_flags, 6),
            1: get_bit(geo_flags, 7),
            2: water == 1,
            3: (tree_cover < 101) & (tree_cover > 90),
            4: (cloud_mask > 0) & (snow > 0) & (snow < 101),
            5: tree_cover > 100,
        }
    )


def snow_quality(flags: Column, snow: Column, tree_cover: Column | None = None) -> Column:
    """0 best to 3 worst; cloud and nodata are copied from the snow layer.

    Tree cover enters unscaled, so any cover of 1 or more already gives 3.
    """
    score = (
        F.lit(100.0)
        - F.lit(30.0) * get_bit(flags, 1)
        - F.lit(50.0) * get_bit(flags, 0)
        - F.lit(25.0) * get_bit(flags, 4)
        - F.lit(25.0) * get_bit(flags, 2)
    )
    if tree_cover is not None:
        score = score - F.lit(80.0) * tree_cover
    level = F.least(F.lit(3), (F.lit(4.0) - F.greatest(F.lit(0.0), score / F.lit(25.0))).cast("int"))
    return F.when(snow.isin(codes.CLOUD, codes.NODATA), snow.cast("int")).otherwise(level)


def support_quality(clear: Column) -> Column:
    """Quality of a season statistic from its number of clear observations."""
    return (
        F.when(clear == 0, F.lit(codes.NODATA))
        .when(clear >= 25, F.lit(0))
        .when(clear >= 18, F.lit(1))
        .when(clear >= 11, F.lit(2))
        .otherwise(F.lit(3))
    )
