"""Backscatter columns: decibel, incidence weight, weighted ratio, classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firnline import codes


def to_db(power: Column) -> Column:
    return F.lit(10.0) * F.log10(power)


def noise_floor(db: float) -> float:
    return 10 ** (-db / 10)


def angle_weight(angle: Column) -> Column:
    low, high, k = codes.ANGLE_LOW, codes.ANGLE_HIGH, codes.ANGLE_WEIGHT
    return (
        F.when(angle < low, F.lit(1.0))
        .when(angle <= high, F.lit(k) * (F.lit(1.0) + (F.lit(high) - angle) / F.lit(high - low)))
        .otherwise(F.lit(k))
    )


def weighted_ratio(ratio_vh: Column, ratio_vv: Column, weight: Column) -> Column:
    return weight * ratio_vh + (F.lit(1.0) - weight) * ratio_vv


def wet_class(ratio: Column) -> Column:
    return (
        F.when(ratio >= codes.RATIO_STEPS[3], F.lit(codes.NOT_WET))
        .when(ratio < codes.RATIO_STEPS[3], F.lit(codes.WET))
        .otherwise(F.lit(codes.NODATA))
    )


def wet_quality(ratio: Column) -> Column:
    s = codes.RATIO_STEPS
    return (
        F.when(ratio >= s[3], F.lit(codes.MASKED))
        .when(ratio >= s[2], F.lit(3))
        .when(ratio >= s[1], F.lit(2))
        .when(ratio >= s[0], F.lit(1))
        .when(ratio < s[0], F.lit(0))
        .otherwise(F.lit(codes.NODATA))
    )
