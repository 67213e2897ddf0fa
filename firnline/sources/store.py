"""Partitioned stores: products by day, pixel layers by tile and day, job tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.schemas import JOB_FAMILIES, PARENT_JOBS, STATUS_CHANGES, TILE_GRID
from firnline import codes


def day_partition_filter(start: dt.date, end: dt.date) -> Column:
    """``year/month/day`` partition predicate for an inclusive range of days.

    Written per boundary year and month so it holds on the partition columns
    alone and whole years outside the range are never listed.
    """
    key = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    low, high = (d.year * 10000 + d.month * 100 + d.day for d in (start, end))
    return (F.col("year") >= start.year) & (F.col("year") <= end.year) & (key >= low) & (key <= high)


def scan_products(
    spark: SparkSession, root: str, start: dt.date, end: dt.date, tile_id: str | None = None
) -> DataFrame:
    """Products between two days of a store laid out as ``year=/month=/day=``."""
    df = spark.read.parquet(root).where(day_partition_filter(start, end))
    return df if tile_id is None else df.where(F.col("tile_id") == tile_id)


def read_pixels(
    spark: SparkSession,
    root: str,
    layers: Sequence[str] = ("value", "qc", "flags", "acq_epoch"),
    products: DataFrame | None = None,
    tiles: Sequence[str] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Chosen layers of chosen products; tile and day prune the partitions."""
    df = spark.read.parquet(root)
    if tiles is not None:
        df = df.where(F.col("tile_id").isin(list(tiles)))
    if start is not None:
        df = df.where(F.col("day") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("day") <= F.lit(end))
    df = df.select("product_id", "product_ts", "tile_id", "day", "row", "col", *layers)
    return df if products is None else df.join(products.select("product_id"), "product_id", "left_semi")


def read_jobs(spark: SparkSession, root: str, family: str) -> DataFrame:
    """Jobs of a family, or ``parent_jobs`` / ``job_status_changes``."""
    schema = {"parent_jobs": PARENT_JOBS, "job_status_changes": STATUS_CHANGES, **JOB_FAMILIES}[family]
    return spark.read.schema(schema).parquet(f"{root}/{family}")


def read_tile_grid(spark: SparkSession, path: str) -> DataFrame:
    """Tile grid from JSON lines of its columns."""
    return spark.read.schema(TILE_GRID).json(path)


def parse_tile_grid(lines: DataFrame, line: str = "value") -> DataFrame:
    """Tile grid from ``tile: {epsg: .., ulx: .., uly: .., lrx: .., lry: ..}`` lines."""
    def number(key: str) -> Column:
        return F.regexp_extract(F.col(line), rf"{key}:\s*([-0-9.]+)", 1).try_cast("double")

    out = lines.select(
        F.regexp_extract(F.col(line), r"^\s*['\"]?([0-9]{2}[A-Z]{3})['\"]?\s*:", 1).alias("tile_id"),
        number("epsg").cast("int").alias("epsg"),
        *[number(k).alias(k) for k in ("ulx", "uly", "lrx", "lry")],
    )
    return out.where((F.col("tile_id") != "") & F.col("epsg").isNotNull())


def parse_tile_tracks(lines: DataFrame, line: str = "value") -> DataFrame:
    """Allowed tracks from ``tile: [1, 2, 3]`` lines as an array column."""
    text = F.regexp_extract(F.col(line), r":\s*\[([0-9,\s]*)\]", 1)
    return lines.select(
        F.regexp_extract(F.col(line), r"^\s*['\"]?T?([0-9]{2}[A-Z]{3})['\"]?\s*:", 1).alias("tile_id"),
        F.transform(
            F.filter(F.split(text, ","), lambda t: F.trim(t) != ""), lambda t: F.trim(t).try_cast("int")
        ).alias("tracks"),
    ).where(F.col("tile_id") != "")


def parse_tile_list(lines: DataFrame, line: str = "value") -> DataFrame:
    """Tile names, one per line."""
    name = F.regexp_extract(F.trim(F.col(line)), r"^T?([0-9]{2}[A-Z]{3})$", 1)
    return lines.select(name.alias("tile_id")).where(F.col("tile_id") != "").distinct()


def tile_tracks_long(tracks: DataFrame) -> DataFrame:
    return tracks.select("tile_id", F.explode("tracks").alias("track"))


def class_codes(spark: SparkSession) -> DataFrame:
    """Pixel classes (a fixed table)."""
    return spark.createDataFrame(list(codes.CLASS_CODES), "layer string, code int, meaning string")


def value_ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(codes.VALUE_RANGES), "layer string, low int, high int")
