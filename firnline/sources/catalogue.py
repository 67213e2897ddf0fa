"""Catalogue: typed columns from product paths, and JSON feature pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline import codes
from firnline.functions.ids import base_name, id_time
from firnline.functions.times import parse_time
from firnline.schemas import FEATURE_PAGE

_TIME = "yyyyMMdd'T'HHmmss"


def catalogue_from_paths(paths: DataFrame, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """Typed catalogue rows, and the paths whose name fits no known pattern.

    Three name families: optical scenes, radar scenes, snow and ice products.
    A name that fits but holds an impossible date is rejected too.  The pattern
    only decides the family; the fields then come from one split of the name.
    """
    named = paths.withColumn("name", base_name(F.col(path)))
    n = F.col("name")
    kind = (
        F.when(n.rlike(codes.OPTICAL_SCENE), "optical_scene")
        .when(n.rlike(codes.RADAR_SCENE), "radar_scene")
        .when(n.rlike(codes.SNOW_ICE_PRODUCT), "product")
    )
    cut = named.select(
        *paths.columns,
        kind.alias("kind"),
        F.regexp_replace(n, r"(?i)\.SAFE$", "").alias("product_id"),
    ).withColumn("t", F.split("product_id", "_"))

    def token(i: int) -> Column:
        return F.get("t", F.lit(i))

    def by_kind(optical: Column | None = None, radar: Column | None = None, product: Column | None = None) -> Column:
        none = F.lit(None).cast("string")
        return (
            F.when(F.col("kind") == "optical_scene", none if optical is None else optical)
            .when(F.col("kind") == "radar_scene", none if radar is None else radar)
            .when(F.col("kind") == "product", none if product is None else product)
        )

    def time(text: Column) -> Column:
        return F.try_to_timestamp(text, F.lit(_TIME))

    rows = cut.select(
        *paths.columns,
        "kind",
        "product_id",
        by_kind(token(1), F.concat_ws("_", token(1), token(2)), token(0)).alias("product_type"),
        by_kind(token(0), token(0), token(2)).alias("mission"),
        F.when(F.col("kind") == "radar_scene", time(token(4)))
        .when(F.col("kind") == "optical_scene", time(token(2)))
        .when(F.col("kind") == "product", id_time(F.col("product_id")))
        .alias("sensing_start"),
        F.when(F.col("kind") == "radar_scene", time(token(5))).alias("sensing_stop"),
        by_kind(F.right(token(5), F.lit(5)), None, F.regexp_replace(token(3), r"^T(?=.{5}$)", "")).alias("tile_id"),
        by_kind(F.right(token(4), F.lit(3)), token(6)).alias("orbit"),
        by_kind(F.right(token(3), F.lit(4)), None, F.substring(token(4), 2, 9)).alias("version"),
        by_kind(None, token(1), token(5)).alias("mode"),
        by_kind(None, F.right(token(3), F.lit(2))).alias("polarisation"),
        by_kind(None, token(7)).alias("take_id"),
        by_kind(token(6), token(8)).alias("discriminator"),
    )
    bad_stop = (F.col("kind") == "radar_scene") & F.col("sensing_stop").isNull()
    bad_second = (F.col("kind") == "optical_scene") & time(F.col("discriminator")).isNull()
    ok = F.coalesce(
        F.col("kind").isNotNull() & F.col("sensing_start").isNotNull() & ~bad_stop & ~bad_second,
        F.lit(False),
    )
    # a generator's rows take no filter below them, so each name is parsed once
    judged = rows.select(F.struct(*rows.columns, ok.alias("_ok")).alias("_r")).select(F.inline_outer(F.array("_r")))
    return judged.where("_ok").drop("_ok"), judged.where(~F.col("_ok")).select(*paths.columns)


def read_feature_pages(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    tiles: Sequence[str] | None = None,
) -> DataFrame:
    """Product rows from JSON feature collections (a file per result page)."""
    pages = spark.read.schema(FEATURE_PAGE).option("multiLine", True).json(path)
    return features_to_products(pages, columns, tiles)


def features_to_products(
    pages: DataFrame, columns: Sequence[str] | None = None, tiles: Sequence[str] | None = None
) -> DataFrame:
    """Explode feature pages and type their properties."""
    p = pages.select(F.explode("features").alias("f")).select("f.properties.*")
    out = p.select(
        base_name(F.col("productIdentifier")).alias("product_id"),
        F.col("productIdentifier").alias("path"),
        F.col("productType").alias("product_type"),
        F.col("mission"),
        F.regexp_extract("productIdentifier", r"_T([0-9]{2}[A-Z]{3})_", 1).alias("tile_id"),
        F.col("cloudCover").alias("cloud_cover"),
        F.col("snowCover").alias("snow_cover"),
        parse_time(F.col("startDate")).alias("measurement_date"),
        parse_time(F.col("completionDate")).alias("completion_date"),
        parse_time(F.col("published")).alias("publication_date"),
        F.col("gmlgeometry").alias("gml"),
    )
    if tiles is not None:
        out = out.where(F.col("tile_id").isin([t[-5:] for t in tiles]))
    return out if columns is None else out.select(*columns)


def gml_ring(gml: Column) -> Column:
    """Ring from the ``lon,lat lon,lat ...`` list of a GML polygon."""
    coords = F.regexp_extract(gml, r"<gml:coordinates>([^<]*)</gml:coordinates>", 1)
    pts = F.transform(
        F.filter(F.split(F.trim(coords), r"\s+"), lambda t: t != ""),
        lambda t: F.struct(
            F.get(F.split(t, ","), F.lit(0)).try_cast("double").alias("x"),
            F.get(F.split(t, ","), F.lit(1)).try_cast("double").alias("y"),
        ),
    )
    closed = (F.size(pts) > 1) & (F.element_at(pts, 1) == F.element_at(pts, -1))
    return F.when(closed, F.slice(pts, 1, F.size(pts) - 1)).otherwise(pts)


def wkt_ring(wkt: Column) -> Column:
    """Outer ring of a WKT polygon."""
    coords = F.regexp_extract(wkt, r"(?i)POLYGON\s*\(\(([^()]*)\)", 1)
    pts = F.transform(
        F.filter(F.split(coords, ","), lambda t: F.trim(t) != ""),
        lambda t: F.struct(
            F.get(F.split(F.trim(t), r"\s+"), F.lit(0)).try_cast("double").alias("x"),
            F.get(F.split(F.trim(t), r"\s+"), F.lit(1)).try_cast("double").alias("y"),
        ),
    )
    closed = (F.size(pts) > 1) & (F.element_at(pts, 1) == F.element_at(pts, -1))
    return F.when(closed, F.slice(pts, 1, F.size(pts) - 1)).otherwise(pts)


def ring_wkt(ring: Column) -> Column:
    """WKT polygon of a ring, first point repeated at the end."""
    shut = F.concat(ring, F.slice(ring, 1, 1))
    pts = F.transform(shut, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    return F.concat(F.lit("POLYGON (("), F.array_join(pts, ", "), F.lit("))"))
