"""Columns over product ids, paths and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firnline import codes


def base_name(path: Column) -> Column:
    return F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)


def id_token(product_id: Column, index: int) -> Column:
    """Token of a ``TYPE_DATE_MISSION_TILE_VERSION_MODE`` id (0-based)."""
    return F.get(F.split(product_id, "_"), F.lit(index))


def id_day(product_id: Column) -> Column:
    """Day of an id whose date reads ``YYYYMMDDTHHMMSS`` or ``YYYYMMDD-NNN``."""
    return F.to_date(F.substring(id_token(product_id, 1), 1, 8), "yyyyMMdd")


def id_time(product_id: Column) -> Column:
    """Sensing time of an id; midnight when the id spans days."""
    token = id_token(product_id, 1)
    return F.coalesce(
        F.try_to_timestamp(token, F.lit("yyyyMMdd'T'HHmmss")),
        F.try_to_timestamp(F.substring(token, 1, 8), F.lit("yyyyMMdd")),
    )


def id_mode(product_id: Column, gap_filled_type: str = "GFSC") -> Column:
    """Mode token, null for gap-filled products whose last token is a time stamp."""
    return F.when(id_token(product_id, 0) != gap_filled_type, id_token(product_id, 5))


def toggled_mode_id(product_id: Column) -> Column:
    """Id of the twin product: mode 1 becomes 0 and the other way round."""
    parts = F.split(product_id, "_")
    mode = F.get(parts, F.lit(5))
    flipped = F.when(mode == "0", F.lit("1")).when(mode == "1", F.lit("0"))
    return F.when(
        flipped.isNotNull(),
        F.concat_ws("_", F.slice(parts, 1, 5), flipped),
    )


def curation_stamp(product_id: Column) -> Column:
    """Last token of a gap-filled id as a number."""
    return F.element_at(F.split(product_id, "_"), -1).try_cast("long")


def is_tile_name(name: Column) -> Column:
    return name.rlike(codes.TILE_NAME)


def is_laea_tile_name(name: Column) -> Column:
    return name.rlike(codes.LAEA_TILE_NAME)


def short_tile(name: Column) -> Column:
    """Five-character tile name from either spelling, null when invalid."""
    return F.when(is_tile_name(name), F.right(name, F.lit(5)))


def object_path(bucket: Column, prefix: Column, name: Column) -> Column:
    return F.concat_ws("/", bucket, prefix, name)


def product_path(bucket: Column, root: Column, day: Column, product_id: Column) -> Column:
    """``bucket/root/YYYY/MM/DD/product``."""
    return F.concat_ws("/", bucket, root, F.date_format(day, "yyyy/MM/dd"), product_id)


def preview_path(path: Column) -> Column:
    return F.concat_ws("/", path, F.lit("thumbnail.png"))


def split_object_path(path: Column) -> Column:
    """Struct of bucket, key prefix and object name."""
    clean = F.ltrim(path, F.lit("/"))
    return F.struct(
        F.regexp_extract(clean, r"^([^/]+)", 1).alias("bucket"),
        F.regexp_extract(clean, r"^[^/]+/(.*)/[^/]+$", 1).alias("prefix"),
        base_name(clean).alias("object"),
    )


def wildcard_match(value: Column, pattern: str, case_sensitive: bool = True) -> Column:
    """Match where ``*`` stands for any run of characters."""
    like = pattern.replace("*", "%")
    return value.like(like) if case_sensitive else value.ilike(like)


def split_list(text: Column, separator: str = ";") -> Column:
    """Array of a delimited list; empty text gives an empty array."""
    return F.filter(F.split(text, separator), lambda x: F.trim(x) != "")


def json_list(text: Column) -> Column:
    return F.from_json(text, "array<string>")


def json_map(text: Column) -> Column:
    return F.from_json(text, "map<string,string>")
