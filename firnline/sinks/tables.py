"""Writers: layers, matches, publication documents, and table updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.functions.ids import preview_path
from firnline.functions.times import packed_day
from firnline.scale import carry, epoch_us, placed
from firnline.sources.catalogue import ring_wkt


# --- layers and products -----------------------------------------------------
def write_pixels(df: DataFrame, root: str, rows_per_file: int = 20_000_000) -> None:
    """Layers partitioned by tile and day.

    Rebalancing gathers each (tile, day) into few files, and lets the runtime
    split one that is too large for a task and merge small ones.  Only the tile-days
    that ``df`` holds are replaced; all others stay.
    """
    (
        df.hint("rebalance", F.col("tile_id"), F.col("day"))
        .sortWithinPartitions("tile_id", "day", "row", "col")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("tile_id", "day")
        .parquet(root)
    )


def write_products(df: DataFrame, root: str, date: str = "measurement_date") -> None:
    """Product rows in ``year=/month=/day=`` folders; only the days that ``df`` holds
    are replaced."""
    (
        df.withColumn("year", F.year(date))
        .withColumn("month", F.month(date))
        .withColumn("day", F.dayofmonth(date))
        .hint("rebalance", F.col("year"), F.col("month"), F.col("day"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", "day")
        .parquet(root)
    )


def match_documents(df: DataFrame, left: str, right: str) -> DataFrame:
    """One JSON document per matched tile-day, keyed ``tile_YYYYMMDD``."""
    tag = F.concat_ws("_", F.col("tile_id").cast("string"), packed_day(F.col("day")).cast("string"))
    body = F.struct(F.col(left), F.col(right))
    return df.select(F.to_json(F.create_map(tag, body)).alias("value"))


def write_matches(df: DataFrame, path: str, left: str, right: str) -> None:
    match_documents(df, left, right).write.mode("overwrite").text(path)


# --- publication feed ------------------------------------------------------------
def publication_feed(products: DataFrame, info: str = "info", path: str = "path") -> tuple[DataFrame, DataFrame]:
    """Publication documents of finished products, and the rows left out.

    ``info`` holds the worker's JSON (geometry, size, resolution, cover, dates).
    A row is skipped when that or the product path is missing, or when the
    worker's JSON lacks a needed field.
    """
    schema = (
        "struct<resto: struct<geometry: struct<wkt: string>, properties: struct<"
        "resourceSize: bigint, resolution: bigint, cloudCover: double, startDate: string, completionDate: string>>>"
    )
    parsed = products.withColumn("_i", F.from_json(F.col(info), schema))
    geometry, props = F.col("_i.resto.geometry.wkt"), F.col("_i.resto.properties")
    incomplete = geometry.isNull() | props["resourceSize"].isNull() | props["startDate"].isNull()
    reason = F.when(F.col(info).isNull() | F.col(path).isNull(), "no worker information").when(
        incomplete, "incomplete worker information"
    )
    tagged = parsed.withColumn("reject_reason", reason)
    properties = F.struct(
        F.col("product_id").alias("productIdentifier"),
        F.col("product_id").alias("title"),
        F.col("product_type").alias("productType"),
        F.col("mission"),
        F.col("version").alias("processingBaseline"),
        # sizes come in kilobytes
        (props["resourceSize"] * 1024).alias("resourceSize"),
        props["resolution"].alias("resolution"),
        props["cloudCover"].alias("cloudCover"),
        props["startDate"].alias("startDate"),
        props["completionDate"].alias("completionDate"),
        preview_path(F.col(path)).alias("thumbnail"),
        F.col(path).alias("path"),
    )
    doc = F.to_json(
        F.struct(
            F.struct(
                F.struct(geometry.alias("wkt")).alias("geometry"), properties.alias("properties")
            ).alias("resto")
        )
    )
    ok = tagged.where(F.col("reject_reason").isNull()).select("product_id", doc.alias("document"))
    rejects = tagged.where(F.col("reject_reason").isNotNull()).select("product_id", "reject_reason")
    return ok, rejects


def worker_info(ring: Column, kilobytes: Column, resolution: Column, cloud: Column, start: Column, end: Column) -> Column:
    """The JSON a finished job leaves for the publication feed."""
    return F.to_json(
        F.struct(
            F.struct(
                F.struct(ring_wkt(ring).alias("wkt")).alias("geometry"),
                F.struct(
                    kilobytes.alias("resourceSize"), resolution.alias("resolution"), cloud.alias("cloudCover"),
                    start.alias("startDate"), end.alias("completionDate"),
                ).alias("properties"),
            ).alias("resto")
        )
    )


# --- table updates ---------------------------------------------------------------
def upsert(target: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Insert new rows and patch existing ones; null in a change keeps the value."""
    renamed = changes.select(*key, *[F.col(c).alias(f"_n_{c}") for c in changes.columns if c not in key])
    joined = target.join(renamed, list(key), "full_outer")
    cols = [
        F.coalesce(f"_n_{c}", c).alias(c) if f"_n_{c}" in renamed.columns else F.col(c) for c in target.columns
    ]
    return joined.select(*cols)


def delete_cascade(
    tables: dict[str, DataFrame], parent_ids: DataFrame, parent_table: str = "parent_jobs"
) -> dict[str, DataFrame]:
    """Remove parents and every row that depends on them.

    ``execution_info`` rows go with their parent, link rows with their execution.
    """
    gone = parent_ids.select(F.col(parent_ids.columns[0]).alias("id")).distinct()
    out: dict[str, DataFrame] = {}
    for name, df in tables.items():
        if name == parent_table:
            out[name] = df.join(gone, "id", "left_anti")
        elif "fk_parent_job_id" in df.columns:
            out[name] = df.join(gone.withColumnRenamed("id", "fk_parent_job_id"), "fk_parent_job_id", "left_anti").select(*df.columns)
        elif "fk_execution_info_id" in df.columns and "execution_info" in tables:
            kept = tables["execution_info"].join(
                gone.withColumnRenamed("id", "fk_parent_job_id"), "fk_parent_job_id", "left_semi"
            )
            dead = kept.select(F.col("id").alias("fk_execution_info_id"))
            out[name] = df.join(dead, "fk_execution_info_id", "left_anti").select(*df.columns)
        else:
            out[name] = df
    return out


def clear_family(tables: dict[str, DataFrame], family: str) -> dict[str, DataFrame]:
    """Delete the parents of one family's jobs, and with them its rows."""
    return delete_cascade(tables, tables[family].select("fk_parent_job_id"))


def param_history(changes: DataFrame, key: Sequence[str] = (), time: str = "time") -> DataFrame:
    """Parameter versions with the time each stopped being valid."""
    line = placed(changes.withColumn("_us", epoch_us(time)), key, ["_us"])
    out = carry(line, list(key), F.col("_chunk"), ["_us"], F.col(time), "valid_to", backward=True)
    return out.drop("_us", "_chunk").withColumnRenamed(time, "valid_from")


def params_at(history: DataFrame, at: Column) -> DataFrame:
    """Parameters in force at a time."""
    return history.where(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    )


# --- id corrections ----------------------------------------------------------------
def retag_version(products: DataFrame, old: str, new: str, columns: Sequence[str]) -> DataFrame:
    """Replace a version token (``V100``) in id, path and metadata columns."""
    for tag in (old, new):
        if not (len(tag) == 4 and tag[0] == "V" and tag[1:].isdigit()):
            raise ValueError(f"not a version tag: {tag}")
    for c in columns:
        products = products.withColumn(c, F.replace(F.col(c), F.lit(f"_{old}_"), F.lit(f"_{new}_")))
    return products


# fixed value: product type of the season maps
SEASON_TYPE = "PSA"


def fix_span_ids(products: DataFrame, column: str = "product_id", season_type: str = SEASON_TYPE) -> DataFrame:
    """Season ids whose span is in hours (four digits) get it in days, rounded up."""
    parts = F.split(F.col(column), "_")
    span = F.split(F.get(parts, F.lit(1)), "-")
    hours = F.get(span, F.lit(1))
    legacy = (
        (F.size(parts) == 5)
        & (F.get(parts, F.lit(0)) == season_type)
        & (F.get(parts, F.lit(2)) == "S2")
        & (F.length(F.get(parts, F.lit(3))) == 6)
        & (F.get(parts, F.lit(4)) == "V100")
        & (F.length(hours) == 4)
    )
    days = F.lpad(F.ceil(hours.try_cast("double") / F.lit(24.0)).cast("string"), 3, "0")
    fixed = F.concat_ws(
        "_",
        F.get(parts, F.lit(0)),
        F.concat_ws("-", F.get(span, F.lit(0)), days),
        F.get(parts, F.lit(2)),
        F.get(parts, F.lit(3)),
        F.get(parts, F.lit(4)),
    )
    return products.withColumn(column, F.when(F.coalesce(legacy, F.lit(False)), fixed).otherwise(F.col(column)))
