"""Query registry and the adapters that give the driver tables their roles.

Each adapter exists twice: as a DataFrame and as a SQL common table expression,
so every registered query can carry an equivalent statement over the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline import codes
from firnline.operators.spatial import box_ring
from firnline.scale import epoch_us
from firnline.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Driver tables and their adapted roles."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def events(self) -> DataFrame:
        return self.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))

    def log(self) -> DataFrame:
        """Status log: one change per event."""
        return self.events().select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("fk_parent_job_id"),
            F.col("ts").alias("time"),
            F.col("event_type").alias("error_subtype"),
            (F.col("event_id") % 16 + 1).cast("int").alias("job_status"),
        )

    def parents(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").alias("tile_id"),
            (F.col("c_custkey") % 16 + 1).cast("int").alias("last_status_id"),
            (F.col("c_custkey") * 7).alias("last_status_change_id"),
            F.lit(None).cast("timestamp").alias("last_status_change_date"),
            F.lit(None).cast("string").alias("last_status_error_subtype"),
            F.lit(False).alias("error_raised"),
        )

    def jobs(self) -> DataFrame:
        return self.events().select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("fk_parent_job_id"),
            F.col("user_id").alias("tile_id"),
            F.col("event_type").alias("family"),
            F.col("ts").alias("measurement_date"),
            F.col("value"),
        )

    def products(self) -> DataFrame:
        return self.events().select(
            F.col("event_id").alias("product_id"),
            F.col("event_type").alias("product_type"),
            F.col("user_id").alias("tile_id"),
            F.to_date("ts").alias("day"),
            F.col("ts").alias("measurement_date"),
            F.col("ts").alias("sensing_time"),
            (F.col("event_id") % 3).alias("version"),
            (F.col("event_id") % 2).alias("mode"),
        )

    def pixels(self) -> DataFrame:
        value = (
            F.when(F.col("event_type") == "error", codes.CLOUD)
            .when(F.col("event_type") == "signup", codes.NODATA)
            .otherwise(F.floor(F.abs("value")).cast("int") % 101)
        )
        return self.events().select(
            F.col("event_id").alias("product_id"),
            F.col("ts").alias("product_ts"),
            F.to_date("ts").alias("day"),
            F.col("user_id").alias("tile_id"),
            (F.col("event_id") % 3).cast("int").alias("row"),
            (F.floor(F.col("event_id") / 3) % 3).cast("int").alias("col"),
            value.cast("int").alias("value"),
            (F.col("event_id") % 4).cast("int").alias("qc"),
            (F.col("event_id") % 64).cast("int").alias("flags"),
            F.unix_seconds("ts").alias("acq_epoch"),
        )

    def volume_pixels(self) -> DataFrame:
        """Large order-free pixel table."""
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("tile_id"),
            (F.col("l_partkey") % 9).cast("int").alias("row"),
            (F.floor(F.col("l_partkey") / 9) % 9).cast("int").alias("col"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.when(F.col("l_returnflag") == "R", codes.CLOUD)
            .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), codes.NODATA)
            .otherwise(F.col("l_quantity").cast("int") * 2)
            .cast("int")
            .alias("value"),
            F.col("l_orderkey").alias("product_id"),
            (F.col("l_orderkey") % 256).cast("int").alias("flags"),
        )

    def squares(self) -> DataFrame:
        """Footprints: one square per part."""
        x, y = F.col("p_partkey") % 50, F.col("p_size")
        side = 1 + F.col("p_partkey") % 3
        return self.raw("part").select(
            F.col("p_partkey").alias("id"),
            x.cast("double").alias("x0"), y.cast("double").alias("y0"), side.cast("double").alias("side"),
            box_ring(x, y, x + side, y + side).alias("ring"),
        )

    def grid_tiles(self, size: float = 10.0) -> DataFrame:
        """Square tiles in rows of six, one per supplier."""
        n = F.col("s_suppkey")
        x, y = (n % 6) * size, F.floor(n / 6) * size
        return (
            self.raw("supplier")
            .select(n.alias("tile_id"), box_ring(x, y, x + size, y + size).alias("ring"),
                    x.cast("double").alias("x0"), y.cast("double").alias("y0"))
        )


CTE = {
    "log": """log AS (SELECT event_id AS id, user_id AS fk_parent_job_id, ts AS time,
      event_type AS error_subtype, CAST(event_id % 16 + 1 AS INTEGER) AS job_status FROM events)""",
    "parents": """parents AS (SELECT c_custkey AS id, c_name AS name, c_nationkey AS tile_id,
      CAST(c_custkey % 16 + 1 AS INTEGER) AS last_status_id, c_custkey * 7 AS last_status_change_id FROM customer)""",
    "jobs": """jobs AS (SELECT event_id AS id, user_id AS fk_parent_job_id, user_id AS tile_id,
      event_type AS family, ts AS measurement_date, value FROM events)""",
    "products": """products AS (SELECT event_id AS product_id, event_type AS product_type, user_id AS tile_id,
      CAST(ts AS DATE) AS day, ts, event_id % 3 AS version, event_id % 2 AS mode FROM events)""",
    "px": """px AS (SELECT event_id AS product_id, ts, CAST(ts AS DATE) AS day, user_id AS tile_id,
      CAST(event_id % 3 AS INTEGER) AS "row", CAST((event_id // 3) % 3 AS INTEGER) AS col,
      CASE event_type WHEN 'error' THEN 205 WHEN 'signup' THEN 255
        ELSE CAST(floor(abs(value)) AS INTEGER) % 101 END AS value,
      CAST(event_id % 4 AS INTEGER) AS qc, CAST(event_id % 64 AS INTEGER) AS flags,
      CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS acq_epoch FROM events)""",
    "vol": """vol AS (SELECT l_suppkey AS tile_id, CAST(l_partkey % 9 AS INTEGER) AS "row",
      CAST((l_partkey // 9) % 9 AS INTEGER) AS col, CAST(l_quantity AS INTEGER) AS quantity,
      CASE WHEN l_returnflag = 'R' THEN 205 WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 255
        ELSE CAST(l_quantity AS INTEGER) * 2 END AS value, l_orderkey AS product_id,
      CAST(l_orderkey % 256 AS INTEGER) AS flags FROM lineitem)""",
    "squares": """squares AS (SELECT p_partkey AS id, CAST(p_partkey % 50 AS DOUBLE) AS x0,
      CAST(p_size AS DOUBLE) AS y0, CAST(1 + p_partkey % 3 AS DOUBLE) AS side FROM part)""",
    "tiles": """tiles AS (SELECT s_suppkey AS tile_id, CAST((s_suppkey % 6) * 10 AS DOUBLE) AS x0,
      CAST((s_suppkey // 6) * 10 AS DOUBLE) AS y0 FROM supplier)""",
}


def sql(ctes: str, body: str) -> str:
    names = ctes.split()
    return (("WITH " + ",\n".join(CTE[n] for n in names) + "\n") if names else "") + body


def query(name: str, ctes: str = "", oracle: str | None = None):
    """Register a query, with its equivalent SQL when there is one."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if oracle is not None:
            text = oracle.strip()
            if text.upper().startswith(("CTE:",)):
                text = text[4:].strip()
                recursive = text.startswith("RECURSIVE ")
                ORACLE[name] = "WITH " + "RECURSIVE " * recursive + ",\n".join([CTE[n] for n in ctes.split()] + [""]) + text[10 * recursive:]
            else:
                ORACLE[name] = sql(ctes, text)
        return fn

    return wrap


def us(c: Column | str, name: str) -> Column:
    """Timestamp as microseconds, so results compare without zone questions."""
    return epoch_us(c).alias(name)


def day_text(c: Column | str, name: str = "day") -> Column:
    return F.date_format(c, "yyyy-MM-dd").alias(name)
