"""Streams over the event table, run until all data there is processed."""

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline import codes
from firnline.registry.core import Tables, day_text, query, us
from firnline.registry.job_queries import FAILED, VERDICTS
from firnline.session import shared_folder
from firnline.streaming import intake as si
from firnline.streaming import run as sr
from firnline.streaming import status as ss


def event_stream(t: Tables) -> DataFrame:
    """The event table as a stream; each batch takes a bounded number of files."""
    schema = t.raw("events").schema
    return (
        t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 8)
        .parquet(t.folder).withColumn("ts", F.col("ts").cast("timestamp"))
    )


def log_stream(t: Tables) -> DataFrame:
    return event_stream(t).select(
        F.col("event_id").alias("id"), F.col("user_id").alias("fk_parent_job_id"), F.col("ts").alias("time"),
        (F.col("event_id") % 16 + 1).cast("int").alias("job_status"),
    )


def run(t: Tables, stream: DataFrame, mode: str = "append") -> DataFrame:
    with sr.state_partitions(t.spark, int(t.spark.conf.get("spark.sql.shuffle.partitions"))):
        return sr.run_to_table(stream, mode)


@query("stream_intake", "", "SELECT event_id // 2 AS product_id, epoch_us(min(ts)) AS published_us FROM events WHERE event_type <> 'error' GROUP BY 1")
def stream_intake(t: Tables):
    """ST-01: each product once, the first published of a batch's repeats"""
    out = shared_folder(t.spark, "intake")
    s = event_stream(t).where("event_type <> 'error'").select(F.floor(F.col("event_id") / 2).alias("product_id"), F.col("ts").alias("publication_date"))
    q = sr.start(s, si.intake(f"{out}/t"), f"{out}/checkpoint")
    q.awaitTermination()
    kept = t.spark.read.schema(s.schema).option("recursiveFileLookup", True).parquet(f"{out}/t")
    return kept.select("product_id", us("publication_date", "published_us"))


@query("stream_late", "", "SELECT event_id, ts < TIMESTAMP '2024-01-15' AS late FROM events")
def stream_late(t: Tables):
    """ST-02"""
    out = shared_folder(t.spark, "late")
    start = F.lit("2024-01-15").cast("timestamp")
    s = event_stream(t).select("event_id", "ts")
    q = sr.start(s, si.route_late(start, f"{out}/t", "ts"), f"{out}/checkpoint")
    q.awaitTermination()
    read = lambda p: t.spark.read.schema("event_id long, ts timestamp").option("recursiveFileLookup", True).parquet(os.path.join(out, "t", p))
    return read("new").select("event_id", F.lit(False).alias("late")).unionByName(read("late").select("event_id", F.lit(True).alias("late")))


@query("stream_replace", "", """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1, 2)
SELECT CAST(user_id AS VARCHAR) AS tile_id, strftime(day, '%Y-%m-%d') AS day, n AS n_versions FROM e""")
def stream_replace(t: Tables):
    """ST-03: every version of a tile-day replaces the one before it"""
    s = event_stream(t).where("event_type = 'view'").select(
        F.col("event_id").cast("string").alias("product_id"), F.col("user_id").cast("string").alias("tile_id"),
        F.date_trunc("day", "ts").alias("measurement_date"), F.col("ts").alias("creation_date"), F.col("ts").alias("publication_date"),
    )
    out = run(t, si.replace_codated(s))
    return out.groupBy("tile_id", day_text("measurement_date")).agg(F.count("*").alias("n_versions"))


@query("stream_hold", "", """
SELECT event_id AS product_id, CASE WHEN event_type = 'view' THEN 'held' ELSE 'immediate' END AS reason FROM events
WHERE event_type IN ('click', 'purchase') OR (event_type = 'view' AND ts + INTERVAL 3 HOUR <= (SELECT max(ts) FROM events WHERE event_type IN ('view', 'click', 'purchase')) - INTERVAL 1 SECOND)""")
def stream_hold(t: Tables):
    """ST-04: optical triggers wait three hours of event time"""
    s = event_stream(t).where(F.col("event_type").isin("view", "click", "purchase")).select(
        F.col("event_id").cast("string").alias("product_id"), F.col("user_id").cast("string").alias("tile_id"),
        F.to_date("ts").alias("product_date"), F.col("ts").alias("publication_date"), (F.col("event_type") == "view").alias("optical"),
    )
    return run(t, si.hold_trigger(s)).select(F.col("product_id").cast("long").alias("product_id"), "reason")


@query("stream_last_status", "log", """
SELECT fk_parent_job_id AS parent_job_id, arg_max(job_status, id) AS status, max(id) AS change_id FROM log GROUP BY 1""")
def stream_last_status(t: Tables):
    """ST-05"""
    from firnline.scale import latest_by

    out = run(t, ss.status_state(log_stream(t)), "update")
    return latest_by(out, ["parent_job_id"], ["change_id"]).select("parent_job_id", "status", "change_id")


@query("stream_validate", "log", VERDICTS)
def stream_validate(t: Tables):
    """ST-06: verdict per change, a refused change keeps the old status"""
    return run(t, ss.validate_stream(log_stream(t)))


STUCK = " ".join(f"WHEN {k} THEN {v}" for k, v in codes.STUCK_MINUTES.items())


@query("stream_stuck", "log", f"""CTE:h AS (SELECT fk_parent_job_id AS parent_job_id, job_status AS status, epoch_us(time) // 1000 AS since_ms,
  epoch_us(lead(time) OVER (PARTITION BY fk_parent_job_id ORDER BY id)) // 1000 AS next_ms, (SELECT epoch_us(max(time)) // 1000 FROM log) AS last_ms FROM log),
d AS (SELECT *, since_ms + CASE status {STUCK} END * 60000 AS due FROM h)
SELECT parent_job_id, status, since_ms, CAST(due AS BIGINT) AS alarm_ms FROM d WHERE due < coalesce(next_ms, last_ms)""")
def stream_stuck(t: Tables):
    """ST-07"""
    return run(t, ss.stuck_alarm(log_stream(t)))


@query("stream_retry", "log", FAILED.replace("SELECT fk_parent_job_id AS parent_job_id", "SELECT * FROM (SELECT fk_parent_job_id AS parent_job_id") + ") WHERE failures > 0")
def stream_retry(t: Tables):
    """ST-08: failures counted so far, the third permanent"""
    out = run(t, ss.retry_stream(log_stream(t)))
    return out.groupBy("parent_job_id").agg(F.max("failures").cast("long").alias("failures"), F.bool_or("permanent").alias("permanent"))


@query("stream_feed", "", "SELECT event_id AS product_id FROM events WHERE event_type = 'purchase'")
def stream_feed(t: Tables):
    """ST-09: publication documents in a file sink"""
    from firnline.sinks.tables import worker_info

    out = shared_folder(t.spark, "feed")
    i = F.col("event_id")
    ring = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0))])
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    products = event_stream(t).where("event_type = 'purchase'").select(
        i.alias("product_id"), F.lit("GFSC").alias("product_type"), F.lit("S1-S2").alias("mission"), F.lit("V100").alias("version"),
        F.concat(F.lit("p/"), i.cast("string")).alias("path"), worker_info(ring, i, F.lit(60), F.lit(1.0), when, when).alias("info"),
    )
    q = ss.feed_stream(products, f"{out}/docs", f"{out}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    docs = t.spark.read.text(f"{out}/docs")
    return docs.select(F.get_json_object("value", "$.resto.properties.productIdentifier").cast("long").alias("product_id"))


@query("stream_daily_counts", "", """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type AS family, count(*) AS n_jobs FROM events
WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1, 2""")
def stream_daily_counts(t: Tables):
    """ST-10: closed days only"""
    s = event_stream(t).select(F.col("ts").alias("created"), F.col("event_type").alias("family"))
    return run(t, si.daily_counts(s)).select(day_text("day"), "family", "n_jobs")


# Families reported on and their nominal counts of a day; nothing is ever of family "none".
STREAM_BANDS = (("view", 50, 150), ("purchase", 60, 70), ("none", 1, 5))


@query("stream_production_days", "", f"""
WITH c AS (SELECT event_type AS family, CAST(ts AS DATE) AS day, count(*) AS n FROM events
  WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1, 2),
b(family, lower, upper) AS (VALUES {", ".join(map(str, STREAM_BANDS))}),
cal AS (SELECT b.*, CAST(unnest(generate_series((SELECT min(day) FROM c), (SELECT max(day) FROM c), INTERVAL 1 DAY)) AS DATE) AS day FROM b)
SELECT coalesce(c.family, cal.family) AS family, strftime(coalesce(c.day, cal.day), '%Y-%m-%d') AS day, coalesce(n, 0) AS n_jobs,
  CASE WHEN coalesce(n, 0) < lower THEN 'below' WHEN coalesce(n, 0) > upper THEN 'above' ELSE 'nominal' END AS verdict
FROM c FULL JOIN cal ON c.family = cal.family AND c.day = cal.day""")
def stream_production_days(t: Tables):
    """ST-10 with bands: closed days, those without any job included"""
    out = shared_folder(t.spark, "production")
    bands = t.spark.createDataFrame(list(STREAM_BANDS), "family string, lower int, upper int")
    s = si.daily_counts(event_stream(t).select(F.col("ts").alias("created"), F.col("event_type").alias("family")))
    q = sr.start(s, si.production_days(f"{out}/t", bands), f"{out}/checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    rows = t.spark.read.schema("family string, day date, n_jobs long, verdict string").option("recursiveFileLookup", True).parquet(f"{out}/t")
    return rows.select("family", day_text("day"), "n_jobs", "verdict")


@query("stream_incremental_days", "", """
WITH v AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view'), u AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view' AND user_id = 3)
SELECT strftime(day, '%Y-%m-%d') AS day FROM v WHERE day NOT IN (SELECT day FROM u)""")
def stream_incremental_days(t: Tables):
    """ST-11: days not computed yet"""
    out = shared_folder(t.spark, "days")
    used = t.products().where("product_type = 'view' AND tile_id = 3").select("day", "product_id")
    s = event_stream(t).where("event_type = 'view'").select(F.to_date("ts").alias("day"), F.col("event_id").alias("product_id"))
    q = sr.start(s, si.incremental_days(f"{out}/t", lambda: used), f"{out}/checkpoint")
    q.awaitTermination()
    days = t.spark.read.schema("day date").option("recursiveFileLookup", True).parquet(f"{out}/t/days")
    return days.distinct().select(day_text("day"))
