"""Catalogue products: de-duplication, matching, planning inputs, lineage."""

from pyspark.sql import functions as F

from firnline.functions import ids as fid
from firnline.operators import filters as fl
from firnline.operators import products as pr
from firnline.operators import slices as sl
from firnline.registry.core import CTE, Tables, day_text, query, us


# --- one product per group --------------------------------------------------------
@query("best_per_tile_day", "products", """
SELECT tile_id, strftime(day, '%Y-%m-%d') AS day, product_id FROM (SELECT *, row_number() OVER (
  PARTITION BY tile_id, day ORDER BY version DESC, mode DESC, ts DESC, product_id DESC) AS rn FROM products) WHERE rn = 1""")
def best_per_tile_day(t: Tables):
    """W-01"""
    return pr.best_per_tile_day(t.products()).select("tile_id", day_text("day"), "product_id")


@query("latest_version", "products", """
SELECT tile_id, product_type, arg_max(product_id, product_id) AS product_id FROM products GROUP BY 1, 2""")
def latest_version(t: Tables):
    """A-19: publication order follows the id"""
    return pr.latest_version(t.products(), ["tile_id", "product_type"], "product_id", "product_id").select(
        "tile_id", "product_type", "product_id"
    )


@query("newest_by_curation", "", """
SELECT user_id AS tile_id, 'GFSC_20240101-007_S1-S2_T32TLR_V100_' || max(event_id) AS product_id FROM events GROUP BY 1""")
def newest_by_curation(t: Tables):
    """T-06"""
    pid = F.concat(F.lit("GFSC_20240101-007_S1-S2_T32TLR_V100_"), F.col("event_id").cast("string"))
    rows = t.raw("events").select(F.col("user_id").alias("tile_id"), pid.alias("product_id"))
    return pr.newest_by_curation(rows)


@query("split_products", "products", """
SELECT tile_id, strftime(day, '%Y-%m-%d') AS day, product_id, n_products FROM (SELECT *, count(*) OVER (PARTITION BY tile_id, day) AS n_products FROM products) WHERE n_products >= 2""")
def split_products(t: Tables):
    """A-18"""
    return pr.split_products(t.products()).select("tile_id", day_text("day"), "product_id", "n_products")


def _sides(t: Tables):
    p = t.products()
    return p.where("product_type = 'view'"), p.where("product_type = 'click'")


BEST = """b AS (SELECT tile_id, day, product_type, product_id FROM (SELECT *, row_number() OVER (
  PARTITION BY tile_id, day, product_type ORDER BY version DESC, mode DESC, ts DESC, product_id DESC) AS rn FROM products
  WHERE product_type IN ('view', 'click')) WHERE rn = 1)"""


@query("match_tile_day", "products", f"""CTE:{BEST}
SELECT v.tile_id, strftime(v.day, '%Y-%m-%d') AS day, v.product_id AS radar_id, c.product_id AS optical_id
FROM b v JOIN b c ON v.tile_id = c.tile_id AND v.day = c.day AND v.product_type = 'view' AND c.product_type = 'click'""")
def match_tile_day(t: Tables):
    """J-06"""
    radar, optical = (pr.best_per_tile_day(x) for x in _sides(t))
    a = radar.select("tile_id", "day", F.col("product_id").alias("radar_id"))
    b = optical.select("tile_id", "day", F.col("product_id").alias("optical_id"))
    return pr.match_tile_day(a, b).select("tile_id", day_text("day"), "radar_id", "optical_id")


@query("match_documents", "products", f"""CTE:{BEST}
SELECT '{{"' || v.tile_id || '_' || strftime(v.day, '%Y%m%d') || '":{{"radar_id":' || v.product_id || ',"optical_id":' || c.product_id || '}}}}' AS value
FROM b v JOIN b c ON v.tile_id = c.tile_id AND v.day = c.day AND v.product_type = 'view' AND c.product_type = 'click'""")
def match_documents(t: Tables):
    """SNK-03, JOB-11"""
    from firnline.sinks.tables import match_documents as documents

    radar, optical = (pr.best_per_tile_day(x) for x in _sides(t))
    a = radar.select("tile_id", "day", F.col("product_id").alias("radar_id"))
    b = optical.select("tile_id", "day", F.col("product_id").alias("optical_id"))
    return documents(pr.match_tile_day(a, b), "radar_id", "optical_id")


@query("missing_keys", "", "SELECT c_custkey AS tile_id FROM customer EXCEPT SELECT user_id FROM events")
def missing_keys(t: Tables):
    """U-02"""
    tiles = t.raw("customer").select(F.col("c_custkey").alias("tile_id"))
    return pr.missing(tiles, t.products(), ["tile_id"])


@query("common_keys", "products", """
SELECT tile_id, strftime(day, '%Y-%m-%d') AS day FROM (SELECT tile_id, day FROM products WHERE product_type = 'view'
INTERSECT SELECT tile_id, day FROM products WHERE product_type = 'click')""")
def common_keys(t: Tables):
    """U-03"""
    return pr.common_keys(*_sides(t), ["tile_id", "day"]).select("tile_id", day_text("day"))


@query("drop_obsolete", "products", "SELECT product_id, tile_id FROM products WHERE product_id NOT IN (SELECT event_id FROM events WHERE event_type = 'error')")
def drop_obsolete(t: Tables):
    """U-05"""
    gone = t.raw("events").where("event_type = 'error'").select(F.col("event_id").alias("product_id"))
    return pr.drop_obsolete(t.products(), gone, ["product_id"]).select("product_id", "tile_id")


@query("union_products", "", "SELECT event_type AS kind, event_id AS product_id FROM events WHERE event_type IN ('view', 'click') UNION ALL SELECT 'order', o_orderkey FROM orders")
def union_products(t: Tables):
    """U-01"""
    e = t.raw("events").where(F.col("event_type").isin("view", "click"))
    return e.select(F.col("event_type").alias("kind"), F.col("event_id").alias("product_id")).unionByName(
        t.raw("orders").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("product_id"))
    )


# --- new jobs -----------------------------------------------------------------------
NEW = """cand AS (SELECT event_id AS seq, 's' || (event_id // 2) AS source_id, user_id AS tile_id, CAST(ts AS DATE) AS m,
  event_id % 5 AS created, CAST(ts AS DATE) + to_hours(event_id % 40) AS published FROM events WHERE event_type IN ('view', 'click')),
ex AS (SELECT 's' || (event_id // 2) AS source_id, user_id AS tile_id, CAST(ts AS DATE) AS m, event_id % 5 AS created, event_id AS id
  FROM events WHERE event_type = 'signup'),
f AS (SELECT cand.*, NOT EXISTS (SELECT 1 FROM ex WHERE ex.tile_id = cand.tile_id AND ex.m = cand.m) AS fresh,
  NOT EXISTS (SELECT 1 FROM ex WHERE ex.source_id = cand.source_id) AND published - m <= INTERVAL 24 HOUR
  AND EXISTS (SELECT 1 FROM ex WHERE ex.tile_id = cand.tile_id AND ex.m = cand.m AND ex.created <> cand.created) AS version FROM cand),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY seq) AS rn FROM f WHERE fresh OR version) WHERE rn = 1)"""


def _candidates(t: Tables):
    e = t.events()
    m = F.to_date("ts").cast("timestamp")
    hours = (F.col("event_id") % 40) * 3_600_000_000
    base = e.select(
        F.col("event_id").alias("seq"), F.col("event_id").alias("id"), "event_type",
        F.concat(F.lit("s"), F.floor(F.col("event_id") / 2).cast("string")).alias("source_id"),
        F.col("user_id").alias("tile_id"), m.alias("measurement_date"),
        (F.col("event_id") % 5).alias("creation_date"),
        F.timestamp_micros(F.unix_micros(m) + hours).alias("publication_date"),
    )
    return base.where(F.col("event_type").isin("view", "click")), base.where("event_type = 'signup'")


@query("new_jobs", "", f"WITH {NEW} SELECT seq, source_id, tile_id FROM k WHERE fresh OR version")
def new_jobs(t: Tables):
    """J-05: candidates kept"""
    return pr.new_jobs(*_candidates(t))[0].select("seq", "source_id", "tile_id")


@query("superseded_jobs", "", f"""WITH {NEW} SELECT ex.id FROM ex WHERE EXISTS (SELECT 1 FROM k WHERE k.version AND NOT k.fresh
  AND k.tile_id = ex.tile_id AND k.m = ex.m AND k.created <> ex.created)""")
def superseded_jobs(t: Tables):
    """J-05: existing rows that stop being the reference"""
    return pr.new_jobs(*_candidates(t))[1].select("id")


@query("one_trigger", "products", """
SELECT tile_id, strftime(day, '%Y-%m-%d') AS day, product_id FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, day
  ORDER BY CAST(product_type = 'view' AS INTEGER), ts, product_id) AS rn FROM products) WHERE rn = 1""")
def one_trigger(t: Tables):
    """W-08"""
    rows = pr.one_trigger(t.products(), ["tile_id", "day"], F.col("product_type") == "view", ["measurement_date", "product_id"])
    return rows.select("tile_id", day_text("day"), "product_id")


@query("supersede", "products", """
SELECT product_id AS id, max(product_id) OVER (PARTITION BY tile_id, day) AS overriding_job_id,
  max(product_id) OVER (PARTITION BY tile_id, day) <> product_id AS cancelled FROM products""")
def supersede(t: Tables):
    """W-11: curation order follows the id here"""
    rows = t.products().select(F.col("product_id").alias("id"), "tile_id", "day", F.col("product_id").alias("curated"))
    return pr.supersede(rows, ["tile_id", "day"], "curated").select("id", "overriding_job_id", "cancelled")


@query("elect_master", "", """
WITH j AS (SELECT event_id AS id, user_id * 100 + day(ts) AS assembly_id FROM events WHERE event_type IN ('view', 'click')),
x AS (SELECT user_id * 100 + day(ts) AS assembly_id, max(event_id) AS known FROM events WHERE event_type = 'signup' GROUP BY 1),
m AS (SELECT assembly_id, min(id) AS first FROM j GROUP BY 1)
SELECT j.id, j.assembly_id, CASE WHEN coalesce(known, first) = j.id THEN 0 ELSE coalesce(known, first) END AS assembly_master_job_id
FROM j JOIN m USING (assembly_id) LEFT JOIN x USING (assembly_id)""")
def elect_master(t: Tables):
    """W-09"""
    e = t.events().select(
        F.col("event_id").alias("id"), (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("assembly_id"), "event_type"
    )
    jobs = e.where(F.col("event_type").isin("view", "click")).drop("event_type")
    return pr.elect_master(jobs, e.where("event_type = 'signup'"))


@query("drop_twin_triggers", "", """
WITH j AS (SELECT event_id, 'FSC_20240101T000000_S2A_T' || user_id || '_V100_' || (event_id % 2) AS trig,
  'FSC_20240101T000000_S2A_T' || (user_id + event_id % 3) || '_V100_0' AS used FROM events)
SELECT event_id, trig AS triggering_product_id FROM j WHERE NOT (trig LIKE '%\\_1' ESCAPE '\\' AND used = left(trig, length(trig) - 1) || '0')""")
def drop_twin_triggers(t: Tables):
    """J-30"""
    pre = F.lit("FSC_20240101T000000_S2A_T")
    trig = F.concat(pre, F.col("user_id").cast("string"), F.lit("_V100_"), (F.col("event_id") % 2).cast("string"))
    used = F.concat(pre, (F.col("user_id") + F.col("event_id") % 3).cast("string"), F.lit("_V100_0"))
    jobs = t.raw("events").select("event_id", trig.alias("triggering_product_id"), F.array(used).alias("input_ids"))
    return pr.drop_twin_triggers(jobs).select("event_id", "triggering_product_id")


# --- pairing in time ------------------------------------------------------------------
SENS = """s AS (SELECT *, 'S1' || chr(CAST(65 + product_id % 3 AS INTEGER)) AS satellite, CAST(epoch_us(ts) % 86400000000 AS DOUBLE) AS u FROM products)"""


@query("nearest_satellite", "products", f"""CTE:{SENS},
r AS (SELECT tile_id, day, satellite, avg(u) AS radar_mean, count(*) AS n_radar FROM s WHERE product_type = 'view' GROUP BY 1, 2, 3),
o AS (SELECT tile_id, day, avg(u) AS optical_mean FROM s WHERE product_type = 'click' GROUP BY 1, 2)
SELECT tile_id, strftime(day, '%Y-%m-%d') AS day, satellite, n_radar FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, day
  ORDER BY abs(radar_mean - optical_mean), satellite) AS rn FROM r JOIN o USING (tile_id, day)) WHERE rn = 1""")
def nearest_satellite(t: Tables):
    """J-09"""
    radar, optical = _sides(t)
    sat = F.concat(F.lit("S1"), F.char((F.lit(65) + F.col("product_id") % 3).cast("int")))
    out = pr.nearest_satellite(radar.withColumn("satellite", sat), optical)
    return out.select("tile_id", day_text("day"), "satellite", "n_radar")


@query("pairing_days", "products", """CTE:b AS (SELECT day FROM products WHERE product_type = 'view' INTERSECT SELECT day FROM products WHERE product_type = 'click'),
c AS (SELECT day, max(day) OVER () AS start_day FROM b WHERE day <= DATE '2024-01-24' AND day >= DATE '2024-01-03')
SELECT strftime(day, '%Y-%m-%d') AS day, strftime(start_day, '%Y-%m-%d') AS start_day FROM c WHERE start_day - day <= 10""")
def pairing_days(t: Tables):
    """W-14"""
    radar, optical = _sides(t)
    out = pr.pairing_days(
        radar, optical, F.lit("2024-01-25 05:00:00").cast("timestamp"), F.lit("2024-01-03").cast("timestamp"), 10, 8
    )
    return out.select(day_text("day"), day_text("start_day", "start_day"))


@query("inputs_in_window", "products", """
WITH_W""".replace("WITH_W", """SELECT t.product_id AS trigger_id, p.product_id FROM products t JOIN products p ON p.tile_id = t.tile_id
  AND p.ts >= CAST(CAST(CASE WHEN t.day = DATE '2024-01-20' THEN TIMESTAMP '2024-01-20 12:00:00' ELSE CAST(t.day AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND END AS DATE) - 2 AS TIMESTAMP)
  AND p.ts <= CASE WHEN t.day = DATE '2024-01-20' THEN TIMESTAMP '2024-01-20 12:00:00' ELSE CAST(t.day AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND END
WHERE t.product_type = 'signup' AND p.product_type <> 'signup'"""))
def inputs_in_window(t: Tables):
    """J-21"""
    p = t.products()
    triggers = p.where("product_type = 'signup'").select(
        F.col("product_id").alias("trigger_id"), "tile_id", F.col("day").alias("product_date"),
        F.lit("2024-01-20 12:00:00").cast("timestamp").alias("curation_timestamp"),
    )
    return pr.inputs_in_window(triggers, p.where("product_type <> 'signup'"), 3).select("trigger_id", "product_id")


@query("wet_snow_candidates", "products", """
SELECT r.product_id AS radar_id, o.product_id AS snow_id FROM products r JOIN products o ON r.tile_id = o.tile_id AND r.day = o.day
WHERE r.product_type = 'view' AND o.product_type = 'click' AND NOT EXISTS (SELECT 1 FROM products e WHERE e.product_type = 'signup' AND e.tile_id = r.tile_id AND e.day = r.day)""")
def wet_snow_candidates(t: Tables):
    """J-22"""
    radar, snow = _sides(t)
    done = t.products().where("product_type = 'signup'")
    return pr.wet_snow_candidates(
        radar.select("tile_id", "day", F.col("product_id").alias("radar_id")),
        snow.select("tile_id", "day", F.col("product_id").alias("snow_id")), done,
    ).select("radar_id", "snow_id")


@query("allowed_tracks", "", """
SELECT event_id FROM events JOIN customer ON c_custkey = user_id WHERE event_id % 25 IN (c_nationkey, (c_nationkey + 7) % 25)""")
def allowed_tracks(t: Tables):
    """J-19, SRC-06"""
    n = F.col("c_nationkey")
    tracks = t.raw("customer").select(F.col("c_custkey").alias("tile_id"), F.array(n.cast("long"), ((n + 7) % 25).cast("long")).alias("tracks"))
    acq = t.raw("events").select("event_id", F.col("user_id").alias("tile_id"), (F.col("event_id") % 25).alias("track"))
    return pr.allowed_tracks(acq, tracks).select("event_id")


@query("idle_tiles", "", """
WITH g AS (SELECT user_id AS tile_id, max(event_id) AS stamp, arg_max(ts, event_id) AS m FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT c_custkey AS tile_id, 'GFSC_20240101-007_S1-S2_T' || c_custkey || '_V100_' || stamp AS product_id FROM customer JOIN g ON tile_id = c_custkey
WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'view' AND CAST(ts AS DATE) = DATE '2024-01-28')
  AND TIMESTAMP '2024-01-28' < m + INTERVAL 7 DAY AND CAST(m AS DATE) <> DATE '2024-01-28'""")
def idle_tiles(t: Tables):
    """J-20"""
    tiles = t.raw("customer").select(F.col("c_custkey").alias("tile_id"))
    e = t.events()
    inputs = e.where((F.col("event_type") == "view") & (F.to_date("ts") == F.lit("2024-01-28").cast("date"))).select(F.col("user_id").alias("tile_id"))
    pid = F.concat(F.lit("GFSC_20240101-007_S1-S2_T"), F.col("user_id").cast("string"), F.lit("_V100_"), F.col("event_id").cast("string"))
    filled = e.where("event_type = 'purchase'").select(F.col("user_id").alias("tile_id"), pid.alias("product_id"), F.col("ts").alias("measurement_date"))
    return pr.idle_tiles(tiles, inputs, filled, "2024-01-28").select("tile_id", "product_id")


@query("add_publication", "", """
SELECT o_orderkey AS job_id, epoch_us(max(ts)) AS published_us FROM orders JOIN events ON user_id = o_custkey GROUP BY 1""")
def add_publication(t: Tables):
    """J-18: known products"""
    jobs = t.raw("orders").select(F.col("o_orderkey").alias("job_id"), F.col("o_custkey").alias("product_id"))
    hub = t.events().select(F.col("user_id").alias("product_id"), F.col("ts").alias("publication_date"))
    return pr.add_publication(jobs, hub)[0].select("job_id", us("hub_publication_date", "published_us"))


@query("absent_publication", "", "SELECT o_orderkey AS job_id FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def absent_publication(t: Tables):
    """J-18: strict misses"""
    jobs = t.raw("orders").select(F.col("o_orderkey").alias("job_id"), F.col("o_custkey").alias("product_id"))
    hub = t.events().select(F.col("user_id").alias("product_id"), F.col("ts").alias("publication_date"))
    return pr.add_publication(jobs, hub)[1].select("job_id")


@query("latest_input", "", "SELECT l_orderkey AS job_id, epoch_us(max(l_shipdate)) AS latest_us FROM lineitem GROUP BY 1")
def latest_input(t: Tables):
    """A-30"""
    rows = t.raw("lineitem").select(F.col("l_orderkey").alias("job_id"), "l_shipdate")
    return pr.latest_input(rows, "job_id", "l_shipdate").select("job_id", us("latest_date", "latest_us"))


@query("collect_inputs", "products", """
SELECT tile_id, strftime(day, '%Y-%m-%d') AS day, product_type, product_id, count(*) OVER w AS n_inputs, epoch_us(max(ts) OVER w) AS latest_us
FROM products WINDOW w AS (PARTITION BY tile_id, day, product_type)""")
def collect_inputs(t: Tables):
    """A-31"""
    out = pr.collect_inputs(t.products(), ["tile_id", "day", "product_type"], "product_id", "measurement_date")
    return out.select("tile_id", day_text("day"), "product_type", "product_id", "n_inputs", us("latest_date", "latest_us"))


# --- lineage ---------------------------------------------------------------------------
@query("product_span", "", """
SELECT l_orderkey AS product_id, epoch_us(min(l_shipdate)) AS begin_us, epoch_us(max(l_shipdate)) AS end_us, count(*) AS n_inputs
FROM (SELECT DISTINCT l_orderkey, l_partkey, l_shipdate FROM lineitem) GROUP BY 1""")
def product_span(t: Tables):
    """A-16"""
    li = t.raw("lineitem")
    edges = li.select(
        F.col("l_orderkey").alias("product_id"),
        F.concat_ws("-", "l_partkey", "l_shipdate").alias("input_id"),
        F.col("l_shipdate").alias("begin"), F.col("l_shipdate").alias("end"),
    )
    return pr.product_span(edges).select("product_id", us("span_begin", "begin_us"), us("span_end", "end_us"), "n_inputs")


@query("obsolete_inputs", "", """
WITH i AS (SELECT user_id AS job_id, event_id AS product_id, CAST(ts AS DATE) AS day, event_id % 3 <> 0 AS hit FROM events)
SELECT job_id, product_id, strftime(day, '%Y-%m-%d') AS day FROM (SELECT *, bool_and(hit) OVER (PARTITION BY job_id, day) AS whole FROM i) WHERE whole""")
def obsolete_inputs(t: Tables):
    """A-26"""
    e = t.events()
    inputs = e.select(F.col("user_id").alias("job_id"), F.col("event_id").alias("product_id"), F.to_date("ts").alias("day"))
    edges = e.where("event_id % 3 <> 0").select(F.col("user_id").alias("job_id"), F.col("event_id").alias("product_id"))
    return pr.obsolete_inputs(inputs, edges).select("job_id", "product_id", day_text("day"))


@query("search_intervals", "products", """CTE:d AS (SELECT DISTINCT tile_id, day FROM products WHERE product_type = 'view'),
g AS (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY tile_id ORDER BY day) > 3 THEN 1 ELSE 0 END AS brk FROM d),
r AS (SELECT *, sum(brk) OVER (PARTITION BY tile_id ORDER BY day) AS run FROM g)
SELECT tile_id, strftime(min(day), '%Y-%m-%d') AS date_min, strftime(max(day), '%Y-%m-%d') AS date_max, count(*) AS n_days FROM r GROUP BY tile_id, run""")
def search_intervals(t: Tables):
    """W-03"""
    rows = t.products().where("product_type = 'view'")
    out = pr.search_intervals(rows, ["tile_id"], "day", 3)
    return out.select("tile_id", day_text("date_min", "date_min"), day_text("date_max", "date_max"), "n_days")


@query("check_support", "products", """
SELECT tile_id, count(*) AS n_products, CASE WHEN count(*) < 5 THEN 'error' WHEN count(*) < 20 THEN 'warning' ELSE 'ok' END AS level
FROM products WHERE product_type = 'view' GROUP BY 1""")
def check_support(t: Tables):
    """A-05"""
    return pr.check_support(t.products().where("product_type = 'view'"))


@query("duplicate_slices", "", """
SELECT min(event_id) AS seq FROM events GROUP BY event_type, user_id, CASE WHEN event_id % 4 <> 0 THEN CAST(event_id % 4 AS VARCHAR) ELSE strftime(ts, '%Y%m%d%H%M%S') END""")
def duplicate_slices(t: Tables):
    """W-10"""
    acq = t.events().select(
        F.col("event_id").alias("seq"), F.col("event_type").alias("platform"), F.col("user_id").alias("take_id"),
        (F.col("event_id") % 4).alias("slice"), F.col("ts").alias("start_ts"),
    )
    return pr.duplicate_slices(acq).select("seq")


# Slices of a stripe, one round per slice of the longest; kinds: 0 left out, 1 added,
# 2 alone in a new assembly, 3 closes an assembly and opens the next.
CTE["acq_stripes"] = """acq AS (SELECT event_type || '_' || user_id AS stripe_id, CAST(event_id AS VARCHAR) AS product_id,
  epoch_us(ts) AS a, epoch_us(ts) AS b, 0 AS slice, 0 AS total FROM events)"""
CTE["acq_take"] = """acq AS (SELECT 'T' || event_id // 97 AS stripe_id, CAST(event_id AS VARCHAR) AS product_id,
  1704067200000000 + event_id % 97 * 25000000 - CASE WHEN event_id % 11 = 0 THEN 24400000 ELSE 0 END AS a,
  1704067225000000 + event_id % 97 * 25000000 - CASE WHEN event_id % 13 = 0 THEN 3000000 ELSE 0 END AS b,
  CAST(CASE WHEN event_id % 17 = 5 THEN 0 WHEN event_id % 19 = 7 THEN 1 ELSE event_id % 97 % 24 + 1 END AS INTEGER) AS slice, 24 AS total FROM events)"""
ASSEMBLIES = """CTE:RECURSIVE n AS (SELECT *, row_number() OVER (PARTITION BY stripe_id ORDER BY a, product_id) AS rn FROM acq),
f AS (SELECT stripe_id, rn, product_id, a, b, slice, 1 AS cnt, 1 AS num, 0 AS pos, 1 AS kind, slice <> 1 AS ef, NOT (slice <> 0 AND slice = total) AS el FROM n WHERE rn = 1
  UNION ALL SELECT stripe_id, rn, product_id, CASE kind WHEN 0 THEN oa ELSE a END, CASE kind WHEN 0 THEN ob ELSE b END, CASE kind WHEN 0 THEN oslice ELSE slice END,
    CASE kind WHEN 0 THEN cnt WHEN 1 THEN cnt + 1 ELSE 1 END, num + CASE WHEN kind >= 2 THEN 1 ELSE 0 END, cnt, kind, kind = 2, NOT (slice <> 0 AND slice = total)
  FROM (SELECT n.*, f.a AS oa, f.b AS ob, f.slice AS oslice, f.cnt, f.num,
      CASE WHEN (n.a - f.a) % 86400000000 // 1000000 <= 1 THEN 0
        WHEN (n.slice <> 0 AND f.slice <> 0 AND n.slice - f.slice <> 1)
          OR ((n.a - f.b) % 86400000000 + 86400000000) % 86400000000 // 1000000 > 1 THEN 2
        WHEN f.cnt + 1 >= 2 THEN 3 ELSE 1 END AS kind
    FROM f JOIN n ON n.stripe_id = f.stripe_id AND n.rn = f.rn + 1))
SELECT stripe_id, CAST(num AS INTEGER) AS assembly_no, CAST(CASE kind WHEN 1 THEN pos ELSE 0 END AS INTEGER) AS position, product_id, ef AS exclude_first, el AS exclude_last
FROM f WHERE kind IN (1, 2)
UNION ALL SELECT stripe_id, CAST(num - 1 AS INTEGER), CAST(pos AS INTEGER), product_id, false, el FROM f WHERE kind = 3
UNION ALL SELECT stripe_id, CAST(num AS INTEGER), 0, product_id, true, el FROM f WHERE kind = 3"""


@query("assemble_slices", "acq_stripes", ASSEMBLIES)
def assemble_slices(t: Tables):
    """W-04: slices without numbers, in order of time"""
    acq = t.events().select(
        F.concat_ws("_", "event_type", "user_id").alias("stripe_id"),
        F.col("event_id").cast("string").alias("product_id"),
        F.col("ts").alias("start_ts"), F.col("ts").alias("stop_ts"),
        F.lit(0).alias("slice"), F.lit(0).alias("total_slices"),
    )
    return sl.assemble_slices(acq)


@query("assemble_take", "acq_take", ASSEMBLIES)
def assemble_take(t: Tables):
    """W-04: numbered slices 25 seconds apart, some repeated, missing or cut short"""
    i = F.col("event_id")
    base = 1704067200000000 + i % 97 * 25_000_000
    acq = t.events().select(
        F.concat(F.lit("T"), F.floor(i / 97)).alias("stripe_id"), i.cast("string").alias("product_id"),
        F.timestamp_micros(base - F.when(i % 11 == 0, 24_400_000).otherwise(0)).alias("start_ts"),
        F.timestamp_micros(base + 25_000_000 - F.when(i % 13 == 0, 3_000_000).otherwise(0)).alias("stop_ts"),
        F.when(i % 17 == 5, 0).when(i % 19 == 7, 1).otherwise(i % 97 % 24 + 1).cast("int").alias("slice"), F.lit(24).alias("total_slices"),
    )
    return sl.assemble_slices(acq)


@query("filter_products", "", """
SELECT event_id AS product_id FROM events WHERE user_id = 3 AND ts > TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-29'
  AND ts >= TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-25'""")
def filter_products(t: Tables):
    """PF-09"""
    rows = t.events().select(
        F.col("event_id").alias("product_id"), F.col("user_id").alias("tile_id"),
        F.col("ts").alias("publication_date"), F.col("ts").alias("measurement_date"),
    )
    return fl.filter_products(rows, 3, "2024-01-02", "2024-01-29", "2024-01-03", "2024-01-25").select("product_id")


@query("radar_ground_range", "", "SELECT event_id FROM events WHERE event_type IN ('view', 'click') AND user_id % 2 = 0")
def radar_ground_range(t: Tables):
    """PF-11"""
    pol = F.when(F.col("event_type") == "view", "DV").when(F.col("event_type") == "click", "DH").otherwise("SV")
    kind = F.when(F.col("user_id") % 2 == 0, "IW_GRDH").otherwise("IW_SLC")
    rows = t.raw("events").select("event_id", pol.alias("polarisation"), kind.alias("product_type"))
    return fl.radar_ground_range(rows).select("event_id")


@query("id_tokens", "", """
SELECT event_id, 'FSC' AS product_type, strftime(ts, '%Y-%m-%d') AS day, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS sensed_s,
  'T' || lpad(CAST(1 + user_id % 60 AS VARCHAR), 2, '0') || 'ABC' AS tile_id, CAST(event_id % 2 AS VARCHAR) AS mode,
  'FSC_' || strftime(ts, '%Y%m%dT%H%M%S') || '_S2A_T' || lpad(CAST(1 + user_id % 60 AS VARCHAR), 2, '0') || 'ABC_V100_' || (1 - event_id % 2) AS twin
FROM events""")
def id_tokens(t: Tables):
    """F-01"""
    pid = _product_id()
    e = t.events().select("event_id", pid.alias("p"))
    p = F.col("p")
    return e.select(
        "event_id", fid.id_token(p, 0).alias("product_type"), day_text(fid.id_day(p)),
        F.unix_seconds(fid.id_time(p)).alias("sensed_s"), fid.id_token(p, 3).alias("tile_id"),
        fid.id_mode(p).alias("mode"), fid.toggled_mode_id(p).alias("twin"),
    )


def _product_id():
    tile = F.lpad((F.col("user_id") % 60 + 1).cast("string"), 2, "0")
    return F.concat(
        F.lit("FSC_"), F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit("_S2A_T"), tile, F.lit("ABC_V100_"),
        (F.col("event_id") % 2).cast("string"),
    )


@query("object_paths", "", """
SELECT event_id, 'store/' || strftime(ts, '%Y/%m/%d') || '/' || event_id || '/thumbnail.png' AS preview, 'store' AS bucket,
  strftime(ts, '%Y/%m/%d') AS prefix, CAST(event_id AS VARCHAR) AS object FROM events""")
def object_paths(t: Tables):
    """F-02"""
    pid = F.col("event_id").cast("string")
    path = F.concat_ws("/", F.lit("store"), F.date_format("ts", "yyyy/MM/dd"), pid)
    e = t.events().select("event_id", path.alias("path"))
    parts = fid.split_object_path(F.col("path"))
    return e.select(
        "event_id", fid.preview_path(F.col("path")).alias("preview"), parts["bucket"].alias("bucket"),
        parts["prefix"].alias("prefix"), parts["object"].alias("object"),
    )
