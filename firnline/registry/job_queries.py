"""Job tables, status log, reports."""

from pyspark.sql import functions as F

from firnline import codes
from firnline.functions.ids import wildcard_match
from firnline.operators import filters as fl
from firnline.operators import jobs as jb
from firnline.operators import reporting as rp
from firnline.plans import operations as ops
from firnline.registry.core import CTE, Tables, day_text, query, us

NAMES = "CASE %s " + " ".join(f"WHEN {c} THEN '{n}'" for c, n in codes.JOB_STATUS) + " END"
ALLOWED = " OR ".join(
    f"(p = {k} AND job_status IN ({', '.join(map(str, v))}))" for k, v in codes.ALLOWED_NEXT.items()
)
LAST = """last AS (SELECT fk_parent_job_id, max(id) AS id FROM log GROUP BY 1),
ls AS (SELECT l.fk_parent_job_id AS parent_job_id, l.job_status AS status, l.id AS change_id, l.time, l.error_subtype
  FROM log l JOIN last USING (id))"""


@query("last_status", "log", """
SELECT fk_parent_job_id AS parent_job_id, arg_max(job_status, id) AS status, max(id) AS change_id,
  epoch_us(arg_max(time, id)) AS time_us FROM log GROUP BY 1""")
def last_status(t: Tables):
    """A-01 without a filter (the flagship query)."""
    return jb.last_status(t.log()).select("parent_job_id", "status", "change_id", us("time", "time_us"))


@query("last_status_in", "log", f"CTE:{LAST} SELECT parent_job_id, status, change_id FROM ls WHERE status IN (12, 14)")
def last_status_in(t: Tables):
    """A-01: status filter after the aggregate."""
    return jb.last_status(t.log(), statuses=[12, 14]).select("parent_job_id", "status", "change_id")


@query("select_columns", "", "SELECT event_id, event_type FROM events")
def select_columns(t: Tables):
    """PF-01"""
    return fl.select_columns(t.raw("events"), ["event_id", "event_type"])


@query("equal_to", "", "SELECT event_id, user_id FROM events WHERE event_type = 'view' AND user_id = 3")
def equal_to(t: Tables):
    """PF-02"""
    return fl.equal_to(t.raw("events"), {"event_type": "view", "user_id": 3}).select("event_id", "user_id")


@query("is_null", "", "SELECT c_custkey FROM customer LEFT JOIN (SELECT DISTINCT user_id FROM events) ON user_id = c_custkey WHERE user_id IS NULL")
def is_null(t: Tables):
    """PF-03"""
    users = t.raw("events").select("user_id").distinct()
    joined = t.raw("customer").join(users, F.col("c_custkey") == F.col("user_id"), "left")
    return fl.equal_to(joined, {"user_id": None}).select("c_custkey")


@query("among_list", "", "SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'click')")
def among_list(t: Tables):
    """PF-04"""
    return fl.among(t.raw("events"), "event_type", ["view", "click"]).select("event_id", "event_type")


@query("among_table", "", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT user_id FROM events)")
def among_table(t: Tables):
    """PF-04 with a long list"""
    wanted = t.raw("events").select("user_id")
    return fl.among(t.raw("orders"), "o_custkey", wanted).select("o_orderkey", "o_custkey")


@query("name_like", "", "SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE 'customer%5'")
def name_like(t: Tables):
    """PF-05"""
    return t.raw("customer").where(wildcard_match(F.col("c_name"), "customer*5", False)).select("c_custkey", "c_name")


@query("jobs_in_range", "", "SELECT event_id, epoch_us(ts) AS ts_us FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'")
def jobs_in_range(t: Tables):
    """PF-06"""
    e = t.raw("events")
    low, high = F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz")
    return e.where(fl.in_range(F.col("ts"), low, high)).select("event_id", us("ts", "ts_us"))


@query("jobs_in_closed_range", "", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-12'")
def jobs_in_closed_range(t: Tables):
    """PF-06, wet-snow family"""
    e = t.raw("events")
    low, high = F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz")
    return e.where(fl.in_range(F.col("ts"), low, high, closed=True)).select("event_id")


@query("jobs_with_status", "jobs parents", """
SELECT j.id, j.fk_parent_job_id FROM jobs j JOIN parents p ON p.id = j.fk_parent_job_id WHERE p.last_status_id IN (3, 9)""")
def jobs_with_status(t: Tables):
    """PF-07"""
    return fl.jobs_with_status(t.jobs(), t.parents(), [3, 9]).select("id", "fk_parent_job_id")


@query("jobs_status_tile_date", "jobs parents", """
SELECT j.id, j.fk_parent_job_id FROM jobs j JOIN parents p ON p.id = j.fk_parent_job_id
WHERE p.last_status_id IN (1, 2, 3, 4, 5, 6, 7, 8) AND p.tile_id = 4
  AND measurement_date >= TIMESTAMP '2024-01-03' AND measurement_date < TIMESTAMP '2024-01-20'""")
def jobs_status_tile_date(t: Tables):
    """PF-08"""
    return fl.jobs_status_tile_date(
        t.jobs(), t.parents(), list(range(1, 9)), 4, "2024-01-03", "2024-01-20"
    ).select("id", "fk_parent_job_id")


@query("job_view", "jobs parents", f"""
SELECT j.id, j.family, p.name AS parent_name, p.last_status_id AS parent_last_status_id,
  {NAMES % 'p.last_status_id'} AS status_name FROM jobs j JOIN parents p ON p.id = j.fk_parent_job_id""")
def job_view(t: Tables):
    """J-01"""
    return jb.job_view(t.jobs(), t.parents()).select("id", "family", "parent_name", "parent_last_status_id", "status_name")


@query("job_messages", "parents", """
SELECT p.id AS parent_job_id, p.name AS job_name,
  CASE (conv_id % 5) * 10 + 10 WHEN 50 THEN 'CRITICAL' WHEN 40 THEN 'ERROR' WHEN 30 THEN 'WARNING'
    WHEN 20 THEN 'INFO' ELSE 'DEBUG' END AS log_level_name, conv_id * 1000 + turn AS n, md5(text) AS body
FROM parents p JOIN conversations c ON p.id = c.conv_id % 100""")
def job_messages(t: Tables):
    """J-02: five-way join; executions, links and messages from conversations."""
    c = t.raw("conversations").withColumn("n", F.col("conv_id") * 1000 + F.col("turn"))
    executions = c.select((F.col("conv_id") % 100).alias("fk_parent_job_id"), F.col("n").alias("id"))
    links = c.select(
        F.col("n").alias("fk_execution_info_id"), F.sha2("text", 256).alias("fk_execution_message_id"),
        ((F.col("conv_id") % 5) * 10 + 10).alias("log_level"), F.col("n").alias("time"),
    )
    bodies = c.select(F.sha2("text", 256).alias("id"), F.col("text").alias("body")).dropDuplicates(["id"])
    out = jb.job_messages(t.parents(), executions, links, bodies)
    return out.select("parent_job_id", "job_name", "log_level_name", F.col("time").alias("n"), F.md5("body").alias("body"))


@query("attach_parent", "", """
SELECT l_orderkey, count(*) AS n_lines, round(sum(o_totalprice), 2) AS total FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def attach_parent(t: Tables):
    """J-03 at volume"""
    children = t.raw("lineitem").select(F.col("l_orderkey").alias("fk_parent_job_id"))
    parents = t.raw("orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    attached, _ = jb.attach_parent(children, parents)
    return attached.groupBy(F.col("fk_parent_job_id").alias("l_orderkey")).agg(
        F.count("*").alias("n_lines"), F.round(F.sum("parent_o_totalprice"), 2).alias("total")
    )


@query("orphans", "", "SELECT o_orderkey AS id FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def orphans(t: Tables):
    """J-03: children without a parent"""
    children = t.raw("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("fk_parent_job_id"))
    parents = t.raw("events").select(F.col("user_id").alias("id")).distinct()
    return jb.attach_parent(children, parents)[1].select("id")


@query("embed", "jobs parents", """
SELECT j.id, p.name AS parent_name FROM jobs j JOIN parents p ON p.id = j.fk_parent_job_id WHERE p.tile_id < 5""")
def embed(t: Tables):
    """J-04"""
    return jb.embed(t.jobs(), t.parents().where("tile_id < 5")).select("id", "parent_name")


@query("status_history", "log parents", f"""
SELECT p.id AS parent_job_id, p.name AS job_name, l.job_status AS status, {NAMES % 'l.job_status'} AS status_name,
  l.id AS change_id FROM log l JOIN parents p ON p.id = l.fk_parent_job_id""")
def status_history(t: Tables):
    """W-15"""
    return jb.status_history(t.log(), t.parents()).select("parent_job_id", "job_name", "status", "status_name", "change_id")


@query("worst_error", "log", """
SELECT fk_parent_job_id AS parent_job_id, max(job_status) AS worst_status FROM log WHERE job_status BETWEEN 13 AND 15 GROUP BY 1""")
def worst_error(t: Tables):
    """A-32"""
    return jb.worst_error(t.log())


@query("bad_transitions", "log", f"""CTE:h AS (SELECT id, fk_parent_job_id, job_status,
  coalesce(lag(job_status) OVER (PARTITION BY fk_parent_job_id ORDER BY id), 0) AS p FROM log)
SELECT id, fk_parent_job_id, p AS previous_status, job_status FROM h WHERE NOT ({ALLOWED})""")
def bad_transitions(t: Tables):
    """W-05"""
    return jb.bad_transitions(t.log()).select("id", "fk_parent_job_id", "previous_status", "job_status")


FAILED = """CTE:h AS (SELECT fk_parent_job_id, job_status,
  lag(job_status) OVER (PARTITION BY fk_parent_job_id ORDER BY id) AS p FROM log)
SELECT fk_parent_job_id AS parent_job_id, count(*) FILTER (WHERE p = 12 AND job_status = 14) AS failures,
  count(*) FILTER (WHERE p = 12 AND job_status = 14) >= 3 AS permanent FROM h GROUP BY 1"""


# One round per change of the longest job; the accepted status goes on.
VERDICTS = f"""CTE:RECURSIVE n AS (SELECT *, row_number() OVER (PARTITION BY fk_parent_job_id ORDER BY id) AS rn FROM log),
f AS (SELECT fk_parent_job_id, rn, id, 0 AS p, job_status FROM n WHERE rn = 1
  UNION ALL SELECT n.fk_parent_job_id, n.rn, n.id, CASE WHEN {ALLOWED.replace("job_status", "f.job_status")} THEN f.job_status ELSE p END, n.job_status
  FROM f JOIN n ON n.fk_parent_job_id = f.fk_parent_job_id AND n.rn = f.rn + 1)
SELECT fk_parent_job_id AS parent_job_id, id AS change_id, p AS previous_status, job_status, coalesce({ALLOWED}, false) AS accepted FROM f"""


@query("validate_log", "log", VERDICTS)
def validate_log(t: Tables):
    """ST-06, batch twin"""
    return jb.validate_log(t.log())


@query("publication_failures", "log", FAILED)
def publication_failures(t: Tables):
    """W-06"""
    return jb.publication_failures(t.log())


@query("stuck_jobs", "log", f"""CTE:{LAST}
SELECT parent_job_id, status, epoch_us(time) AS time_us FROM ls WHERE
  epoch_us(TIMESTAMP '2024-01-31') - epoch_us(time) >
  CASE status WHEN 4 THEN 60 WHEN 5 THEN 30 WHEN 6 THEN 30 WHEN 7 THEN 270 END * 60000000::BIGINT""")
def stuck_jobs(t: Tables):
    """ST-07, batch twin"""
    now = F.lit("2024-01-31").cast("timestamp")
    return jb.stuck_jobs(jb.last_status(t.log()), now).select("parent_job_id", "status", us("time", "time_us"))


@query("unsynced", "log parents", f"""CTE:{LAST}
SELECT p.id, p.last_status_id FROM parents p JOIN ls ON ls.parent_job_id = p.id WHERE ls.status <> p.last_status_id""")
def unsynced(t: Tables):
    """J-26"""
    return jb.unsynced(t.parents(), t.log()).select("id", "last_status_id")


@query("resync", "log parents", f"""CTE:{LAST},
err AS (SELECT DISTINCT fk_parent_job_id FROM log WHERE job_status BETWEEN 13 AND 15)
SELECT p.id, CASE WHEN ls.status <> p.last_status_id THEN ls.status ELSE p.last_status_id END AS last_status_id,
  CASE WHEN ls.status <> p.last_status_id THEN ls.change_id ELSE p.last_status_change_id END AS last_status_change_id,
  CASE WHEN ls.status <> p.last_status_id THEN ls.error_subtype END AS last_status_error_subtype,
  coalesce(ls.status <> p.last_status_id AND err.fk_parent_job_id IS NOT NULL, false) AS error_raised
FROM parents p LEFT JOIN ls ON ls.parent_job_id = p.id LEFT JOIN err ON err.fk_parent_job_id = p.id""")
def resync(t: Tables):
    """J-27"""
    return jb.resync(t.parents(), t.log()).select(
        "id", "last_status_id", "last_status_change_id", "last_status_error_subtype", "error_raised"
    )


@query("unique_violations", "", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_violations(t: Tables):
    """A-27"""
    return jb.unique_violations(t.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_products", "", "SELECT l_partkey AS product_id, count(*) AS n_jobs FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_products(t: Tables):
    """A-25"""
    return jb.duplicate_products(t.raw("lineitem").select(F.col("l_partkey").alias("product_id")))


@query("unicity", "", "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_keys FROM events")
def unicity(t: Tables):
    """U-04"""
    return t.raw("events").agg(F.count("*").alias("n_rows"), F.countDistinct("event_id").alias("n_keys"))


@query("latest_with_date", "", "SELECT event_id AS id FROM events ORDER BY ts DESC NULLS LAST, event_id LIMIT 1")
def latest_with_date(t: Tables):
    """T-02, T-03"""
    rows = t.raw("events").select(F.col("event_id").alias("id"), "ts")
    return jb.latest_with_date(rows, "ts").select("id")


@query("high_water_mark", "", "SELECT epoch_us(max(ts)) - 1000000 AS date_min_us FROM events")
def high_water_mark(t: Tables):
    """T-04"""
    mark = jb.high_water_mark(t.events(), "ts", F.lit("2024-02-01").cast("timestamp"), 7)
    return mark.select(us("date_min", "date_min_us"))


@query("ready_queue", "", """
SELECT event_id AS id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS urgency, epoch_us(ts) AS published_us FROM events""")
def ready_queue(t: Tables):
    """T-01, T-05: the whole queue with its order keys"""
    p = F.when(F.col("event_type") == "view", "nrt").when(F.col("event_type") == "click", "delayed").otherwise("reprocessing")
    rows = t.events().select(F.col("event_id").alias("id"), p.alias("priority"), F.col("ts").alias("publication_date"))
    return jb.ready_queue(rows).select("id", "urgency", us("publication_date", "published_us"))


@query("dedup_jobs", "", """
SELECT min(event_id) AS id, 'S' || (event_id % 500) || '.SAFE' AS l1c_id,
  CASE WHEN event_type IN ('view', 'click') THEN 'standard' ELSE 'reprocessing' END AS processing_type FROM events GROUP BY 2, 3""")
def dedup_jobs(t: Tables):
    """A-20"""
    rows = t.raw("events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("S"), (F.col("event_id") % 500).cast("string")).alias("l1c_id"),
        F.col("event_type").isin("view", "click").alias("nrt"),
    )
    return jb.dedup_jobs(rows).select("id", "l1c_id", "processing_type")


@query("all_products", "jobs parents", f"""
SELECT j.family AS job_table, j.id, p.last_status_id AS status_parent_id, {NAMES % 'p.last_status_id'} AS status_parent,
  CASE WHEN p.last_status_id IN (11, 12) THEN 'successful' WHEN p.last_status_id < 11 THEN 'in_progress'
    WHEN p.last_status_id = 14 THEN 'system_error' WHEN p.last_status_id IN (15, 16) THEN 'definitive_error'
    ELSE 'error' END AS simple_status_parent
FROM jobs j JOIN parents p ON p.id = j.fk_parent_job_id""")
def all_products(t: Tables):
    """A-29, U-01"""
    jobs = t.jobs().drop("tile_id")
    kinds = ("view", "click", "purchase", "signup", "error")
    families = {k: jobs.where(F.col("family") == k) for k in kinds}
    return jb.all_products(families, t.parents()).select(
        "job_table", "id", "status_parent_id", "status_parent", "simple_status_parent"
    )


@query("normalise_messages", "", "SELECT text AS body, count(*) AS n_uses FROM conversations GROUP BY 1")
def normalise_messages(t: Tables):
    """SNK-07: dictionary joined back to its links"""
    log = t.raw("conversations").select("conv_id", "turn", F.col("text").alias("body"))
    messages, links = jb.normalise_messages(log)
    uses = links.groupBy("message_key").agg(F.count("*").alias("n_uses"))
    return messages.join(uses, "message_key").select("body", "n_uses")


# --- reports -------------------------------------------------------------------
def _optical(t: Tables):
    """Optical jobs: every event a job of scene ``event_id % 5000``."""
    e = t.events()
    later = lambda h: F.timestamp_micros(F.unix_micros("ts") + (h * 3_600_000_000).cast("long"))
    return e.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("S"), (F.col("event_id") % 5000).cast("string"), F.lit(".SAFE")).alias("l1c_id"),
        F.when(F.col("event_type").isin("view", "click"), "standard").otherwise("reprocessing").alias("processing_type"),
        F.when(F.col("event_id") % 4 == 0, "init").otherwise("nominal").alias("run_mode"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("p"), F.col("event_id").cast("string"))).alias("snow_path"),
        F.col("ts").alias("source_publication_date"),
        later(F.col("event_id") % 2).alias("hub_publication_date"),
        later(F.col("event_id") % 6).alias("completion_date"),
        later(F.col("event_id") % 9).alias("product_publication_date"),
        F.col("user_id").alias("tile_id"),
    )


OPT = """opt AS (SELECT event_id AS id, 'S' || (event_id % 5000) || '.SAFE' AS l1c_id,
  CASE WHEN event_type IN ('view', 'click') THEN 'standard' ELSE 'reprocessing' END AS processing_type,
  CASE WHEN event_id % 4 = 0 THEN 'init' ELSE 'nominal' END AS run_mode,
  event_type <> 'error' AS made, ts AS source_publication_date, ts + to_hours(event_id % 6) AS completion_date,
  CAST(event_id % 9 AS DOUBLE) AS hours_total, CAST(event_id % 6 - event_id % 2 AS DOUBLE) AS hours_processing,
  user_id AS tile_id FROM events)"""
CTE["opt"] = OPT
NOMINAL = "run_mode = 'nominal' AND processing_type = 'standard'"


@query("turnaround", "opt", f"""
SELECT id, CASE WHEN made THEN hours_total END AS hours_total, CASE WHEN made THEN hours_processing END AS hours_processing
FROM opt WHERE {NOMINAL}""")
def turnaround(t: Tables):
    """A-21"""
    return rp.turnaround(_optical(t)).select("id", F.round("hours_total", 6).alias("hours_total"), F.round("hours_processing", 6).alias("hours_processing"))


@query("turnaround_hist", "opt", f"""CTE:d AS (SELECT CAST(floor(hours_total * 12) AS BIGINT) AS bin FROM opt WHERE made AND {NOMINAL}),
m AS (SELECT greatest(3, CAST(ceil(max(hours_total)) AS INTEGER)) * 12 AS top FROM opt WHERE made AND {NOMINAL}),
b AS (SELECT CAST(unnest(range(0, top + 1)) AS BIGINT) AS bin FROM m)
SELECT b.bin, b.bin * 5 AS from_minute, count(d.bin) AS n_jobs FROM b LEFT JOIN d USING (bin) GROUP BY 1, 2""")
def turnaround_hist(t: Tables):
    """A-22"""
    return rp.turnaround_hist(rp.turnaround(_optical(t)), "hours_total")


@query("turnaround_kpi", "opt", f"""
SELECT count(*) AS n_jobs, count(*) FILTER (WHERE made) AS n_made,
  round(count(*) FILTER (WHERE made) / count(*), 6) AS success_ratio,
  round(avg(CASE WHEN made THEN CAST(hours_total < 3 AS INTEGER) END), 6) AS share_total,
  round(avg(CASE WHEN made THEN CAST(hours_processing < 3 AS INTEGER) END), 6) AS share_processing
FROM opt WHERE {NOMINAL}""")
def turnaround_kpi(t: Tables):
    """A-23"""
    k = rp.turnaround_kpi(rp.turnaround(_optical(t)))
    return k.select("n_jobs", "n_made", *[F.round(c, 6).alias(c) for c in ("success_ratio", "share_total", "share_processing")])


@query("monthly_report", "opt", """CTE:d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l1c_id, processing_type ORDER BY id) AS rn FROM opt) WHERE rn = 1),
tr AS (SELECT * FROM d WHERE source_publication_date >= TIMESTAMP '2024-01-10' AND source_publication_date < TIMESTAMP '2024-01-20' AND processing_type = 'standard'),
mk AS (SELECT * FROM d WHERE completion_date >= TIMESTAMP '2024-01-10' AND completion_date < TIMESTAMP '2024-01-20')
SELECT id, CASE WHEN processing_type = 'standard' AND l1c_id IN (SELECT l1c_id FROM tr) THEN 'both' ELSE 'generated_within_period' END AS request_selection FROM mk
UNION ALL SELECT id, 'l1c_tracking' FROM tr WHERE l1c_id NOT IN (SELECT l1c_id FROM mk)""")
def monthly_report(t: Tables):
    """A-28"""
    from firnline.scale import earliest_by

    unique = earliest_by(_optical(t), ["l1c_id", "processing_type"], ["id"])
    low, high = (F.lit(d).cast("timestamp") for d in ("2024-01-10", "2024-01-20"))
    return rp.monthly_report(unique, low, high).select("id", "request_selection")


@query("operations_report", "opt log parents", f"""CTE:{LAST},
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l1c_id, processing_type ORDER BY id) AS rn FROM opt) WHERE rn = 1),
tr AS (SELECT * FROM d WHERE source_publication_date >= TIMESTAMP '2024-01-10' AND source_publication_date < TIMESTAMP '2024-01-20' AND processing_type = 'standard'),
mk AS (SELECT * FROM d WHERE completion_date >= TIMESTAMP '2024-01-10' AND completion_date < TIMESTAMP '2024-01-20'),
cv AS (SELECT c_custkey, count(id) AS n FROM customer LEFT JOIN opt ON tile_id = c_custkey GROUP BY 1),
h AS (SELECT fk_parent_job_id, job_status, lag(job_status) OVER (PARTITION BY fk_parent_job_id ORDER BY id) AS p FROM log),
pf AS (SELECT fk_parent_job_id, count(*) FILTER (WHERE p = 12 AND job_status = 14) >= 3 AS permanent FROM h GROUP BY 1),
dy AS (SELECT CAST(epoch_us(source_publication_date) // 86400000000 AS INTEGER) AS day, count(*) AS n FROM opt GROUP BY 1),
ca AS (SELECT unnest(generate_series(min(day), max(day))) AS day FROM dy)
SELECT 'monthly' AS section, CASE WHEN processing_type = 'standard' AND l1c_id IN (SELECT l1c_id FROM tr) THEN 'both' ELSE 'generated_within_period' END AS item, count(*) AS n FROM mk GROUP BY 2
UNION ALL SELECT 'monthly', 'l1c_tracking', count(*) FROM tr WHERE l1c_id NOT IN (SELECT l1c_id FROM mk) HAVING count(*) > 0
UNION ALL SELECT 'turnaround', CASE WHEN made THEN 'made' ELSE 'not made' END, count(*) FROM d WHERE {NOMINAL} GROUP BY 2
UNION ALL SELECT 'coverage', CAST(n AS VARCHAR), count(*) FROM cv GROUP BY 2
UNION ALL SELECT 'all_products', CASE WHEN last_status_id IN (11, 12) THEN 'successful' WHEN last_status_id < 11 THEN 'in_progress'
    WHEN last_status_id = 14 THEN 'system_error' WHEN last_status_id IN (15, 16) THEN 'definitive_error' ELSE 'error' END, count(*)
  FROM events JOIN parents p ON p.id = user_id GROUP BY 2
UNION ALL SELECT 'stuck', CAST(status AS VARCHAR), count(*) FROM ls WHERE epoch_us(TIMESTAMP '2024-01-31') - epoch_us(time) >
  CASE status WHEN 4 THEN 60 WHEN 5 THEN 30 WHEN 6 THEN 30 WHEN 7 THEN 270 END * 60000000::BIGINT GROUP BY 2
UNION ALL SELECT 'publication_failures', CASE WHEN permanent THEN 'true' ELSE 'false' END, count(*) FROM pf GROUP BY 2
UNION ALL SELECT 'bands', CASE WHEN coalesce(n, 0) < 400 THEN 'below' WHEN n > 600 THEN 'above' ELSE 'nominal' END, count(*) FROM ca LEFT JOIN dy USING (day) GROUP BY 2""")
def operations_report(t: Tables):
    """JOB-10: every table of the report, counted by its verdict or class"""
    optical = _optical(t).withColumn("nrt", F.col("processing_type") == "standard").withColumn("fk_parent_job_id", F.col("tile_id"))
    tiles = t.raw("customer").select(F.col("c_custkey").alias("tile_id"))
    low, high, now = (F.lit(d).cast("timestamp") for d in ("2024-01-10", "2024-01-20", "2024-01-31"))
    made = optical.select(F.lit("optical").alias("family"), F.col("source_publication_date").alias("created"))
    report = ops.operations_report(optical, t.parents(), t.log(), tiles, low, high, now, made)
    item = {
        "monthly": F.col("request_selection"),
        "turnaround": F.when(F.col("made"), "made").otherwise("not made"),
        "all_products": F.col("simple_status_parent"),
        "stuck": F.col("status").cast("string"),
        "publication_failures": F.col("permanent").cast("string"),
    }
    out = report["coverage"].select(F.lit("coverage").alias("section"), F.col("n_products").cast("string").alias("item"), F.col("n_tiles").alias("n"))
    for section, column in item.items():
        out = out.unionByName(report[section].groupBy(column.alias("item")).agg(F.count("*").alias("n")).withColumn("section", F.lit(section)))
    bands = report["bands"].where("family = 'optical'").groupBy(F.col("verdict").alias("item")).agg(F.count("*").alias("n"))
    return out.unionByName(bands.withColumn("section", F.lit("bands")))


@query("production_bands", "", """
WITH n AS (SELECT CASE event_type WHEN 'view' THEN 'optical' WHEN 'click' THEN 'radar_ice' WHEN 'purchase' THEN 'paired_ice'
    WHEN 'signup' THEN 'wet_snow' ELSE 'gap_filled' END AS family, CAST(ts AS DATE) AS day, count(*) AS n_jobs FROM events GROUP BY 1, 2),
b(family, lower, upper) AS (VALUES ('optical', 400, 600), ('radar_ice', 80, 120), ('paired_ice', 80, 150), ('wet_snow', 150, 300), ('gap_filled', 850, 1150)),
d AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM n)
SELECT family, strftime(d.day, '%Y-%m-%d') AS day, coalesce(n_jobs, 0) AS n_jobs,
  CASE WHEN coalesce(n_jobs, 0) < lower THEN 'below' WHEN n_jobs > upper THEN 'above' ELSE 'nominal' END AS verdict
FROM d CROSS JOIN b LEFT JOIN n USING (family, day)""")
def production_bands(t: Tables):
    """A-24"""
    kinds = {"view": "optical", "click": "radar_ice", "purchase": "paired_ice", "signup": "wet_snow"}
    family = F.lit("gap_filled")
    for k, v in kinds.items():
        family = F.when(F.col("event_type") == k, v).otherwise(family)
    jobs = t.events().select(family.alias("family"), F.col("ts").alias("created"))
    return rp.production_bands(jobs).select("family", day_text("day"), "n_jobs", "verdict")


@query("coverage_per_tile", "", """
SELECT c_custkey AS tile_id, count(event_id) AS n_products FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1""")
def coverage_per_tile(t: Tables):
    """A-17: products per tile, zero included"""
    jobs = t.raw("events").select(F.col("user_id").alias("tile_id"))
    return rp.coverage_per_tile(jobs, t.raw("customer").select(F.col("c_custkey").alias("tile_id")))


@query("coverage_stats", "", """
SELECT n_products, count(*) AS n_tiles FROM (SELECT c_custkey, count(event_id) AS n_products FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1) GROUP BY 1""")
def coverage_stats(t: Tables):
    """A-17: tiles by number of products"""
    jobs = t.raw("events").select(F.col("user_id").alias("tile_id"))
    return rp.coverage_stats(jobs, t.raw("customer").select(F.col("c_custkey").alias("tile_id")))


@query("area_share", "", """
SELECT count(*) AS n_jobs, round(100.0 * count(*) FILTER (WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10)) / count(*), 6) AS percent_in_area FROM events""")
def area_share(t: Tables):
    """A-17: share on tiles of the area"""
    jobs = t.raw("events").select(F.col("user_id").alias("tile_id"))
    tiles = t.raw("customer").where("c_nationkey < 10").select(F.col("c_custkey").alias("tile_id"))
    return rp.area_share(jobs, tiles).select("n_jobs", F.round("percent_in_area", 6).alias("percent_in_area"))


# --- data-quality rules ---------------------------------------------------------
@query("bad_names", "", "SELECT p_partkey AS id, p_name AS name FROM part WHERE regexp_matches(p_name, '\\s')")
def bad_names(t: Tables):
    """PF-15, UD-03"""
    return fl.bad_names(t.raw("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")))


@query("domain_violations", "", """
SELECT event_id AS id, 'event_type' AS "column", event_type AS value FROM events WHERE event_type NOT IN ('view', 'click', 'purchase')""")
def domain_violations(t: Tables):
    """PF-16"""
    e = t.raw("events").select(F.col("event_id").alias("id"), "event_type")
    return fl.domain_violations(e, {"event_type": ["view", "click", "purchase"]})


@query("split_reprocessed", "", """
SELECT event_id AS id, ts < TIMESTAMP '2024-01-15' AS reprocessed FROM events""")
def split_reprocessed(t: Tables):
    """PF-10"""
    new, old = fl.split_reprocessed(t.events(), F.lit("2024-01-15").cast("timestamp"), "ts")
    return new.select(F.col("event_id").alias("id"), F.lit(False).alias("reprocessed")).unionByName(
        old.select(F.col("event_id").alias("id"), F.lit(True).alias("reprocessed"))
    )
