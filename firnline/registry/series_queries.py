"""Time series per tile: predecessors, followers, modes, counters, readiness."""

from pyspark.sql import functions as F

from firnline.operators import series as se
from firnline.plans import planning as pl
from firnline.registry.core import CTE, Tables, query, us

# Optical jobs from events: one job per event; creation follows the measurement
# by up to four days, so late versions exist.
CTE["oj"] = """oj AS (SELECT event_id AS id, user_id AS tile_id, ts AS m, ts + to_hours((event_id * 7) % 97) AS c,
  's' || (event_id // 2) AS source_id, CAST(event_id % 16 + 1 AS INTEGER) AS st, event_id * 3 % 1009 AS chg,
  CASE event_id % 3 WHEN 0 THEN 'generated' WHEN 1 THEN 'pending' ELSE 'generation_aborted' END AS output_status,
  event_id % 5 <> 0 AS ref, event_id % 4 = 0 AS backward FROM events)"""
USABLE = """prev_all AS (SELECT q.id, p.id AS prev_id, p.m AS pm, q.m AS qm,
  row_number() OVER (PARTITION BY q.id ORDER BY p.m DESC, p.c DESC, p.chg DESC, p.id DESC) AS rn
  FROM oj q JOIN oj p ON p.tile_id = q.tile_id AND p.m <= q.m AND p.c < q.c AND p.source_id <> q.source_id AND p.ref
  AND (p.output_status = 'generated' OR (p.output_status = 'pending' AND p.st NOT IN (13, 14, 16))
    OR (q.backward AND p.output_status = 'pending' AND p.st <> 16))),
prev AS (SELECT id, prev_id FROM prev_all WHERE rn = 1 AND pm < qm)"""


def optical_jobs(t: Tables):
    i = F.col("event_id")
    hours = ((i * 7) % 97) * 3_600_000_000
    return t.events().select(
        i.alias("id"),
        F.col("user_id").alias("tile_id"),
        F.col("ts").alias("measurement_date"),
        F.timestamp_micros(F.unix_micros("ts") + hours).alias("creation_date"),
        F.concat(F.lit("s"), F.floor(i / 2).cast("string")).alias("source_id"),
        (i % 16 + 1).cast("int").alias("last_status_id"),
        ((i * 3) % 1009).alias("last_status_change_id"),
        F.when(i % 3 == 0, "generated").when(i % 3 == 1, "pending").otherwise("generation_aborted").alias("output_status"),
        (i % 5 != 0).alias("reference_job"),
        F.when(i % 4 == 0, "backward").alias("reprocessing_context"),
    )


@query("previous_usable", "oj", f"CTE:{USABLE} SELECT id, prev_id FROM prev")
def previous_usable(t: Tables):
    """J-07"""
    return se.previous_usable(optical_jobs(t))


@query("readiness", "oj", f"""CTE:{USABLE}
SELECT oj.id, prev.prev_id, CASE WHEN prev.prev_id IS NULL THEN 'ready' WHEN p.st < 9 OR (oj.backward AND p.st IN (13, 14)) THEN 'configured'
  WHEN p.output_status = 'generated' THEN 'ready' ELSE 'configured' END AS readiness
FROM oj LEFT JOIN prev ON prev.id = oj.id LEFT JOIN oj p ON p.id = prev.prev_id""")
def readiness(t: Tables):
    """W-18"""
    jobs = optical_jobs(t)
    return se.readiness(jobs, se.previous_usable(jobs)).select("id", "prev_id", "readiness")


@query("readiness_on_master", "", """
WITH j AS (SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id - event_id % 3 END AS m, CAST(event_id % 16 + 1 AS INTEGER) AS st,
  CASE event_id % 4 WHEN 0 THEN 'generated' WHEN 1 THEN 'pending' WHEN 2 THEN 'empty' ELSE 'deleted' END AS a FROM events)
SELECT j.id, CASE WHEN j.m = 0 THEN 'ready' WHEN k.id IS NULL THEN 'internal_error' WHEN k.st < 9 THEN 'configured' WHEN k.a = 'generated' THEN 'ready' WHEN k.a IN ('empty', 'deleted') THEN 'cancelled' ELSE 'configured' END AS readiness
FROM j LEFT JOIN j k ON k.id = j.m AND j.m <> 0""")
def readiness_on_master(t: Tables):
    """W-18, wet-snow family"""
    i = F.col("event_id")
    status = F.when(i % 4 == 0, "generated").when(i % 4 == 1, "pending").when(i % 4 == 2, "empty").otherwise("deleted")
    jobs = t.raw("events").select(
        i.alias("id"), F.when(i % 3 == 0, 0).otherwise(i - i % 3).alias("assembly_master_job_id"),
        (i % 16 + 1).cast("int").alias("last_status_id"), status.alias("assembly_status"),
    )
    return pl.readiness_on_master(jobs).select("id", "readiness")


@query("asof_previous", "", """
SELECT event_id AS id, user_id, previous_event_id FROM (SELECT event_id, user_id, event_type,
  last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_event_id FROM events)
WHERE event_type = 'purchase'""")
def asof_previous(t: Tables):
    """J-07 in its plain as-of form: latest earlier view of each purchase"""
    e = t.events().withColumn("id", F.col("event_id"))
    left, right = e.where("event_type = 'purchase'"), e.where("event_type = 'view'")
    out = se.asof_previous(left, right, ["user_id"], "ts", ["event_id"])
    return out.select("id", "user_id", "previous_event_id")


@query("following", "", """
SELECT event_id AS id FROM events WHERE user_id = 4 AND ts >= TIMESTAMP '2024-01-10' AND ts > TIMESTAMP '2024-01-10' AND event_id % 5 <> 0 ORDER BY ts, event_id LIMIT 20""")
def following(t: Tables):
    """J-08, the published single look-up (the limit is its parameter)"""
    jobs = optical_jobs(t).withColumn("creation_date", F.col("measurement_date"))
    when = F.lit("2024-01-10").cast("timestamp")
    return se.following(jobs, 4, when, when, 20).select("id")


NEXT = """SELECT a.id, CAST(rn - 1 AS INTEGER) AS position, n AS next_id FROM (SELECT q.id, p.id AS n, row_number() OVER (PARTITION BY q.id ORDER BY p.m, p.id) AS rn
  FROM oj q JOIN oj p ON p.tile_id = q.tile_id AND p.m >= q.m AND p.c > q.c) a WHERE rn <= 3"""


@query("next_n", "oj", NEXT)
def next_n(t: Tables):
    """J-08 for many jobs at once: first three followers of each"""
    flat = optical_jobs(t).select("tile_id", "id", us("measurement_date", "m"), us("creation_date", "c"))
    out = se.next_n(flat, flat, 3)
    return out.select("id", "position", "next_id")


@query("consecutive", "", """
WITH g AS (SELECT user_id AS tile_id, event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM events)
SELECT tile_id, count(*) AS n_jobs, coalesce(max(gap), 0) AS largest_gap_us, coalesce(bool_and(gap <= 2 * 86400000000), true) AS consecutive FROM g GROUP BY 1""")
def consecutive(t: Tables):
    """W-02"""
    jobs = t.events().select(F.col("event_id").alias("id"), F.col("user_id").alias("tile_id"), F.col("ts").alias("measurement_date"))
    return se.consecutive(jobs, 2)


CHAIN = """WITH j AS (SELECT event_id AS id, user_id AS tile_id, ts, CASE WHEN event_id % 40 = 0 THEN 'init' WHEN event_id % 40 = 20 THEN 'backward' ELSE 'nominal' END AS mode, event_type <> 'error' AS made FROM events),
g AS (SELECT *, sum(CAST(mode <> 'nominal' AS INTEGER)) OVER (PARTITION BY tile_id ORDER BY ts, id) AS island FROM j),
r AS (SELECT *, max(CASE WHEN mode = 'backward' THEN 8 ELSE 0 END) OVER i AS base, sum(CAST(mode = 'nominal' AS INTEGER)) OVER o AS runs, sum(CAST(mode = 'nominal' AND made AS INTEGER)) OVER o AS prods
  FROM g WINDOW i AS (PARTITION BY tile_id, island), o AS (PARTITION BY tile_id, island ORDER BY ts, id))
SELECT id, CAST(runs + base AS BIGINT) AS n_jobs_run_since_last_init, CAST(prods + base AS BIGINT) AS n_l2a_produced_since_last_init,
  CASE WHEN prods + base < 8 THEN '0' ELSE '1' END AS quality_flag FROM r"""


@query("chain_quality", "", CHAIN)
def chain_quality(t: Tables):
    """W-07"""
    i = F.col("event_id")
    jobs = t.events().select(
        i.alias("id"), F.col("user_id").alias("tile_id"), F.col("ts").alias("measurement_date"),
        F.when(i % 40 == 0, "init").when(i % 40 == 20, "backward").otherwise("nominal").alias("run_mode"),
        (F.col("event_type") != "error").alias("produced"),
    )
    return se.chain_quality(jobs).select("id", "n_jobs_run_since_last_init", "n_l2a_produced_since_last_init", "quality_flag")


@query("last_init", "", """
SELECT user_id AS tile_id, arg_max(event_id, struct_pack(ts, event_id)) AS id FROM events WHERE event_id % 7 = 0 AND event_id % 2 = 0 AND event_type <> 'error' GROUP BY 1""")
def last_init(t: Tables):
    """T-07"""
    i = F.col("event_id")
    jobs = t.events().select(
        F.col("user_id").alias("tile_id"), i.alias("id"), F.col("ts").alias("measurement_date"),
        F.when(i % 7 == 0, "init").otherwise("nominal").alias("run_mode"), (i % 2 == 1).alias("backward_reprocessing_run"),
        F.when(F.col("event_type") != "error", "generated").otherwise("pending").alias("output_status"),
    )
    return se.last_init(jobs).select("tile_id", "id")


# Series for mode assignment: every 41st job is open, degraded outputs carry _0.
CTE["mj"] = """mj AS (SELECT id, tile_id, m, c, source_id, st, chg, output_status, ref, false AS backward,
  CASE WHEN id % 41 = 0 THEN NULL ELSE 'nominal' END AS run_mode, 'p_' || (id % 2) AS snow_path, id % 9 = 0 AS rerun, id % 10 = 3 AS deleted, id % 12 AS runs, id % 11 AS made FROM oj)"""
MODES = USABLE.replace("oj ", "mj ") + """,
op AS (SELECT mj.*, prev.prev_id, p.m AS pm, p.deleted AS pdel, p.runs AS pruns, p.made AS pmade FROM mj LEFT JOIN prev ON prev.id = mj.id LEFT JOIN mj p ON p.id = prev.prev_id WHERE mj.run_mode IS NULL),
nm AS (SELECT *, coalesce(epoch_us(m) - epoch_us(pm) <= 172800000000 AND NOT pdel, false) AS nominal FROM op),
dg AS (SELECT * FROM mj WHERE output_status = 'generated' AND NOT rerun AND ref AND snow_path LIKE '%0'),
fo AS (SELECT n.id, d.id AS did, d.m, row_number() OVER (PARTITION BY n.id ORDER BY d.m, d.id) AS rn FROM nm n JOIN dg d ON d.tile_id = n.tile_id AND d.m >= n.m AND d.c > n.c WHERE NOT n.nominal),
li AS (SELECT id, rn, m FROM fo WHERE rn <= 3 UNION ALL SELECT id, 0, m FROM nm WHERE NOT nominal),
gp AS (SELECT id, rn, epoch_us(m) - epoch_us(lag(m) OVER (PARTITION BY id ORDER BY rn)) AS gap FROM li),
bk AS (SELECT id FROM gp GROUP BY 1 HAVING count(*) = 4 AND coalesce(bool_and(abs(gap) <= 172800000000), true)),
rs AS (SELECT nm.*, CASE WHEN nominal THEN 'nominal' WHEN bk.id IS NOT NULL THEN 'backward' WHEN prev_id IS NULL THEN 'wait' ELSE 'init' END AS mode FROM nm LEFT JOIN bk ON bk.id = nm.id)
SELECT id, mode AS run_mode, CASE WHEN mode = 'nominal' THEN prev_id END AS previous_id,
  CASE mode WHEN 'nominal' THEN pruns + 1 WHEN 'backward' THEN 4 WHEN 'init' THEN 0 END AS n_jobs_run_since_last_init,
  CASE mode WHEN 'nominal' THEN pmade WHEN 'backward' THEN 4 WHEN 'init' THEN 0 END AS n_l2a_produced_since_last_init FROM rs"""


def mode_jobs(t: Tables):
    i = F.col("id")
    return (
        optical_jobs(t)
        .withColumn("reprocessing_context", F.lit(None).cast("string"))
        .withColumn("run_mode", F.when(i % 41 != 0, "nominal"))
        .withColumn("snow_path", F.concat(F.lit("p_"), (i % 2).cast("string")))
        .withColumn("backward_reprocessing_run", i % 9 == 0)
        .withColumn("output_deleted", i % 10 == 3)
        .withColumn("n_jobs_run_since_last_init", i % 12)
        .withColumn("n_l2a_produced_since_last_init", i % 11)
    )


@query("assign_mode", "oj mj", "CTE:" + MODES)
def assign_mode(t: Tables):
    """W-12: three followers and two days instead of seven and sixty, to meet
    every branch on this data"""
    jobs = mode_jobs(t)
    previous = se.previous_usable(jobs, asking=F.col("run_mode").isNull())
    out = se.assign_mode(jobs, previous, required=4, days=2)
    return out.select("id", "run_mode", "previous_id", "n_jobs_run_since_last_init", "n_l2a_produced_since_last_init")


_OPTICAL = MODES[MODES.index("op AS"):].replace("mj", "mk").replace("rn <= 3", "rn <= 7").replace("count(*) = 4", "count(*) = 8").replace(
    "THEN 4", "THEN 8").replace("<= 172800000000", "<= 60 * 86400000000").rsplit("SELECT id, mode", 1)[0]


@query("configure_optical", "oj mj", "CTE:" + USABLE.replace("oj ", "mj ") + """,
rd AS (SELECT q.id, CASE WHEN prev.prev_id IS NULL THEN 'ready' WHEN p.st < 9 THEN 'configured' WHEN p.output_status = 'generated' THEN 'ready' ELSE 'configured' END AS readiness
  FROM mj q LEFT JOIN prev ON prev.id = q.id LEFT JOIN mj p ON p.id = prev.prev_id WHERE q.run_mode IS NULL),
mk AS (SELECT * FROM mj WHERE id NOT IN (SELECT id FROM rd WHERE readiness <> 'ready')),
""" + _OPTICAL + """SELECT rd.id, readiness, mode AS run_mode, CASE WHEN mode = 'nominal' THEN prev_id END AS previous_id,
  CASE mode WHEN 'nominal' THEN pruns + 1 WHEN 'backward' THEN 8 WHEN 'init' THEN 0 END AS n_jobs_run_since_last_init FROM rd LEFT JOIN rs ON rs.id = rd.id""")
def configure_optical(t: Tables):
    """JOB-9: readiness of the open jobs, and mode and counter of the ready ones"""
    plan = pl.configure_optical(mode_jobs(t))
    modes = plan["modes"].select("id", "run_mode", "previous_id", "n_jobs_run_since_last_init")
    return plan["state"].select("id", "readiness").join(modes, "id", "left")


MEMBERS = """CTE:j AS (SELECT *, id % 6 = 0 AS init, id % 9 = 0 AS rerun FROM oj),
tg AS (SELECT tile_id, max(m) AS t FROM j WHERE m < TIMESTAMP '2024-01-15' GROUP BY 1),
ini AS (SELECT * FROM (SELECT j.*, row_number() OVER (PARTITION BY j.tile_id ORDER BY m DESC, id DESC) AS rn FROM j JOIN tg ON tg.tile_id = j.tile_id AND m < t WHERE init AND NOT rerun AND output_status = 'generated') WHERE rn = 1),
fo AS (SELECT n.id AS init_id, d.id, d.m, row_number() OVER (PARTITION BY n.id ORDER BY d.m, d.id) AS pos FROM ini n JOIN j d ON d.tile_id = n.tile_id AND d.m >= n.m AND d.c > n.c
  WHERE d.output_status = 'generated' AND NOT d.rerun AND d.ref AND d.id % 2 = 0),
al AS (SELECT id AS init_id, id, m, 0 AS pos FROM ini UNION ALL SELECT init_id, id, m, pos FROM fo WHERE pos <= 2),
ok AS (SELECT init_id FROM al GROUP BY 1 HAVING count(*) = 3)
"""


@query("backward_plan", "oj", MEMBERS + """SELECT al.init_id, oj.tile_id, oj.source_id, CAST(pos AS INTEGER) AS position,
  CASE WHEN pos = 0 THEN 'backward' END AS run_mode, CASE WHEN pos = 0 THEN 3::BIGINT END AS n_jobs_run_since_last_init
FROM al JOIN ok USING (init_id) JOIN oj ON oj.id = al.id""")
def backward_plan(t: Tables):
    """W-13: re-issued jobs for the last init job of each tile"""
    i = F.col("id")
    jobs = mode_jobs(t).withColumn("run_mode", F.when(i % 6 == 0, "init").otherwise("nominal"))
    early = jobs.where(F.col("measurement_date") < F.lit("2024-01-15").cast("timestamp"))
    triggered = early.groupBy("tile_id").agg(F.max("measurement_date").alias("trigger_measurement"))
    issued, _ = se.backward_plan(jobs, triggered, required=3, days=30)
    return issued.select("init_id", "tile_id", "source_id", "position", "run_mode", "n_jobs_run_since_last_init")


@query("backward_plan_members", "oj", MEMBERS + "SELECT al.init_id, al.id, CAST(pos AS INTEGER) AS position FROM al JOIN ok USING (init_id)")
def backward_plan_members(t: Tables):
    """W-13: members of each backward list (all gaps are within thirty days here)"""
    i = F.col("id")
    jobs = mode_jobs(t).withColumn("run_mode", F.when(i % 6 == 0, "init").otherwise("nominal"))
    early = jobs.where(F.col("measurement_date") < F.lit("2024-01-15").cast("timestamp"))
    trig = early.groupBy("tile_id").agg(F.max("measurement_date").alias("_t"))
    init = se.last_init(jobs.join(trig, "tile_id").where(F.col("measurement_date") < F.col("_t")).select(*jobs.columns))
    lists = se.backward_lists(jobs, init, 3, 30)
    return lists.select(F.col("id").alias("init_id"), F.posexplode("member_ids").alias("position", "id"))
