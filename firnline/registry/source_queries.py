"""Sources, sinks and scalar functions."""

import datetime as dt

from pyspark.sql import functions as F

from firnline.functions import ids as fid
from firnline.functions import rules as ru
from firnline.functions import times as tm
from firnline.operators import reaches as rc
from firnline.plans import ice
from firnline.plans import planning as pl
from firnline.registry.core import Tables, day_text, query, us
from firnline.session import shared_folder
from firnline.sinks import tables as st
from firnline.sources import catalogue as cat
from firnline.sources import lineage as ln
from firnline.sources import store


def _paths(t: Tables):
    i = F.col("event_id")
    start = F.date_format("ts", "yyyyMMdd'T'HHmmss")
    tile = F.concat(F.lpad((F.col("user_id") % 60 + 1).cast("string"), 2, "0"), F.lit("ABC"))
    optical = F.concat(F.lit("S2A_MSIL1C_"), start, F.lit("_N0204_R031_T"), tile, F.lit("_"), start, F.lit(".SAFE"))
    radar = F.concat(
        F.lit("S1B_IW_GRDH_1SDV_"), start, F.lit("_"), start, F.lit("_"), F.lpad(i.cast("string"), 6, "0"), F.lit("_0ABCDE_12FF.SAFE")
    )
    product = F.concat(F.lit("FSC_"), start, F.lit("_S2A_T"), tile, F.lit("_V100_"), (i % 2).cast("string"))
    kind = F.col("event_type")
    name = F.when(kind == "view", optical).when(kind == "click", radar).when(kind == "purchase", product).otherwise(
        F.concat(F.lit("junk_"), start)
    )
    return t.raw("events").select("event_id", F.concat(F.lit("store/in/"), name).alias("path"))


TILE = "lpad(CAST(user_id % 60 + 1 AS VARCHAR), 2, '0') || 'ABC'"


@query("catalogue_from_paths", "", f"""
SELECT event_id, CASE event_type WHEN 'view' THEN 'optical_scene' WHEN 'click' THEN 'radar_scene' ELSE 'product' END AS kind,
  CASE event_type WHEN 'view' THEN 'MSIL1C' WHEN 'click' THEN 'IW_GRDH' ELSE 'FSC' END AS product_type,
  CASE event_type WHEN 'click' THEN 'S1B' ELSE 'S2A' END AS mission, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS start_s,
  CASE WHEN event_type <> 'click' THEN {TILE} END AS tile_id,
  CASE event_type WHEN 'view' THEN '031' WHEN 'click' THEN lpad(CAST(event_id AS VARCHAR), 6, '0') END AS orbit,
  CASE event_type WHEN 'click' THEN 'IW' WHEN 'purchase' THEN CAST(event_id % 2 AS VARCHAR) END AS mode,
  CASE event_type WHEN 'click' THEN '0ABCDE' END AS take_id
FROM events WHERE event_type IN ('view', 'click', 'purchase')""")
def catalogue_from_paths(t: Tables):
    """SRC-01"""
    ok, _ = cat.catalogue_from_paths(_paths(t))
    return ok.select(
        "event_id", "kind", "product_type", "mission", F.unix_seconds("sensing_start").alias("start_s"), "tile_id", "orbit", "mode", "take_id"
    )


@query("catalogue_rejects", "", "SELECT event_id FROM events WHERE event_type IN ('signup', 'error')")
def catalogue_rejects(t: Tables):
    """SRC-01: reject table"""
    return cat.catalogue_from_paths(_paths(t))[1].select("event_id")


@query("feature_pages", "", f"""
SELECT CAST(event_id AS VARCHAR) AS product_id, {TILE} AS tile_id, CAST(event_id % 100 AS DOUBLE) AS cloud_cover, epoch_us(date_trunc('millisecond', ts)) AS measured_us
FROM events WHERE user_id % 60 < 5""")
def feature_pages(t: Tables):
    """SRC-02: one feature per page written as JSON, read back with a tile filter"""
    tile = F.concat(F.lpad((F.col("user_id") % 60 + 1).cast("string"), 2, "0"), F.lit("ABC"))
    ident = F.concat(F.lit("x/_T"), tile, F.lit("_/"), F.col("event_id").cast("string"))
    props = F.struct(
        ident.alias("productIdentifier"), F.lit("L1C").alias("productType"), (F.col("event_id") % 100).cast("double").alias("cloudCover"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("startDate"),
    )
    root = shared_folder(t.spark, "pages")
    t.events().select(F.array(F.struct(props.alias("properties"))).alias("features")).write.json(root)
    from firnline.schemas import FEATURE_PAGE

    pages = t.spark.read.schema(FEATURE_PAGE).json(root)
    tiles = [f"{i + 1:02d}ABC" for i in range(5)]
    out = cat.features_to_products(pages, ["product_id", "tile_id", "cloud_cover", "measurement_date"], tiles)
    return out.select("product_id", "tile_id", "cloud_cover", us("measurement_date", "measured_us"))


@query("scan_products", "products", "SELECT product_id, tile_id FROM products WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND tile_id % 2 = 0")
def scan_products(t: Tables):
    """SRC-03: day-partitioned store, dates prune the scan"""

    root = shared_folder(t.spark, "store")
    st.write_products(t.products().select("product_id", "tile_id", "measurement_date"), root)
    return store.scan_products(t.spark, root, dt.date(2024, 1, 10), dt.date(2024, 1, 12)).where("tile_id % 2 = 0").select("product_id", "tile_id")


@query("read_jobs", "log", "SELECT job_status, count(*) AS n FROM log GROUP BY 1")
def read_jobs(t: Tables):
    """SRC-05: status log stored and scanned with its schema"""
    root = shared_folder(t.spark, "jobs")
    t.log().withColumn("job_status", F.col("job_status").cast("short")).withColumn("error_message", F.lit("")).write.parquet(f"{root}/job_status_changes")
    log = store.read_jobs(t.spark, root, "job_status_changes")
    return log.groupBy(F.col("job_status").cast("int").alias("job_status")).agg(F.count("*").alias("n"))


@query("tile_dims", "", """
SELECT lpad(CAST(c_custkey % 60 + 1 AS VARCHAR), 2, '0') || 'ABC' AS tile_id, CAST(n AS INTEGER) AS track, count(*) AS n_lines
FROM customer, (SELECT unnest([0, 1]) AS d), LATERAL (SELECT c_nationkey + d AS n) GROUP BY 1, 2""")
def tile_dims(t: Tables):
    """SRC-06: tile-to-tracks lines parsed and exploded"""
    tile = F.concat(F.lpad((F.col("c_custkey") % 60 + 1).cast("string"), 2, "0"), F.lit("ABC"))
    n = F.col("c_nationkey")
    line = F.concat(tile, F.lit(": ["), n.cast("string"), F.lit(", "), (n + 1).cast("string"), F.lit("]"))
    tracks = store.parse_tile_tracks(t.raw("customer").select(line.alias("value")))
    return store.tile_tracks_long(tracks).groupBy("tile_id", "track").agg(F.count("*").alias("n_lines"))


NAME = "lpad(CAST(s_suppkey % 60 + 1 AS VARCHAR), 2, '0') || chr(CAST(65 + s_suppkey // 60 % 26 AS INTEGER)) || 'BC'"


def _names():
    n = F.col("s_suppkey")
    return F.concat(F.lpad((n % 60 + 1).cast("string"), 2, "0"), F.chr(65 + F.floor(n / 60) % 26), F.lit("BC"))


@query("tile_grid", "", f"""
SELECT {NAME} AS tile_id, CAST(32601 + s_suppkey % 60 AS INTEGER) AS epsg, s_suppkey * 100.0::DOUBLE AS ulx, s_suppkey * -10.5::DOUBLE AS uly,
  s_suppkey * 100.0::DOUBLE + 60 AS lrx, s_suppkey * -10.5::DOUBLE - 60 AS lry FROM supplier""")
def tile_grid(t: Tables):
    """SRC-06: grid lines parsed, kept as JSON lines, read back with their schema"""
    n = F.col("s_suppkey")
    x, y = n * 100.0, n * -10.5
    corners = F.format_string(": {epsg: %d, ulx: %.1f, uly: %.1f, lrx: %.1f, lry: %.1f}", n % 60 + 32601, x, y, x + 60, y - 60)
    lines = t.raw("supplier").select(F.concat(_names(), corners).alias("value"))
    root = shared_folder(t.spark, "grid")
    store.parse_tile_grid(lines).write.json(root)
    return store.read_tile_grid(t.spark, root)


@query("tile_list", "", f"SELECT DISTINCT {NAME} AS tile_id FROM supplier")
def tile_list(t: Tables):
    """SRC-06: tile names from a text file, with and without the leading letter"""
    root = shared_folder(t.spark, "tiles")
    lead = F.when(F.col("s_suppkey") % 2 == 0, "T").otherwise("")
    t.raw("supplier").select(F.explode(F.array(F.concat(lead, _names()), F.lit(""))).alias("value")).write.text(root)
    return store.parse_tile_list(t.spark.read.text(root))


@query("own_period", "", "SELECT event_id AS product_id, event_id AS input_id, epoch_us(date_trunc('second', ts)) AS begin_us, epoch_us(date_trunc('second', ts)) + 60000000 AS end_us FROM events")
def own_period(t: Tables):
    """SRC-07: each product's own time span"""
    def at(time):
        return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")

    xml = F.concat(
        F.lit("<gmd:MD_Metadata><gmd:identificationInfo><gmd:MD_DataIdentification><gmd:extent><gmd:EX_Extent><gmd:temporalElement>"
              "<gmd:EX_TemporalExtent><gmd:extent><gml:TimePeriod><gml:beginPosition>"), at("ts"),
        F.lit("</gml:beginPosition><gml:endPosition>"), at(F.timestamp_micros(F.unix_micros("ts") + 60_000_000)),
        F.lit("</gml:endPosition></gml:TimePeriod></gmd:extent></gmd:EX_TemporalExtent></gmd:temporalElement></gmd:EX_Extent></gmd:extent>"
              "</gmd:MD_DataIdentification></gmd:identificationInfo></gmd:MD_Metadata>"),
    )
    docs = t.events().select(F.col("event_id").alias("product_id"), xml.alias("xml"))
    return ln.own_period(docs).select("product_id", "input_id", us("begin", "begin_us"), us("end", "end_us"))


@query("lineage_edges", "", """
SELECT event_id AS product_id, CASE k WHEN 0 THEN 'a' ELSE 'b' END || event_id AS input_id, CASE k WHEN 0 THEN epoch_us(date_trunc('second', ts)) ELSE epoch_us(date_trunc('millisecond', ts)) END AS begin_us
FROM events, (SELECT unnest([0, 1]) AS k) WHERE k <= event_id % 2""")
def lineage_edges(t: Tables):
    """SRC-07: one or two inputs per document, whole and fractional seconds"""
    def item(name, begin):
        return F.concat(
            F.lit("<gmd:seriesMetadata><gmd:MD_Metadata><gmd:fileIdentifier><gco:CharacterString>"), name,
            F.lit("</gco:CharacterString></gmd:fileIdentifier><gmd:identificationInfo><gmd:MD_DataIdentification><gmd:extent><gmd:EX_Extent>"
                  "<gmd:temporalElement><gmd:EX_TemporalExtent><gmd:extent><gml:TimePeriod><gml:beginPosition>"), begin,
            F.lit("</gml:beginPosition><gml:endPosition>"), begin,
            F.lit("</gml:endPosition></gml:TimePeriod></gmd:extent></gmd:EX_TemporalExtent></gmd:temporalElement></gmd:EX_Extent></gmd:extent>"
                  "</gmd:MD_DataIdentification></gmd:identificationInfo></gmd:MD_Metadata></gmd:seriesMetadata>"),
        )

    i = F.col("event_id").cast("string")
    one = item(F.concat(F.lit("a"), i), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    two = item(F.concat(F.lit("b"), i), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    body = F.when(F.col("event_id") % 2 == 1, F.concat(one, two)).otherwise(one)
    xml = F.concat(
        F.lit("<gmd:MD_Metadata><gmd:series><gmd:DS_OtherAggregate>"), body, F.lit("</gmd:DS_OtherAggregate></gmd:series></gmd:MD_Metadata>")
    )
    docs = t.raw("events").select(F.col("event_id").alias("product_id"), xml.alias("xml"))
    return ln.lineage_from_metadata(docs).select("product_id", "input_id", us("begin", "begin_us"))


@query("class_codes", "px", """
SELECT CASE value WHEN 205 THEN 'cloud' ELSE 'nodata' END AS meaning, count(*) AS n FROM px WHERE value IN (205, 255) GROUP BY 1""")
def class_codes(t: Tables):
    """SRC-08: pixels named by their class"""
    dim = store.class_codes(t.spark).where("layer = 'snow_fraction'").select(F.col("code").alias("value"), "meaning")
    return t.pixels().join(dim, "value").groupBy("meaning").agg(F.count("*").alias("n"))


@query("value_ranges", "px", """
SELECT 'snow_fraction' AS layer, count(*) AS n, count(*) FILTER (WHERE value BETWEEN 0 AND 100) AS n_inside FROM px
UNION ALL SELECT 'quality', count(*), count(*) FILTER (WHERE qc BETWEEN 0 AND 3) FROM px""")
def value_ranges(t: Tables):
    """SRC-08: pixels inside the measured range of their layer"""
    layers = F.array(
        F.struct(F.lit("snow_fraction").alias("layer"), F.col("value").alias("v")), F.struct(F.lit("quality").alias("layer"), F.col("qc").alias("v"))
    )
    px = t.pixels().select(F.inline(layers))
    inside = F.count_if(F.col("v").between(F.col("low"), F.col("high")))
    return px.join(store.value_ranges(t.spark), "layer").groupBy("layer").agg(F.count("*").alias("n"), inside.alias("n_inside"))


# --- sinks ---------------------------------------------------------------------------
@query("publication_feed", "", """
SELECT event_id AS product_id, (event_id % 900 + 1) * 1024 AS size, 'p/' || event_id || '/thumbnail.png' AS thumbnail, 'POLYGON ((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 0.0))' AS wkt
FROM events WHERE event_type <> 'error' AND event_id % 5 <> 0""")
def publication_feed(t: Tables):
    """SNK-02"""
    ok, _ = st.publication_feed(_finished(t))
    doc = F.col("document")
    return ok.select(
        "product_id", F.get_json_object(doc, "$.resto.properties.resourceSize").cast("long").alias("size"),
        F.get_json_object(doc, "$.resto.properties.thumbnail").alias("thumbnail"), F.get_json_object(doc, "$.resto.geometry.wkt").alias("wkt"),
    )


@query("publication_rejects", "", """
SELECT event_id AS product_id, CASE WHEN event_type = 'error' THEN 'no worker information' ELSE 'incomplete worker information' END AS reject_reason
FROM events WHERE event_type = 'error' OR event_id % 5 = 0""")
def publication_rejects(t: Tables):
    """SNK-02: rows left out, with the reason"""
    return st.publication_feed(_finished(t))[1]


def _finished(t: Tables):
    i = F.col("event_id")
    pts = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]
    ring = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in pts])
    size = F.when(i % 5 != 0, i % 900 + 1)
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    info = st.worker_info(ring, size, F.lit(60), F.lit(1.0), when, when)
    return t.events().select(
        i.alias("product_id"), F.lit("GFSC").alias("product_type"), F.lit("S1-S2").alias("mission"), F.lit("V100").alias("version"),
        F.concat(F.lit("p/"), i.cast("string")).alias("path"), F.when(F.col("event_type") != "error", info).alias("info"),
    )


@query("upsert", "", """
WITH c AS (SELECT user_id AS id, max(event_id) AS seen FROM events GROUP BY 1 UNION ALL SELECT o_orderkey + 1000000000, 0 FROM orders)
SELECT coalesce(c.id, c_custkey) AS id, c_name AS name, coalesce(seen, -1) AS seen FROM customer FULL JOIN c ON c.id = c_custkey WHERE c.id IS NOT NULL OR c_custkey IS NOT NULL""")
def upsert(t: Tables):
    """SNK-04"""
    target = t.raw("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(-1).cast("long").alias("seen"))
    patch = t.raw("events").groupBy(F.col("user_id").alias("id")).agg(F.max("event_id").alias("seen"))
    new = t.raw("orders").select((F.col("o_orderkey") + 1000000000).alias("id"), F.lit(0).cast("long").alias("seen"))
    return st.upsert(target, patch.unionByName(new), ["id"])


@query("delete_cascade", "", """
SELECT 'parent_jobs' AS tbl, count(*) AS n FROM customer WHERE c_nationkey <> 3
UNION ALL SELECT 'jobs', count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)
UNION ALL SELECT 'execution_info', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)
UNION ALL SELECT 'links', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3))""")
def delete_cascade(t: Tables):
    """SNK-05"""
    tables = {
        "parent_jobs": t.parents(), "jobs": t.jobs(),
        "execution_info": t.raw("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("fk_parent_job_id")),
        "links": t.raw("lineitem").select(F.col("l_orderkey").alias("fk_execution_info_id"), "l_partkey"),
    }
    gone = t.parents().where("tile_id = 3").select("id")
    left = st.delete_cascade(tables, gone)
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("tbl"), "n") for k, df in left.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("param_history", "", """
SELECT user_id AS parameter, epoch_us(ts) AS from_us, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS to_us FROM events WHERE event_type = 'signup'""")
def param_history(t: Tables):
    """SNK-06"""
    changes = t.events().where("event_type = 'signup'").select(F.col("user_id").alias("parameter"), F.col("ts").alias("time"))
    return st.param_history(changes, ["parameter"]).select("parameter", us("valid_from", "from_us"), us("valid_to", "to_us"))


@query("params_at", "", """
SELECT user_id AS parameter, max(event_id) AS version FROM events WHERE event_type = 'signup' AND ts <= TIMESTAMP '2024-01-15' GROUP BY 1""")
def params_at(t: Tables):
    """SNK-06: as-of look-up"""
    changes = t.events().where("event_type = 'signup'").select(F.col("user_id").alias("parameter"), F.col("ts").alias("time"), F.col("event_id").alias("version"))
    history = st.param_history(changes, ["parameter"])
    return st.params_at(history, F.lit("2024-01-15").cast("timestamp")).select("parameter", "version")


@query("retag_version", "", """
SELECT event_id, 'FSC_' || event_id || CASE WHEN event_id % 2 = 0 THEN '_V101_' ELSE '_V102_' END || '1' AS product_id FROM events""")
def retag_version(t: Tables):
    """SNK-08"""
    tag = F.when(F.col("event_id") % 2 == 0, "_V100_").otherwise("_V102_")
    rows = t.raw("events").select("event_id", F.concat(F.lit("FSC_"), F.col("event_id").cast("string"), tag, F.lit("1")).alias("product_id"))
    return st.retag_version(rows, "V100", "V101", ["product_id"])


@query("fix_span_ids", "", """
SELECT event_id, 'PSA_20170501-' || CASE WHEN event_id % 2 = 0 THEN lpad(CAST(CAST(ceil((1000 + event_id % 5000) / 24.0) AS INTEGER) AS VARCHAR), 3, '0') ELSE '153' END || '_S2_T32TLR_V100' AS product_id FROM events""")
def fix_span_ids(t: Tables):
    """SNK-09"""
    span = F.when(F.col("event_id") % 2 == 0, (F.col("event_id") % 5000 + 1000).cast("string")).otherwise("153")
    rows = t.raw("events").select("event_id", F.concat(F.lit("PSA_20170501-"), span, F.lit("_S2_T32TLR_V100")).alias("product_id"))
    return st.fix_span_ids(rows)


# --- scalar functions ----------------------------------------------------------------
@query("parse_times", "", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_us(date_trunc('second', ts)) WHEN 1 THEN epoch_us(date_trunc('millisecond', ts)) WHEN 2 THEN epoch_us(ts) ELSE epoch_us(date_trunc('day', ts)) END AS t_us FROM events""")
def parse_times(t: Tables):
    """F-03"""
    i = F.col("event_id") % 4
    text = (
        F.when(i == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(i == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(i == 2, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))).otherwise(F.date_format("ts", "yyyyMMdd"))
    )
    return t.events().select("event_id", us(tm.parse_time(text), "t_us"))


@query("month_shift", "", """
SELECT event_id, epoch_us(date_trunc('month', ts) + to_months(CAST(event_id % 5 AS INTEGER)) + (ts - date_trunc('month', ts))) AS t_us FROM events""")
def month_shift(t: Tables):
    """F-04"""
    return t.events().select("event_id", us(tm.add_months_keep_offset(F.col("ts"), (F.col("event_id") % 5).cast("int")), "t_us"))


@query("day_windows", "", """
SELECT event_id, epoch_us(date_trunc('day', ts)) AS start_us, epoch_us(date_trunc('day', ts)) + 86399999999 AS end_us, '2024-05-01' AS season_start, '2024-10-01' AS season_end,
  strftime(date_trunc('month', ts) + INTERVAL 1 MONTH, '%Y-%m-%d') AS month_end FROM events""")
def day_windows(t: Tables):
    """F-05"""
    w, s = tm.day_window(F.col("ts")), tm.snow_season(F.year("ts"))
    m = tm.month_bounds(F.year("ts"), F.month("ts"))
    return t.events().select(
        "event_id", us(w["start"], "start_us"), us(w["end"], "end_us"), day_text(s["start"], "season_start"), day_text(s["end"], "season_end"), day_text(m["end"], "month_end")
    )


@query("sensor_codes", "", """
SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 0 ELSE 999 END AS sensor, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day, CAST(strftime(ts, '%H%M%S') AS INTEGER) AS time FROM events""")
def sensor_codes(t: Tables):
    """F-06, F-07"""
    k = F.col("event_type")
    name = F.when(k == "view", "Sentinel-1").when(k == "click", "Sentinel-2").when(k == "purchase", "Sentinel-1 Sentinel-2").otherwise(k)
    return t.events().select("event_id", ru.sensor_code(name).alias("sensor"), tm.packed_day(F.col("ts")).alias("day"), tm.packed_time(F.col("ts")).alias("time"))


@query("json_columns", "", """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(len(string_split(event_type || ';' || user_id, ';')) AS INTEGER) AS n FROM events""")
def json_columns(t: Tables):
    """F-12"""
    listed = fid.split_list(F.concat_ws(";", "event_type", "user_id"))
    return t.raw("events").select("event_id", fid.json_map(F.col("props"))["k"].alias("k"), F.size(listed).alias("n"))


@query("priorities", "", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'reprocessing' WHEN event_id % 30 < 24 AND event_id % 5 < 3 AND event_id % 7 <> 0 THEN 'nrt' ELSE 'delayed' END AS priority FROM events""")
def priorities(t: Tables):
    """F-15"""
    i = F.col("event_id")
    def plus(base, hours):
        return F.timestamp_micros(F.unix_micros(base) + hours * 3_600_000_000)

    e = t.events().select("event_id", F.col("ts").alias("m"), plus(F.col("ts"), i % 30).alias("s"))
    e = e.withColumn("h", F.when(i % 7 != 0, plus(F.col("s"), i % 5)))
    return e.select("event_id", ru.priority(i % 3 != 0, F.col("m"), F.col("s"), F.col("h")).alias("priority"))


@query("simple_statuses", "log", """
SELECT id, CASE WHEN job_status IN (11, 12) THEN 'successful' WHEN job_status < 11 THEN 'in_progress' WHEN job_status = 14 THEN 'system_error' WHEN job_status IN (15, 16) THEN 'definitive_error' ELSE 'error' END AS simple FROM log""")
def simple_statuses(t: Tables):
    """F-15"""
    return t.log().select("id", ru.simple_status(F.col("job_status")).alias("simple"))


@query("tile_names", "", """
SELECT event_id, event_type IN ('view', 'click') AS is_tile, event_type = 'purchase' AS is_laea FROM events""")
def tile_names(t: Tables):
    """F-16"""
    k = F.col("event_type")
    name = F.when(k == "view", "T32TLR").when(k == "click", "32TLR").when(k == "purchase", "E08N17").otherwise("X32TLR")
    return t.raw("events").select("event_id", fid.is_tile_name(name).alias("is_tile"), fid.is_laea_tile_name(name).alias("is_laea"))


@query("condition_lists", "", """
SELECT event_id, user_id > 5 AND value > 10 AND event_type <> 'error' AS every, user_id > 5 OR value > 10 OR event_type <> 'error' AS some FROM events""")
def condition_lists(t: Tables):
    """F-17"""
    c = [F.col("user_id") > 5, F.col("value") > 10, F.col("event_type") != "error"]
    return t.raw("events").select("event_id", tm.all_of(c).alias("every"), tm.any_of(c).alias("some"))


# --- river ice query, planning -----------------------------------------------------------
def _river(t: Tables):
    i = F.col("event_id")
    values = t.events().select(
        F.col("user_id").alias("river_km_id"), F.col("ts").alias("datetime"), (i % 101).cast("int").alias("water_perc"), (i % 7).cast("int").alias("ice_perc"),
        F.lit(0).alias("other_perc"), (i % 97).cast("int").alias("cloud_perc"), F.lit(0).alias("nd_perc"), (i % 4).cast("int").alias("qc"),
        F.when(i % 2 == 0, "Sentinel-1").otherwise("Sentinel-2").alias("type"),
    )
    reaches = t.raw("customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("eu_hydro_id"))
    return reaches, values


RIVER = """events JOIN customer ON c_custkey = user_id WHERE c_mktsegment = 'BUILDING' AND ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20' AND event_id % 97 <= 40"""


@query("river_ice", "", f"""
SELECT user_id AS river_km_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day, CAST(strftime(ts, '%H%M%S') AS INTEGER) AS time, CAST(event_id % 101 AS INTEGER) AS water_perc,
  CAST(event_id % 7 AS INTEGER) AS ice_perc, 0 AS other_perc, CAST(event_id % 97 AS INTEGER) AS cloud_perc, 0 AS nd_perc, CAST(event_id % 4 AS INTEGER) AS qc, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS sensor
FROM {RIVER}""")
def river_ice(t: Tables):
    """JOB-6, J-15, PF-14: the whole river, in answers within the size limit"""
    start, end = (F.lit(d).cast("timestamp") for d in ("2024-01-05", "2024-01-20"))
    return ice.river_ice(*_river(t), start, end, hydro_id="BUILDING", cloud_max=40, split=True).drop("answer")


@query("river_ice_size", "", f"SELECT count(*) AS n_rows FROM {RIVER}")
def river_ice_size(t: Tables):
    """A-02"""
    start, end = (F.lit(d).cast("timestamp") for d in ("2024-01-05", "2024-01-20"))
    return ice.river_ice(*_river(t), start, end, hydro_id="BUILDING", cloud_max=40, only_size=True)


@query("reaches_by_id", "", "SELECT c_custkey AS id, c_mktsegment AS eu_hydro_id FROM customer WHERE c_custkey IN (1, 5, 9)")
def reaches_by_id(t: Tables):
    """J-14"""
    return rc.reaches_by_id(_river(t)[0], "1,5,9")


@query("id_list", "", "SELECT string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS ids FROM customer WHERE c_nationkey = 3")
def id_list(t: Tables):
    """A-33: size-checked list"""
    ids = rc.id_list(t.raw("customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("id")))
    return ids.select(F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query("missed_inputs", "products", """
SELECT product_id FROM products p WHERE product_type = 'view' AND day IN (SELECT day FROM products WHERE product_type = 'view' AND product_id % 4 = 0) AND product_id % 4 <> 0""")
def missed_inputs(t: Tables):
    """ST-11, batch twin: inputs missed on computed days"""
    jobs = t.products().where("product_type = 'view'").select("day", "product_id")
    return ice.missed_inputs(jobs, jobs.where("product_id % 4 = 0")).select("product_id")


def _ice_products(t: Tables, kind: str):
    i = F.col("product_id")
    return t.products().where(F.col("product_type") == kind).select(
        i.alias("job_id"), "tile_id", "day", F.col("measurement_date").alias("sensing_time"),
        F.when(i % 10 != 0, F.concat(F.lit("p"), i.cast("string"))).alias("path"), F.col("measurement_date").alias("published"),
        (i % 16 + 1).cast("int").alias("status"), F.concat(F.lit("S1"), F.char((F.lit(65) + i % 2).cast("int"))).alias("satellite"),
    )


@query("pair_radar_optical", "products", """CTE:r AS (SELECT *, 'S1' || chr(CAST(65 + product_id % 2 AS INTEGER)) AS sat FROM products WHERE product_type = 'view' AND product_id % 16 + 1 NOT IN (13, 16)),
o AS (SELECT * FROM products WHERE product_type = 'click' AND product_id % 16 + 1 NOT IN (13, 16)),
ds AS (SELECT day FROM (SELECT day, max(day) OVER () AS st FROM (SELECT day FROM r INTERSECT SELECT day FROM o) WHERE day <= DATE '2024-01-30' AND day >= DATE '2024-01-02') WHERE st - day <= 20),
ra AS (SELECT tile_id, day, sat, avg(CAST(epoch_us(ts) % 86400000000 AS DOUBLE)) AS m, count(*) AS n_radar FROM r WHERE product_id % 10 <> 0 AND day IN (SELECT day FROM ds) AND tile_id % 3 <> 0 GROUP BY 1, 2, 3),
oa AS (SELECT tile_id, day, avg(CAST(epoch_us(ts) % 86400000000 AS DOUBLE)) AS m, count(*) AS n_optical FROM o WHERE product_id % 10 <> 0 AND day IN (SELECT day FROM ds) GROUP BY 1, 2)
SELECT tile_id, strftime(day, '%Y-%m-%d') AS day, sat AS satellite, n_radar, n_optical FROM (SELECT ra.*, n_optical, row_number() OVER (PARTITION BY ra.tile_id, ra.day ORDER BY abs(ra.m - oa.m), sat) AS rn
  FROM ra JOIN oa ON ra.tile_id = oa.tile_id AND ra.day = oa.day) WHERE rn = 1""")
def pair_radar_optical(t: Tables):
    """JOB-5"""
    tiles = t.products().where("tile_id % 3 <> 0").select("tile_id").distinct()
    done = t.products().where("false").select("tile_id", "day")
    out = ice.pair_radar_optical(
        _ice_products(t, "view"), _ice_products(t, "click"), done, tiles, F.lit("2024-01-31 06:00:00").cast("timestamp"),
        F.lit("2024-01-02").cast("timestamp"), max_search_days=20, max_wait_hours=1,
    )["pairs"]
    return out.select("tile_id", day_text("day"), "satellite", "n_radar", "n_optical")


BEST = """
WITH p AS (SELECT event_id, event_type, lpad(CAST(user_id % 60 + 1 AS VARCHAR), 2, '0') || 'ABC' AS tile_id, CAST(ts AS DATE) AS day, 100 + event_id % 3 AS v, event_id % 2 AS mode, date_trunc('second', ts) AS s,
  'RLIE_' || strftime(ts, '%Y%m%dT%H%M%S') || CASE event_type WHEN 'view' THEN '_S1A_T' ELSE '_S2A_T' END || lpad(CAST(user_id % 60 + 1 AS VARCHAR), 2, '0') || 'ABC_V' || (100 + event_id % 3) || '_' || (event_id % 2) AS pid FROM events),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type, tile_id, day ORDER BY v DESC, mode DESC, s DESC, pid DESC) AS rn FROM p WHERE event_type IN ('view', 'click')) WHERE rn = 1)
"""
BOTH = "FROM b a JOIN b c ON a.tile_id = c.tile_id AND a.day = c.day AND a.event_type = 'view' AND c.event_type = 'click'"


def _river_ice_products(t: Tables):
    i = F.col("event_id")
    tile = F.concat(F.lpad((F.col("user_id") % 60 + 1).cast("string"), 2, "0"), F.lit("ABC"))
    sat = F.when(F.col("event_type") == "view", "_S1A_T").otherwise("_S2A_T")
    pid = F.concat(F.lit("RLIE_"), F.date_format("ts", "yyyyMMdd'T'HHmmss"), sat, tile, F.lit("_V"), (i % 3 + 100).cast("string"), F.lit("_"), (i % 2).cast("string"))
    return t.events().select("event_type", pid.alias("product_id"), tile.alias("tile_id"), F.col("ts").alias("measurement_date"))


@query("match_products", "", BEST + "SELECT a.tile_id, strftime(a.day, '%Y-%m-%d') AS day, a.pid AS ref_id, c.pid AS search_id " + BOTH)
def match_products(t: Tables):
    """JOB-11"""
    p = _river_ice_products(t)
    out = ice.match_products(p.where("event_type = 'view'").select("product_id"), p.where("event_type = 'click'").select("product_id"))
    return out.select("tile_id", day_text("day"), "ref_id", "search_id")


@query("match_stores", "", BEST + """SELECT '{"' || a.tile_id || '_' || strftime(a.day, '%Y%m%d') || '":{"ref_id":"' || a.pid || '","search_id":"' || c.pid || '"}}' AS value """
       + BOTH + " WHERE a.day BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'")
def match_stores(t: Tables):
    """JOB-11, SNK-03: two day-partitioned stores matched, written as documents, read back"""

    p = _river_ice_products(t)
    roots = [shared_folder(t.spark, kind) for kind in ("view", "click")]
    for kind, root in zip(("view", "click"), roots):
        st.write_products(p.where(F.col("event_type") == kind).drop("event_type"), root)
    out = shared_folder(t.spark, "matches")
    st.write_matches(ice.match_stores(t.spark, *roots, dt.date(2024, 1, 10), dt.date(2024, 1, 20)), out, "ref_id", "search_id")
    return t.spark.read.text(out)


def _gap_products(t: Tables):
    kind = F.when(F.col("event_type") == "view", "FSC").when(F.col("event_type") == "click", "WDS").otherwise("SWS")
    pid = F.concat(kind, F.lit("_"), F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit("_S2A_T"), F.col("user_id").cast("string"), F.lit("_V100_"), F.col("event_id").cast("string"))
    return t.events().select(
        "event_id", pid.alias("product_id"), F.col("user_id").alias("tile_id"), F.col("ts").alias("measurement_date"),
        F.timestamp_micros(F.unix_micros("ts") + (F.col("event_id") % 5) * 3_600_000_000).alias("publication_date"),
    )


GPLAN = """p AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'FSC' WHEN 'click' THEN 'WDS' ELSE 'SWS' END || '_' || strftime(ts, '%Y%m%dT%H%M%S') || '_S2A_T' || user_id || '_V100_' || event_id AS pid,
  event_type = 'view' AS optical, user_id AS tile_id, ts, CAST(ts AS DATE) AS day, ts + to_hours(event_id % 5) AS pub FROM events),
j AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, day ORDER BY optical, pub, pid) AS rn FROM p WHERE event_id % 2 = 0) WHERE rn = 1 AND ts >= TIMESTAMP '2024-01-08')"""


@query("plan_gap_filling", "", f"WITH {GPLAN} SELECT tile_id, strftime(day, '%Y-%m-%d') AS day, pid AS triggering_product_id FROM j")
def plan_gap_filling(t: Tables):
    """JOB-8: one trigger per tile and date"""
    p = _gap_products(t)
    known = p.where("event_id % 2 = 1").select(F.col("product_id").alias("triggering_product_id"))
    out = pl.plan_gap_filling(p.drop("event_id"), p.drop("event_id"), known, F.lit("2024-02-01").cast("timestamp"), F.lit("2024-01-08").cast("timestamp"), 3)
    return out["jobs"].select("tile_id", day_text("product_date"), "triggering_product_id")


@query("plan_gap_inputs", "", f"""WITH {GPLAN} SELECT j.pid AS triggering_product_id, count(*) AS n_inputs FROM j JOIN p ON p.tile_id = j.tile_id AND p.ts >= CAST(j.day - 2 AS TIMESTAMP) AND p.ts < CAST(j.day + 1 AS TIMESTAMP) GROUP BY 1""")
def plan_gap_inputs(t: Tables):
    """JOB-8: inputs of each trigger"""
    p = _gap_products(t)
    known = p.where("event_id % 2 = 1").select(F.col("product_id").alias("triggering_product_id"))
    out = pl.plan_gap_filling(p.drop("event_id"), p.drop("event_id"), known, F.lit("2024-02-01").cast("timestamp"), F.lit("2024-01-08").cast("timestamp"), 3)
    return out["inputs"].groupBy("triggering_product_id").agg(F.count("*").alias("n_inputs"))


@query("configure_gap_filling", "", f"""WITH {GPLAN} SELECT pid AS triggering_product_id, CASE WHEN optical AND epoch_us(TIMESTAMP '2024-01-25') - epoch_us(pub) < 10800000000 THEN 'waiting' ELSE 'ready' END AS state FROM j""")
def configure_gap_filling(t: Tables):
    """JOB-8: held optical triggers (no twins in these ids)"""
    p = _gap_products(t)
    known = p.where("event_id % 2 = 1").select(F.col("product_id").alias("triggering_product_id"))
    out = pl.plan_gap_filling(p.drop("event_id"), p.drop("event_id"), known, F.lit("2024-02-01").cast("timestamp"), F.lit("2024-01-08").cast("timestamp"), 3)
    none = out["inputs"].where("false")
    return pl.configure_gap_filling(out["jobs"], none, F.lit("2024-01-25").cast("timestamp")).select("triggering_product_id", "state")


# The whole round on 25 January at noon: every event but an error is a product, every
# fourth with a provisional version an hour before; errors are gap-filled products;
# products of odd events published until the 24th have jobs in all statuses.
ROUND = """p AS (SELECT event_id, k, CASE event_type WHEN 'view' THEN 'FSC' WHEN 'click' THEN 'WDS' ELSE 'SWS' END AS kind,
  CASE event_type WHEN 'view' THEN 'FSC' WHEN 'click' THEN 'WDS' ELSE 'SWS' END || '_E' || event_id || '_T' || user_id || '_V100_' || k AS pid,
  user_id AS tile_id, ts, CAST(ts AS DATE) AS day, ts + to_hours(event_id % 5 + k) AS pub FROM events, (SELECT unnest([0, 1]) AS k)
  WHERE event_type <> 'error' AND (k = 1 OR event_id % 4 = 0)),
tiles AS (SELECT DISTINCT user_id AS tile_id FROM events WHERE user_id % 7 <> 0),
g AS (SELECT 'GFSC_E' || event_id || '_T' || user_id || '_V100_' || CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS gid, user_id AS tile_id, ts, CAST(ts AS DATE) AS day,
  CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS stamp FROM events WHERE event_type = 'error'),
kn AS (SELECT pid AS trig, tile_id, day AS pd, pub AS tpub, pub + INTERVAL 1 HOUR AS cur, event_id % 16 + 1 AS st FROM p WHERE event_id % 2 = 1 AND pub <= TIMESTAMP '2024-01-24'),
m AS (SELECT max(tpub) AS last, max(tpub) - INTERVAL 1 SECOND AS lo FROM kn),
one AS (SELECT * FROM (SELECT p.*, row_number() OVER (PARTITION BY p.tile_id, p.day ORDER BY kind = 'FSC', pub, pid) AS rn FROM p JOIN tiles USING (tile_id), m
  WHERE pub > lo AND pub < TIMESTAMP '2024-01-25 12:00:00' AND (kind <> 'FSC' OR ts >= lo - INTERVAL 7 DAY) AND pid NOT IN (SELECT trig FROM kn)) WHERE rn = 1),
idle AS (SELECT gid, tile_id, ts, day FROM (SELECT g.*, row_number() OVER (PARTITION BY tile_id ORDER BY stamp DESC, gid DESC) AS rn FROM g JOIN tiles USING (tile_id)
  WHERE day >= DATE '2024-01-10' AND day <= DATE '2024-01-24' AND tile_id NOT IN (SELECT tile_id FROM p WHERE day = DATE '2024-01-24')) WHERE rn = 1),
j AS (SELECT trig || '@' || strftime(pd, '%Y%m%d') AS jid, * FROM (
  SELECT pid AS trig, tile_id, day AS pd, TIMESTAMP '2024-01-25 12:00:00' AS cur, pub AS tpub, 'new' AS origin FROM one WHERE ts >= TIMESTAMP '2024-01-20'
  UNION ALL SELECT trig, tile_id, pd, cur, tpub, 'open' FROM kn WHERE st <= 3
  UNION ALL SELECT gid, tile_id, DATE '2024-01-24', TIMESTAMP '2024-01-25 12:00:00', last, 'daily' FROM idle, m
    WHERE TIMESTAMP '2024-01-24' < ts + INTERVAL 7 DAY AND day <> DATE '2024-01-24' AND EXISTS (SELECT 1 FROM p WHERE day = DATE '2024-01-24'))),
w AS (SELECT *, CASE WHEN pd = CAST(cur AS DATE) THEN cur ELSE CAST(pd + 1 AS TIMESTAMP) - INTERVAL 1 MICROSECOND END AS hi FROM j),
i AS (SELECT jid, pid, p.day FROM w JOIN p ON p.tile_id = w.tile_id AND p.ts <= hi AND p.ts >= CAST(CAST(hi AS DATE) - 6 AS TIMESTAMP) WHERE origin <> 'daily'),
s AS (SELECT w.*, coalesce(n, 0) AS n_inputs, CASE WHEN row_number() OVER (PARTITION BY tile_id, pd ORDER BY cur DESC, jid DESC) > 1 THEN 'cancelled'
    WHEN trig LIKE '%!_1' ESCAPE '!' AND (w.jid, substr(trig, 1, length(trig) - 1) || '0') IN (SELECT (jid, pid) FROM i) THEN 'cancelled'
    WHEN trig LIKE 'FSC%' AND TIMESTAMP '2024-01-25 12:00:00' - tpub < INTERVAL 3 HOUR THEN 'waiting'
    WHEN n IS NULL AND origin <> 'daily' THEN 'waiting' ELSE 'ready' END AS state FROM w LEFT JOIN (SELECT jid, count(*) AS n FROM i GROUP BY 1) USING (jid)),
t AS (SELECT jid, gid FROM (SELECT jid, gid, row_number() OVER (PARTITION BY jid ORDER BY stamp DESC, gid DESC) AS rn FROM s JOIN g ON g.tile_id = s.tile_id AND g.ts <= hi AND g.day >= CAST(hi AS DATE) - 14
  WHERE state = 'ready' AND origin <> 'daily') WHERE rn = 1 UNION ALL SELECT jid, trig FROM s WHERE state = 'ready' AND origin = 'daily'),
inside AS (SELECT jid, p.pid FROM t JOIN g USING (gid) JOIN p ON p.tile_id = g.tile_id AND p.day BETWEEN g.day - 2 AND g.day - 1 AND p.event_id % 5 <> 0),
gone AS (SELECT i.jid, i.day FROM i LEFT JOIN inside ON inside.jid = i.jid AND inside.pid = i.pid GROUP BY 1, 2 HAVING count(*) = count(inside.pid)),
u AS (SELECT i.jid, count(*) AS n_used FROM i LEFT JOIN gone ON gone.jid = i.jid AND gone.day = i.day WHERE gone.jid IS NULL GROUP BY 1)"""


@query("gap_filling_round", "", f"""WITH {ROUND}
SELECT jid AS job_id, s.tile_id, strftime(pd, '%Y-%m-%d') AS day, origin, state, epoch_us(tpub) AS published_us, gid AS gap_filled_id, n_inputs, coalesce(n_used, 0) AS n_used
FROM s LEFT JOIN t USING (jid) LEFT JOIN u USING (jid)""")
def gap_filling_round(t: Tables):
    """JOB-8 end to end: search mark, daily jobs, states, gap-filled input, obsolete dates"""
    e, i = t.events(), F.col("event_id")
    kind = F.when(F.col("event_type") == "view", "FSC").when(F.col("event_type") == "click", "WDS").otherwise("SWS")
    made = e.where("event_type <> 'error'").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1)))).where("k = 1 OR event_id % 4 = 0")
    p = made.select(
        i, F.concat(kind, F.lit("_E"), i, F.lit("_T"), F.col("user_id"), F.lit("_V100_"), F.col("k")).alias("product_id"), F.col("user_id").alias("tile_id"),
        F.col("ts").alias("measurement_date"), F.timestamp_micros(F.unix_micros("ts") + (i % 5 + F.col("k")) * 3_600_000_000).alias("publication_date"),
    )
    g = e.where("event_type = 'error'").select(
        F.concat(F.lit("GFSC_E"), i, F.lit("_T"), F.col("user_id"), F.lit("_V100_"), F.unix_seconds("ts")).alias("product_id"),
        F.col("user_id").alias("tile_id"), F.col("ts").alias("measurement_date"),
    )
    held = g.select("product_id", "tile_id", F.explode(F.array(*[F.date_sub(F.to_date("measurement_date"), d) for d in (1, 2)])).alias("day"))
    contents = held.join(
        p.where("event_id % 5 <> 0").select("tile_id", F.to_date("measurement_date").alias("day"), F.col("product_id").alias("input_id")), ["tile_id", "day"]
    ).select("product_id", "input_id")
    known = p.where("event_id % 2 = 1 AND publication_date <= TIMESTAMP '2024-01-24'").select(
        F.col("product_id").alias("triggering_product_id"), "tile_id", F.to_date("measurement_date").alias("product_date"),
        F.col("publication_date").alias("triggering_product_publication_date"),
        (F.col("publication_date") + F.expr("INTERVAL 1 HOUR")).alias("curation_timestamp"), (i % 16 + 1).cast("int").alias("last_status_id"),
    )
    tiles = e.where("user_id % 7 <> 0").select(F.col("user_id").alias("tile_id")).distinct()
    out = pl.gap_filling_round(
        p.drop("event_id"), g, contents, known, tiles, dt.datetime(2024, 1, 25, 12), F.lit("2024-01-20").cast("timestamp"), dt.date(2024, 1, 24)
    )
    used = out["inputs"].groupBy("job_id").agg(F.count_if("used").alias("n_used"))
    return out["jobs"].join(used, "job_id", "left").select(
        "job_id", "tile_id", day_text("product_date"), "origin", "state", us("triggering_product_publication_date", "published_us"),
        "gap_filled_id", "n_inputs", F.coalesce("n_used", F.lit(0)).cast("long").alias("n_used"),
    )


@query("plan_optical", "", """
WITH c AS (SELECT event_id AS seq, 's' || event_id AS source_id, user_id AS tile_id, ts AS m, ts + to_hours(event_id % 30) AS s, ts + to_hours(event_id % 30 + event_id % 5) AS h, event_id FROM events WHERE event_type = 'view')
SELECT source_id, CASE WHEN event_id % 3 = 0 THEN 'reprocessing' WHEN event_id % 30 < 24 AND event_id % 5 < 3 THEN 'nrt' ELSE 'delayed' END AS priority FROM c WHERE event_id % 10 <> 0 AND m >= TIMESTAMP '2024-01-08'""")
def plan_optical(t: Tables):
    """JOB-9: new jobs with hub date and priority"""
    i = F.col("event_id")
    def plus(hours):
        return F.timestamp_micros(F.unix_micros("ts") + hours * 3_600_000_000)

    e = t.events().where("event_type = 'view'")
    sid = F.concat(F.lit("s"), i.cast("string"))
    cand = e.select(
        i.alias("seq"), sid.alias("source_id"), F.col("user_id").alias("tile_id"), F.col("ts").alias("measurement_date"),
        F.col("ts").alias("creation_date"), plus(i % 30).alias("source_publication_date"), (i % 3 != 0).alias("nrt"),
    )
    hub = e.where("event_id % 10 <> 0").select(sid.alias("product_id"), plus(i % 30 + i % 5).alias("publication_date"))
    known = cand.where("false")
    return pl.plan_optical(cand, known, hub, F.lit("2024-01-08").cast("timestamp"))["jobs"].select("source_id", "priority")
