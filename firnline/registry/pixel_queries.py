"""Raster algebra on pixel tables."""

from pyspark.sql import functions as F

from firnline import codes
from firnline.functions import bits as fb
from firnline.functions import quality as fq
from firnline.functions import radar as fr
from firnline.operators import filters as fl
from firnline.operators import pixels as px
from firnline.operators import reaches as rc
from firnline.plans import snow as sn
from firnline.registry.core import Tables, day_text, query

FILL = """SELECT tile_id, "row", col, value, qc, flags, acq_epoch FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, "row", col
  ORDER BY CAST(value NOT IN (205, 255) AS INTEGER) DESC, ts DESC, product_id DESC) AS rn FROM px) WHERE rn = 1"""


@query("daily_fill", "px", FILL)
def daily_fill(t: Tables):
    """A-09"""
    return px.daily_fill(t.pixels())


TEMPORAL = """cut AS (SELECT CAST(epoch_us(TIMESTAMP '2024-01-25 23:59:59') // 1000000 - 7 * 86400 AS BIGINT) AS c),
r AS (SELECT px.*, c, row_number() OVER (PARTITION BY tile_id, "row", col ORDER BY ts DESC, product_id DESC) AS n FROM px, cut),
o AS (SELECT *, CASE WHEN n = 1 AND acq_epoch >= c AND value NOT IN (205, 255) THEN 0
    WHEN acq_epoch > c AND value NOT IN (205, 255) THEN 1 WHEN acq_epoch > c AND value = 205 THEN 2
    WHEN n = 1 AND acq_epoch >= c THEN 3 WHEN n = 1 THEN 4 ELSE 9 END AS k FROM r),
b AS (SELECT *, row_number() OVER (PARTITION BY tile_id, "row", col ORDER BY k, CASE WHEN k = 2 THEN -n ELSE n END) AS rn FROM o)
SELECT tile_id, "row", col, CASE WHEN k = 4 THEN 255 ELSE value END AS value, CASE WHEN k = 4 THEN 255 ELSE qc END AS qc,
  CASE WHEN k = 4 THEN 0 ELSE flags END AS flags, CASE WHEN k = 4 THEN 0 ELSE acq_epoch END AS acq_epoch FROM b WHERE rn = 1"""


@query("temporal_fill", "px", "CTE:" + TEMPORAL)
def temporal_fill(t: Tables):
    """A-10"""
    return px.temporal_fill(t.pixels(), F.lit("2024-01-25").cast("date"), 7)


@query("fill_from_wet", "px", """CTE:s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, "row", col ORDER BY product_id DESC) AS rn FROM px) WHERE rn = 1),
w AS (SELECT tile_id, "row", col, max(product_id) AS p FROM px WHERE value < 60 GROUP BY 1, 2, 3)
SELECT s.tile_id, s."row", s.col, CASE WHEN s.value IN (205, 255) AND p IS NOT NULL THEN 100 ELSE s.value END AS value,
  CASE WHEN s.value IN (205, 255) AND p IS NOT NULL THEN CAST(p % 4 AS INTEGER) ELSE s.qc END AS qc,
  CASE WHEN s.value IN (205, 255) AND p IS NOT NULL THEN s.flags | 64 ELSE s.flags END AS flags
FROM s LEFT JOIN w ON s.tile_id = w.tile_id AND s."row" = w."row" AND s.col = w.col""")
def fill_from_wet(t: Tables):
    """J-28"""
    from firnline.scale import latest_by

    p = t.pixels()
    snow = latest_by(p, list(px.PIXEL), ["product_id"])
    wet = p.where("value < 60").groupBy(*px.PIXEL).agg(F.max("product_id").alias("p")).select(
        *px.PIXEL, F.lit(codes.WET).alias("value"), (F.col("p") % 4).cast("int").alias("qc"), F.col("p").alias("acq_epoch")
    )
    return px.fill_from_wet(snow, wet).select("tile_id", "row", "col", "value", "qc", "flags")


@query("mosaic", "px", """CTE:m AS (SELECT "row", col, product_id AS o, CASE WHEN value = 255 THEN 255 WHEN value > 20 THEN 1 ELSE 0 END AS v, qc FROM px WHERE value <> 205),
r AS (SELECT *, row_number() OVER (PARTITION BY "row", col ORDER BY CASE v WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END, CASE WHEN v = 255 THEN -o ELSE o END) AS rn FROM m)
SELECT "row", col, v AS value, qc FROM r WHERE rn = 1""")
def mosaic(t: Tables):
    """A-11"""
    v = F.when(F.col("value") == 255, 255).when(F.col("value") > 20, 1).otherwise(0)
    m = t.pixels().where("value <> 205").select("row", "col", v.alias("value"), "qc", F.col("product_id").alias("source_order"))
    return px.mosaic(m)


@query("fill_report", "px", f"""CTE:f AS ({FILL}),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, "row", col ORDER BY ts DESC, product_id DESC) AS rn FROM px) WHERE rn = 1)
SELECT count(*) FILTER (WHERE n.value IN (205, 255)) AS gaps_before, count(*) FILTER (WHERE f.value IN (205, 255)) AS gaps_after,
  count(*) FILTER (WHERE n.value IN (205, 255) AND f.value NOT IN (205, 255)) AS filled
FROM n JOIN f ON n.tile_id = f.tile_id AND n."row" = f."row" AND n.col = f.col""")
def fill_report(t: Tables):
    """A-38"""
    from firnline.scale import latest_by

    p = t.pixels()
    return px.fill_report(latest_by(p, list(px.PIXEL), ["product_ts", "product_id"]), px.daily_fill(p))


@query("snow_counts", "vol", """
SELECT tile_id, "row", col, count(*) FILTER (WHERE value <= 100) AS n_clear, count(*) FILTER (WHERE value BETWEEN 1 AND 100) AS n_snow FROM vol GROUP BY 1, 2, 3""")
def snow_counts(t: Tables):
    """A-03"""
    return px.snow_counts(t.volume_pixels())


@query("persistent_snow", "px", """CTE:c AS (SELECT tile_id, "row", col, count(*) FILTER (WHERE value <= 100) AS nc, count(*) FILTER (WHERE value BETWEEN 5 AND 100) AS ns FROM px GROUP BY 1, 2, 3)
SELECT tile_id, "row", col, CASE WHEN nc = 0 THEN 255 WHEN ns >= nc * 0.95::DOUBLE THEN 1 ELSE 0 END AS value,
  CASE WHEN nc = 0 THEN 255 WHEN nc >= 25 THEN 0 WHEN nc >= 18 THEN 1 WHEN nc >= 11 THEN 2 ELSE 3 END AS qc FROM c""")
def persistent_snow(t: Tables):
    """A-04: small values count as snow-free"""
    v = F.when(F.col("value") < 5, 0).otherwise(F.col("value"))
    return px.persistent_snow(t.pixels().withColumn("value", v))


@query("season_map", "px", """CTE:c AS (SELECT tile_id, "row", col, count(*) FILTER (WHERE value <= 100) AS nc, count(*) FILTER (WHERE value BETWEEN 1 AND 100) AS ns
  FROM px WHERE day >= DATE '2024-01-05' AND day <= DATE '2024-01-25' GROUP BY 1, 2, 3)
SELECT tile_id, "row", col, CASE WHEN nc = 0 THEN 255 WHEN ns >= nc * 0.95::DOUBLE THEN 1 ELSE 0 END AS value,
  CASE WHEN nc = 0 THEN 255 WHEN nc >= 25 THEN 0 WHEN nc >= 18 THEN 1 WHEN nc >= 11 THEN 2 ELSE 3 END AS qc FROM c""")
def season_map(t: Tables):
    """JOB-4 tile part"""
    day = lambda d: F.lit(d).cast("date")
    return sn.season_map(t.pixels(), day("2024-01-05"), day("2024-01-25"), strict=False)


UP = """b AS (SELECT tile_id, CAST("row" // 3 AS INTEGER) AS "row", CAST(col // 3 AS INTEGER) AS col, avg(CASE WHEN value BETWEEN 0 AND 100 THEN value END) AS m,
  count(*) FILTER (WHERE value = 205) AS c, count(*) FILTER (WHERE value = 255) AS n FROM vol GROUP BY 1, 2, 3)"""


@query("upscale", "vol", f"""CTE:{UP}
SELECT tile_id, "row", col, CASE WHEN m IS NOT NULL THEN CAST(round_even(m, 0) AS INTEGER) WHEN c > 0 AND c >= n THEN 205 ELSE 255 END AS value FROM b""")
def upscale(t: Tables):
    """A-06"""
    return px.upscale(t.volume_pixels(), 3)


@query("upscale_classes", "vol", f"""CTE:{UP} SELECT tile_id, "row", col, CASE WHEN c > 0 AND c >= n THEN 205 ELSE 255 END AS value FROM b""")
def upscale_classes(t: Tables):
    """A-06: no value in range, so classes compete"""
    return px.upscale(t.volume_pixels(), 3, value_min=300, value_max=400)


@query("upscale_mean", "vol", """
SELECT tile_id, CAST("row" // 3 AS INTEGER) AS "row", CAST(col // 3 AS INTEGER) AS col, CAST(floor(avg(quantity)) AS INTEGER) AS value FROM vol GROUP BY 1, 2, 3""")
def upscale_mean(t: Tables):
    """A-07"""
    return px.upscale_mean(t.volume_pixels().withColumn("value", F.col("quantity")), 3)


BITS8 = " + ".join(f"(CASE WHEN sum((flags >> {b}) & 1) >= 4.5 THEN {1 << b} ELSE 0 END)" for b in range(8))


@query("upscale_bits", "px", f"""
SELECT tile_id, CAST("row" // 3 AS INTEGER) AS "row", CAST(col // 3 AS INTEGER) AS col, {BITS8} AS flags FROM px GROUP BY 1, 2, 3""")
def upscale_bits(t: Tables):
    """A-08"""
    return px.upscale_bits(t.pixels(), 3)


@query("upscale_layers", "px", f"""
SELECT tile_id, CAST("row" // 3 AS INTEGER) AS "row", CAST(col // 3 AS INTEGER) AS col, {BITS8} AS flags,
  CASE WHEN count(*) FILTER (WHERE value <= 100) > 0 THEN CAST(round_even(avg(CASE WHEN value <= 100 THEN value END), 0) AS INTEGER)
    WHEN count(*) FILTER (WHERE value = 205) >= count(*) FILTER (WHERE value = 255) THEN 205 ELSE 255 END AS value,
  CAST(round_even(avg(qc), 0) AS INTEGER) AS qc FROM px GROUP BY 1, 2, 3""")
def upscale_layers(t: Tables):
    """A-06 and A-08 together, as the gap-filling job uses them"""
    return px.upscale_layers(t.pixels(), 3, ["tile_id"])


@query("cloud_percent", "vol", "SELECT tile_id, CAST(round_even(100.0 * avg(CAST(value = 205 AS INTEGER)), 0) AS INTEGER) AS cloud_percent FROM vol GROUP BY 1")
def cloud_percent(t: Tables):
    """A-12"""
    return px.cloud_percent(t.volume_pixels())


@query("cloud_ratios", "vol", """
SELECT tile_id, round(CASE WHEN count(*) > count(*) FILTER (WHERE value = 255) THEN count(*) FILTER (WHERE value = 205) * 100.0 / (count(*) - count(*) FILTER (WHERE value = 255)) END, 6) AS cloud_vs_valid,
  round(count(*) FILTER (WHERE value = 205) * 100.0 / count(*), 6) AS cloud_vs_all, round(count(*) FILTER (WHERE value IN (205, 255)) * 100.0 / count(*), 6) AS not_clear_vs_all FROM vol GROUP BY 1""")
def cloud_ratios(t: Tables):
    """A-13"""
    out = px.cloud_ratios(t.volume_pixels(), ["tile_id"])
    return out.select("tile_id", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("cloud_vs_valid", "cloud_vs_all", "not_clear_vs_all")])


@query("value_histogram", "vol", """CTE:h AS (SELECT tile_id, value, count(*) AS n_pixels FROM vol GROUP BY 1, 2),
s AS (SELECT *, CAST(sum(n_pixels) OVER w AS BIGINT) AS n_total, CAST(coalesce(sum(n_pixels) FILTER (WHERE value <> 255) OVER w, 0) AS BIGINT) AS n_valid FROM h WINDOW w AS (PARTITION BY tile_id))
SELECT tile_id, value, n_pixels, n_total, n_valid, round(CAST(n_pixels * 100.0 / n_total AS DOUBLE), 6) AS percent FROM s WHERE value <> 255""")
def value_histogram(t: Tables):
    """A-14"""
    out = px.value_histogram(t.volume_pixels(), ["tile_id"])
    return out.withColumn("percent", F.round(F.col("percent").cast("double"), 6))


@query("layer_stats", "", """
SELECT l_suppkey AS tile_id, round(avg(l_quantity - 25), 6) AS mean, round(stddev_pop(l_quantity - 25), 6) AS stddev, min(l_quantity - 25) AS min, max(l_quantity - 25) AS max,
  count(*) FILTER (WHERE l_quantity = 26) AS n_nodata, count(*) FILTER (WHERE l_quantity = 25) AS n_zero, count(*) FILTER (WHERE l_quantity < 25) AS n_negative FROM lineitem GROUP BY 1""")
def layer_stats(t: Tables):
    """A-39"""
    rows = t.raw("lineitem").select(F.col("l_suppkey").alias("tile_id"), (F.col("l_quantity") - 25).alias("value"))
    out = px.layer_stats(rows, ["tile_id"], nodata=1)
    return out.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))


@query("row_extents", "vol", """SELECT tile_id, "row", min(col) AS first, max(col) AS last FROM vol WHERE value <> 255 GROUP BY 1, 2""")
def row_extents(t: Tables):
    """W-17"""
    return px.row_extents(t.volume_pixels(), ["tile_id"])


@query("merge_masks", "px", """CTE:l AS (SELECT tile_id, "row", col, CAST(product_id % 3 AS INTEGER) AS o, max(CASE WHEN value <= 100 THEN value % 4 ELSE 0 END) AS v FROM px GROUP BY 1, 2, 3, 4)
SELECT tile_id, "row", col, coalesce(arg_max(v, o) FILTER (WHERE v <> 0), 0) AS value FROM l GROUP BY 1, 2, 3""")
def merge_masks(t: Tables):
    """A-36: later layer overrides where non-zero"""
    v = F.when(F.col("value") <= 100, F.col("value") % 4).otherwise(0)
    p = t.pixels().withColumn("o", F.col("product_id") % 3)
    layers = [p.where(F.col("o") == i).groupBy(*px.PIXEL).agg(F.max(v).alias("value")) for i in range(3)]
    return px.merge_masks(layers)


@query("merge_any", "px", """SELECT tile_id, "row", col, max(CAST(value = 205 OR value = 255 AS INTEGER)) AS value FROM px GROUP BY 1, 2, 3""")
def merge_any(t: Tables):
    """A-36: any layer"""
    p = t.pixels()
    layers = [p.withColumn("value", (F.col("value") == c).cast("int")) for c in (205, 255)]
    return px.merge_any(layers)


@query("apply_mask", "px", """CTE:m AS (SELECT tile_id, "row", col, bool_or(value = 255) AS hole FROM px WHERE product_id % 2 = 0 GROUP BY 1, 2, 3)
SELECT px.product_id, CASE WHEN coalesce(hole, false) THEN 255 ELSE px.value END AS value FROM px LEFT JOIN m ON px.tile_id = m.tile_id AND px."row" = m."row" AND px.col = m.col""")
def apply_mask(t: Tables):
    """PF-17"""
    p = t.pixels()
    mask = p.where("product_id % 2 = 0").groupBy(*px.PIXEL).agg(F.max(F.when(F.col("value") == 255, 255).otherwise(0)).alias("mask"))
    return fl.apply_mask(p, mask).select("product_id", "value")


@query("pixel_predicates", "px", """
SELECT product_id, value IN (205, 255) AS gap, value BETWEEN 0 AND 100 AS clear, value BETWEEN 1 AND 100 AS snow FROM px""")
def pixel_predicates(t: Tables):
    """PF-12, PF-13"""
    v = F.col("value")
    return t.pixels().select("product_id", fl.is_gap(v).alias("gap"), fl.is_clear(v).alias("clear"), fl.is_snow(v).alias("snow"))


@query("above_noise", "", "SELECT event_id FROM events WHERE value / 100000 > power(10, -3.2) AND value / 50000 > power(10, -3.0)")
def above_noise(t: Tables):
    """PF-18"""
    e = t.raw("events")
    return e.where(fl.above_noise(F.col("value") / 100000, F.col("value") / 50000)).select("event_id")


@query("clean_elevation", "", "SELECT c_custkey, CASE WHEN c_acctbal < -500 THEN -10000.0::DOUBLE ELSE c_acctbal * 2 END AS z FROM customer")
def clean_elevation(t: Tables):
    """PF-19"""
    return t.raw("customer").select("c_custkey", fl.clean_elevation(F.col("c_acctbal") * 2).alias("z"))


@query("stack_layers", "px", """CTE:a AS (SELECT tile_id, "row", col, max(value) AS v FROM px WHERE product_id % 2 = 0 GROUP BY 1, 2, 3),
b AS (SELECT tile_id, "row", col, min(value) AS v FROM px WHERE product_id % 2 = 1 GROUP BY 1, 2, 3), c AS (SELECT tile_id, "row", col, CAST(count(*) AS INTEGER) AS v FROM px GROUP BY 1, 2, 3)
SELECT a.tile_id, a."row", a.col, a.v AS snow, b.v AS radar, c.v AS n FROM a JOIN b ON a.tile_id = b.tile_id AND a."row" = b."row" AND a.col = b.col
JOIN c ON a.tile_id = c.tile_id AND a."row" = c."row" AND a.col = c.col""")
def stack_layers(t: Tables):
    """J-16"""
    p = t.pixels()
    layers = {
        "snow": p.where("product_id % 2 = 0").groupBy(*px.PIXEL).agg(F.max("value").alias("value")),
        "radar": p.where("product_id % 2 = 1").groupBy(*px.PIXEL).agg(F.min("value").alias("value")),
        "n": p.groupBy(*px.PIXEL).agg(F.count("*").cast("int").alias("value")),
    }
    return px.stack(layers)


@query("align_grid", "vol", """
SELECT tile_id, CAST("row" - 2 AS INTEGER) AS "row", CAST(col + 3 AS INTEGER) AS col, count(*) AS n FROM vol WHERE "row" BETWEEN 2 AND 6 AND col BETWEEN 0 AND 6 GROUP BY 1, 2, 3""")
def align_grid(t: Tables):
    """J-17"""
    src = {"ulx": 180.0, "uly": 1000.0, "size": 60.0, "nrows": 9, "ncols": 9}
    dst = {"ulx": 0.0, "uly": 860.0, "size": 60.0, "nrows": 5, "ncols": 10}
    return px.align_grid(t.volume_pixels(), src, dst).groupBy("tile_id", "row", "col").agg(F.count("*").alias("n"))


# --- terrain -------------------------------------------------------------------------
DEM = """dem AS (SELECT l_suppkey AS tile_id, CAST(l_partkey % 9 AS INTEGER) AS r, CAST((l_partkey // 9) % 9 AS INTEGER) AS c, CAST(sum(l_quantity) - 100 AS DOUBLE) AS z FROM lineitem GROUP BY 1, 2, 3),
h AS (SELECT *, CASE WHEN lag(c) OVER w = c - 1 THEN lag(z) OVER w ELSE z END AS l, CASE WHEN lead(c) OVER w = c + 1 THEN lead(z) OVER w ELSE z END AS rr FROM dem WINDOW w AS (PARTITION BY tile_id, r ORDER BY c)),
d AS (SELECT tile_id, r, c, z, l - rr AS d, l + 2 * z + rr AS s FROM h),
g AS (SELECT tile_id, r, c, z,
  ((CASE WHEN lag(r) OVER w = r - 1 THEN lag(d) OVER w ELSE d END) + 2 * d + (CASE WHEN lead(r) OVER w = r + 1 THEN lead(d) OVER w ELSE d END)) / 160.0 AS gc,
  ((CASE WHEN lead(r) OVER w = r + 1 THEN lead(s) OVER w ELSE s END) - (CASE WHEN lag(r) OVER w = r - 1 THEN lag(s) OVER w ELSE s END)) / 160.0 AS gl
  FROM d WINDOW w AS (PARTITION BY tile_id, c ORDER BY r))"""


def _dem(t: Tables):
    return t.volume_pixels().groupBy("tile_id", "row", "col").agg((F.sum("quantity") - 100).cast("double").alias("z"))


@query("gradients", "", f"""WITH {DEM} SELECT tile_id, r AS "row", c AS col, round(gc, 6) AS dz_dc, round(gl, 6) AS dz_dl FROM g""")
def gradients(t: Tables):
    """W-16: stencil"""
    return px.gradients(_dem(t), 20.0).select("tile_id", "row", "col", F.round("dz_dc", 6).alias("dz_dc"), F.round("dz_dl", 6).alias("dz_dl"))


@query("slope_aspect", "", f"""WITH {DEM} SELECT tile_id, r AS "row", c AS col, CAST(trunc(atan(sqrt(gc * gc + gl * gl)) * 100) AS INTEGER) AS slope,
  CASE WHEN gc = 0 AND gl = 0 THEN 0 WHEN gc > 0 THEN CAST(trunc(acos(greatest(-1, least(1, gl / sqrt(gc * gc + gl * gl)))) * 100) AS INTEGER)
  ELSE CAST(trunc((2 * pi() - acos(greatest(-1, least(1, gl / sqrt(gc * gc + gl * gl))))) * 100) AS INTEGER) END AS aspect FROM g""")
def slope_aspect(t: Tables):
    """W-16"""
    return px.slope_aspect(_dem(t), 20.0).select("tile_id", "row", "col", "slope", "aspect")


@query("terrain_water", "", f"""WITH {DEM} SELECT tile_id, r AS "row", c AS col, CAST(z < 0 AND abs(gc) <= 2 AND abs(gl) <= 2 AS INTEGER) AS water FROM g""")
def terrain_water(t: Tables):
    """F-18"""
    return px.terrain_water(px.gradients(_dem(t), 20.0), limit=2.0).select("tile_id", "row", "col", "water")


# --- radar ---------------------------------------------------------------------------
RADAR = """rad AS (SELECT event_id, user_id AS tile_id, value / 1000 AS vh, value / 500 AS vv, (1 + event_id % 7) / 50.0::DOUBLE AS vh_ref, (1 + event_id % 5) / 25.0::DOUBLE AS vv_ref,
  CAST(15 + event_id % 40 AS DOUBLE) AS inc FROM events),
rt AS (SELECT *, vh > power(10, -3.2) AND vv > power(10, -3.0) AS valid, CASE WHEN inc < 20 THEN 1 WHEN inc <= 45 THEN 0.5 * (1 + (45 - inc) / 25) ELSE 0.5 END AS w FROM rad),
rc AS (SELECT *, CASE WHEN valid THEN w * (10 * log10(vh) - 10 * log10(vh_ref)) + (1 - w) * (10 * log10(vv) - 10 * log10(vv_ref)) END AS rc FROM rt)"""
WET = """CASE WHEN rc >= -2.5 THEN 125 WHEN rc < -2.5 THEN 110 ELSE 255 END"""
WETQ = """CASE WHEN rc >= -2.5 THEN 250 WHEN rc >= -3 THEN 3 WHEN rc >= -3.5 THEN 2 WHEN rc >= -4 THEN 1 WHEN rc < -4 THEN 0 ELSE 255 END"""


def _radar(t: Tables):
    i = F.col("event_id")
    return t.raw("events").select(
        "event_id", F.col("user_id").alias("tile_id"), i.alias("row"), i.alias("col"),
        (F.col("value") / 1000).alias("vh"), (F.col("value") / 500).alias("vv"),
        ((i % 7 + 1) / 50.0).alias("vh_ref"), ((i % 5 + 1) / 25.0).alias("vv_ref"),
        (i % 40 + 15).cast("double").alias("inc_angle"),
        F.when(i % 11 == 0, 210).otherwise(0).alias("mask"), F.when(i % 13 == 0, 250).otherwise(0).alias("shadow"),
        (i % 17 == 0).cast("int").alias("mountain"), (i % 60).cast("int").alias("snowmask"),
    )


@query("radar_ratio", "", f"WITH {RADAR} SELECT event_id, valid, round(rc, 6) AS rc, {WET} AS wet_value, {WETQ} AS wet_qc FROM rc")
def radar_ratio(t: Tables):
    """F-09, F-10"""
    return px.wet_snow_ratio(_radar(t)).select("event_id", "valid", F.round("rc", 6).alias("rc"), "wet_value", "wet_qc")


@query("wet_snow", "", f"""WITH {RADAR},
a AS (SELECT *, CASE WHEN event_id % 13 = 0 THEN 250 WHEN event_id % 11 = 0 THEN 210 ELSE 0 END AS m, {WET} AS v, {WETQ} AS q FROM rc),
b AS (SELECT *, CASE WHEN event_id % 17 = 0 THEN 240 WHEN m <> 0 THEN m ELSE v END AS v2, CASE WHEN event_id % 17 = 0 OR m <> 0 THEN 250 ELSE q END AS q2 FROM a)
SELECT tile_id, event_id AS "row", CASE WHEN NOT valid THEN 255 WHEN event_id % 60 < 30 AND v2 = 110 THEN 125 ELSE v2 END AS value,
  CASE WHEN NOT valid THEN 255 WHEN event_id % 60 < 30 AND v2 = 110 THEN 250 ELSE q2 END AS qc FROM b""")
def wet_snow(t: Tables):
    """JOB-2: wet snow over mountains"""
    return sn.wet_snow(_radar(t)).select("tile_id", "row", "value", "qc")


def _scenes(t: Tables):
    """Fine optical scenes: each radar cell covers 3 x 3 pixels of 2 scenes."""
    cell = t.raw("events").select(F.col("event_id").alias("cell"), F.col("user_id").alias("tile_id"), "value")
    fine = cell.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(17))))
    v = F.col("cell") * 7 + F.col("k") * 5
    value = F.when(v % 10 < 3, codes.CLOUD).when(v % 10 == 9, codes.NODATA).when(F.col("cell") % 3 == 0, v % 101).otherwise(100)
    return fine.select(
        "tile_id", F.floor(F.col("k") / 9).alias("product_id"), F.floor(F.col("k") / 9).alias("scene_order"),
        (F.col("cell") * 3 + F.floor((F.col("k") % 9) / 3)).alias("row"), (F.col("cell") * 3 + F.col("k") % 3).alias("col"),
        value.cast("int").alias("value"),
    )


@query("wet_dry_snow", "", f"""WITH {RADAR},
fine AS (SELECT event_id, k // 9 AS scene, event_id * 7 + k * 5 AS x FROM events, (SELECT unnest(range(0, 18)) AS k)),
fv AS (SELECT event_id, scene, CASE WHEN x % 10 < 3 THEN 205 WHEN x % 10 = 9 THEN 255 WHEN event_id % 3 = 0 THEN x % 101 ELSE 100 END AS v FROM fine),
bl AS (SELECT event_id, scene, count(*) FILTER (WHERE v <= 100) AS o, count(*) FILTER (WHERE v = 205) AS c, avg(CASE WHEN v <= 100 THEN v END) AS m FROM fv GROUP BY 1, 2),
st AS (SELECT event_id, scene, CASE WHEN o > 4 AND m >= 90 THEN 'snow' WHEN o > 4 THEN 'free' WHEN c > 9 - o - c THEN 'cloud' ELSE 'none' END AS s FROM bl),
j AS (SELECT rc.event_id, tile_id, valid, {WET} AS wv, {WETQ} AS wq, scene, s FROM rc JOIN st USING (event_id)),
e AS (SELECT *, CASE WHEN s = 'snow' AND wv = 110 THEN 110 WHEN s = 'snow' AND wv = 125 THEN 115 WHEN s = 'free' THEN 120 WHEN s = 'cloud' THEN 205 END AS v,
  CASE WHEN s IN ('snow', 'free') THEN 1 WHEN s = 'cloud' THEN 2 END AS seen FROM j),
f AS (SELECT event_id, any_value(tile_id) AS tile_id, bool_and(valid) AS valid, arg_max(v, scene) FILTER (WHERE v IS NOT NULL) AS v,
  arg_max(CASE WHEN v = 110 THEN wq ELSE 250 END, scene) FILTER (WHERE v IS NOT NULL) AS q, arg_max(seen, scene) FILTER (WHERE seen IS NOT NULL) AS seen,
  max(CASE WHEN event_id % 13 = 0 THEN 250 WHEN event_id % 11 = 0 THEN 210 ELSE 0 END) AS m FROM e GROUP BY 1)
SELECT tile_id, event_id AS "row", CASE WHEN NOT valid THEN 255 WHEN seen = 1 AND m <> 0 THEN m ELSE coalesce(v, 255) END AS value,
  CASE WHEN NOT valid THEN 255 WHEN seen = 1 AND m <> 0 THEN 250 ELSE coalesce(q, 255) END AS qc FROM f""")
def wet_dry_snow(t: Tables):
    """JOB-2: wet, dry and free snow"""
    return sn.wet_dry_snow(_radar(t), _scenes(t)).select("tile_id", "row", "value", "qc")


# --- quality ----------------------------------------------------------------------------
QL = """q AS (SELECT product_id, value, CAST(product_id % 256 AS INTEGER) AS geo, CAST(product_id % 2 AS INTEGER) AS water, CAST((product_id * 13) % 120 AS INTEGER) AS tcd, CAST(product_id % 3 AS INTEGER) AS cm FROM px),
fl AS (SELECT *, ((geo >> 6) & 1) + 2 * ((geo >> 7) & 1) + 4 * CAST(water = 1 AS INTEGER) + 8 * CAST(tcd < 101 AND tcd > 90 AS INTEGER) + 16 * CAST(cm > 0 AND value > 0 AND value < 101 AS INTEGER) + 32 * CAST(tcd > 100 AS INTEGER) AS flags FROM q),
sc AS (SELECT *, 100.0 - 30 * ((flags >> 1) & 1) - 50 * (flags & 1) - 25 * ((flags >> 4) & 1) - 25 * ((flags >> 2) & 1) AS s FROM fl)"""


@query("snow_quality", "px", f"""CTE:{QL}
SELECT product_id, flags, CASE WHEN value IN (205, 255) THEN value ELSE least(3, CAST(trunc(4 - greatest(0, s / 25)) AS INTEGER)) END AS qc_toc,
  CASE WHEN value IN (205, 255) THEN value ELSE least(3, CAST(trunc(4 - greatest(0, (s - 80 * tcd) / 25)) AS INTEGER)) END AS qc_og FROM sc""")
def snow_quality(t: Tables):
    """F-11, JOB-3, UD-01"""
    p = t.pixels()
    i = F.col("product_id")
    layers = p.select(
        i.alias("tile_id"), "row", "col", (i % 256).cast("int").alias("geo_flags"), (i % 2).cast("int").alias("water"),
        ((i * 13) % 120).cast("int").alias("tcd"), (i % 3).cast("int").alias("cloud_mask"),
        F.col("value").alias("snow_toc"), F.col("value").alias("snow_og"),
    )
    return sn.snow_quality_layers(layers).select(F.col("tile_id").alias("product_id"), "flags", "qc_toc", "qc_og")


@query("bandmath", "px", """
SELECT product_id, CAST(value > 50 AS INTEGER) + 2 * CAST(qc = 3 AS INTEGER) + 8 * CAST(flags % 2 = 1 AS INTEGER) AS packed FROM px""")
def bandmath(t: Tables):
    """UD-01: user expressions per bit, as SQL text or columns"""
    packed = fb.bandmath({0: "value > 50", 1: F.col("qc") == 3, 3: "flags % 2 = 1"})
    return t.pixels().select("product_id", packed.alias("packed"))


@query("bit_functions", "px", """
SELECT product_id, (flags >> 3) & 1 AS bit3, CASE WHEN value > 100 THEN flags | 4 ELSE flags & ~4 END AS set2, concat_ws('', flags & 1, (flags >> 1) & 1, (flags >> 2) & 1) AS low3 FROM px""")
def bit_functions(t: Tables):
    """F-08"""
    f = F.col("flags")
    return t.pixels().select(
        "product_id", fb.get_bit(f, 3).alias("bit3"), fb.set_bit(f, 2, F.col("value") > 100).alias("set2"), F.array_join(fb.unpack_bits(f, 3).cast("array<string>"), "").alias("low3")
    )


@query("angle_weight", "", "SELECT event_id, round(CASE WHEN event_id % 60 < 20 THEN 1 WHEN event_id % 60 <= 45 THEN 0.5 * (1 + (45 - event_id % 60) / 25.0) ELSE 0.5 END, 6) AS weight FROM events")
def angle_weight(t: Tables):
    """F-09"""
    return t.raw("events").select("event_id", F.round(fr.angle_weight((F.col("event_id") % 60).cast("double")), 6).alias("weight"))


@query("support_quality", "px", """
SELECT tile_id, count(*) FILTER (WHERE value <= 100) AS n, CASE WHEN count(*) FILTER (WHERE value <= 100) = 0 THEN 255 WHEN count(*) FILTER (WHERE value <= 100) >= 25 THEN 0
  WHEN count(*) FILTER (WHERE value <= 100) >= 18 THEN 1 WHEN count(*) FILTER (WHERE value <= 100) >= 11 THEN 2 ELSE 3 END AS qc FROM px GROUP BY 1""")
def support_quality(t: Tables):
    """A-04 quality"""
    n = t.pixels().groupBy("tile_id").agg(F.count_if(F.col("value") <= 100).alias("n"))
    return n.withColumn("qc", fq.support_quality(F.col("n")))


# --- river ice ------------------------------------------------------------------------------
@query("zonal_shares", "px", """CTE:i AS (SELECT tile_id * 2 + "row" % 2 AS river_km_id, day, CASE WHEN value < 30 THEN 1 WHEN value < 60 THEN 100 WHEN value <= 100 THEN 254 ELSE value END AS v FROM px)
SELECT river_km_id, strftime(day, '%Y-%m-%d') AS day, CAST(round_even(100.0 * count(*) FILTER (WHERE v = 1) / count(*), 0) AS INTEGER) AS water_perc,
  CAST(round_even(100.0 * count(*) FILTER (WHERE v = 100) / count(*), 0) AS INTEGER) AS ice_perc, CAST(round_even(100.0 * count(*) FILTER (WHERE v = 254) / count(*), 0) AS INTEGER) AS other_perc,
  CAST(round_even(100.0 * count(*) FILTER (WHERE v = 205) / count(*), 0) AS INTEGER) AS cloud_perc, CAST(round_even(100.0 * count(*) FILTER (WHERE v = 255) / count(*), 0) AS INTEGER) AS nd_perc,
  count(*) AS n_pixels FROM i GROUP BY 1, 2""")
def zonal_shares(t: Tables):
    """A-15"""
    p = t.pixels()
    v = F.col("value")
    ice = F.when(v < 30, 1).when(v < 60, 100).when(v <= 100, 254).otherwise(v)
    reach = p.select(*px.PIXEL).distinct().withColumn("river_km_id", F.col("tile_id") * 2 + F.col("row") % 2)
    out = rc.zonal_shares(p.withColumn("value", ice), reach, time="day")
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("gap_filled_day", "px", "CTE:" + """
f AS (SELECT tile_id, day, "row", col, value, qc, flags, acq_epoch FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, day, "row", col
  ORDER BY CAST(value NOT IN (205, 255) AS INTEGER) DESC, ts DESC, product_id DESC) AS rn FROM px WHERE day BETWEEN DATE '2024-01-19' AND DATE '2024-01-25' AND product_id % 3 <> 1) WHERE rn = 1),
w AS (SELECT tile_id, day, "row", col, CASE WHEN value < 20 THEN 110 ELSE 125 END AS value, qc, acq_epoch FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, day, "row", col
  ORDER BY CAST(value < 20 AS INTEGER) DESC, ts DESC, product_id DESC) AS rn FROM px WHERE day BETWEEN DATE '2024-01-19' AND DATE '2024-01-25' AND product_id % 3 = 1 AND value <= 100) WHERE rn = 1),
d AS (SELECT coalesce(f.tile_id, w.tile_id) AS tile_id, coalesce(f.day, w.day) AS day, coalesce(f."row", w."row") AS "row", coalesce(f.col, w.col) AS col,
  CASE WHEN coalesce(f.value, 255) IN (205, 255) AND w.value = 110 THEN 100 ELSE coalesce(f.value, 255) END AS value,
  CASE WHEN coalesce(f.value, 255) IN (205, 255) AND w.value = 110 THEN w.qc ELSE coalesce(f.qc, 255) END AS qc,
  ((CASE WHEN coalesce(f.value, 255) IN (205, 255) AND w.value = 110 THEN coalesce(f.flags, 0) | 64 ELSE coalesce(f.flags, 0) END) & ~4) | (CASE WHEN coalesce(f.tile_id, w.tile_id) % 2 = 0 THEN 4 ELSE 0 END) AS flags,
  CASE WHEN coalesce(f.value, 255) IN (205, 255) AND w.value = 110 THEN w.acq_epoch ELSE coalesce(f.acq_epoch, 0) END AS acq_epoch
  FROM f FULL JOIN w ON f.tile_id = w.tile_id AND f.day = w.day AND f."row" = w."row" AND f.col = w.col),
cut AS (SELECT CAST(epoch_us(TIMESTAMP '2024-01-25 23:59:59') // 1000000 - 7 * 86400 AS BIGINT) AS c),
r AS (SELECT d.*, c, row_number() OVER (PARTITION BY tile_id, "row", col ORDER BY day DESC) AS n FROM d, cut),
o AS (SELECT *, CASE WHEN n = 1 AND acq_epoch >= c AND value NOT IN (205, 255) THEN 0
    WHEN acq_epoch > c AND value NOT IN (205, 255) THEN 1 WHEN acq_epoch > c AND value = 205 THEN 2
    WHEN n = 1 AND acq_epoch >= c THEN 3 WHEN n = 1 THEN 4 ELSE 9 END AS k FROM r),
b AS (SELECT *, row_number() OVER (PARTITION BY tile_id, "row", col ORDER BY k, CASE WHEN k = 2 THEN -n ELSE n END) AS rn FROM o)
SELECT tile_id, "row", col, CASE WHEN k = 4 THEN 255 ELSE value END AS value, CASE WHEN k = 4 THEN 255 ELSE qc END AS qc,
  CASE WHEN k = 4 THEN 0 ELSE flags END AS flags, CASE WHEN k = 4 THEN 0 ELSE acq_epoch END AS acq_epoch FROM b WHERE rn = 1""")
def gap_filled_day(t: Tables):
    """JOB-1: daily fill, radar evidence, water flag, window fill (block size 1)."""
    p = t.pixels()
    snow = p.where("product_id % 3 <> 1")
    wet = p.where("product_id % 3 = 1 AND value <= 100").withColumn("value", F.when(F.col("value") < 20, codes.WET).otherwise(codes.NOT_WET))
    water = p.select(*px.PIXEL).distinct().withColumn("water", F.when(F.col("tile_id") % 2 == 0, codes.WATER).otherwise(0))
    out = sn.gap_filled_day(snow, wet, water, "2024-01-25", 7, scale=1)["pixels"]
    return out.select("tile_id", "row", "col", "value", "qc", "flags", "acq_epoch")


@query("gap_filled_clouds", "px", """CTE:f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, day
  ORDER BY CAST(value NOT IN (205, 255) AS INTEGER) DESC, ts DESC, CAST(product_id AS VARCHAR) DESC) AS rn FROM px WHERE day BETWEEN DATE '2024-01-19' AND DATE '2024-01-25') WHERE rn = 1),
cut AS (SELECT CAST(epoch_us(TIMESTAMP '2024-01-25 23:59:59') // 1000000 - 7 * 86400 AS BIGINT) AS c),
r AS (SELECT f.*, c, row_number() OVER (PARTITION BY tile_id ORDER BY day DESC) AS n FROM f, cut),
o AS (SELECT *, CASE WHEN n = 1 AND acq_epoch >= c AND value NOT IN (205, 255) THEN 0 WHEN acq_epoch > c AND value NOT IN (205, 255) THEN 1
    WHEN acq_epoch > c AND value = 205 THEN 2 WHEN n = 1 AND acq_epoch >= c THEN 3 WHEN n = 1 THEN 4 ELSE 9 END AS k FROM r),
b AS (SELECT *, row_number() OVER (PARTITION BY tile_id ORDER BY k, CASE WHEN k = 2 THEN -n ELSE n END) AS rn2 FROM o)
SELECT tile_id, CASE WHEN k <> 4 AND value = 205 THEN 100 ELSE 0 END AS cloud_percent FROM b WHERE rn2 = 1""")
def gap_filled_clouds(t: Tables):
    """JOB-1 with 3 x 3 blocks: cloud share of each tile's result."""
    p = t.pixels()
    water = p.select("tile_id").distinct().select("tile_id", F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit(0).alias("water"))
    empty_wet = p.where("false")
    return sn.gap_filled_day(p, empty_wet, water, "2024-01-25", 7, scale=3)["cloud"]


@query("pixels_per_day", "px", "SELECT tile_id, strftime(day, '%Y-%m-%d') AS day, count(*) AS n FROM px GROUP BY 1, 2")
def pixels_per_day(t: Tables):
    """SRC-04 and SNK-01: layers written by tile and day, read back pruned"""
    from firnline.session import shared_folder
    from firnline.sinks.tables import write_pixels
    from firnline.sources.store import read_pixels

    root = shared_folder(t.spark, "pixels")
    # the day is dropped from the key columns of the small test tiles: one folder per day
    write_pixels(t.pixels().withColumn("tile_group", F.col("tile_id")).withColumn("tile_id", F.lit("all")), root)
    px_back = read_pixels(t.spark, root, layers=("value", "tile_group"))
    return px_back.groupBy(F.col("tile_group").alias("tile_id"), day_text("day")).agg(F.count("*").alias("n"))


@query("pixel_store", "px", """
SELECT 't' || (tile_id % 4) AS tile_id, strftime(day, '%Y-%m-%d') AS day, count(*) AS n, CAST(sum(value + CASE WHEN day >= DATE '2024-01-15' THEN 1 ELSE 0 END) AS BIGINT) AS total
FROM px WHERE tile_id % 4 IN (1, 2) AND day BETWEEN DATE '2024-01-08' AND DATE '2024-01-20' AND product_id % 2 = 0 GROUP BY 1, 2""")
def pixel_store(t: Tables):
    """SRC-04 and SNK-01: written in two runs of which the second replaces a day of
    the first; read for two tiles, some days and half of the products"""
    import datetime as dt

    from firnline.session import shared_folder
    from firnline.sinks.tables import write_pixels
    from firnline.sources.store import read_pixels

    root = shared_folder(t.spark, "pixels")
    px = t.pixels().withColumn("tile_id", F.concat(F.lit("t"), (F.col("tile_id") % 4).cast("string")))
    write_pixels(px.where("day <= DATE '2024-01-15'"), root)
    write_pixels(px.where("day >= DATE '2024-01-15'").withColumn("value", F.col("value") + 1), root)
    half = t.products().where("product_id % 2 = 0")
    back = read_pixels(t.spark, root, ("value",), half, ["t1", "t2"], dt.date(2024, 1, 8), dt.date(2024, 1, 20))
    return back.groupBy("tile_id", day_text("day")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
