"""Footprints, tiles, hulls and projections."""

from pyspark.sql import functions as F

from firnline.functions import projections as P
from firnline.operators import pixels as px
from firnline.operators import spatial as sp
from firnline.plans import ice
from firnline.registry.core import Tables, query

# Squares (x0, y0, side) meet tiles (x0, y0, 10) when the closed boxes overlap.
MEET = """JOIN tiles t ON s.x0 <= t.x0 + 10 AND t.x0 <= s.x0 + s.side AND s.y0 <= t.y0 + 10 AND t.y0 <= s.y0 + s.side"""
AREA = """greatest(0, least(s.x0 + s.side, t.x0 + 10) - greatest(s.x0, t.x0)) * greatest(0, least(s.y0 + s.side, t.y0 + 10) - greatest(s.y0, t.y0))"""


@query("acquisition_tiles", "squares tiles", f"SELECT s.id AS product_id, t.tile_id FROM squares s {MEET}")
def acquisition_tiles(t: Tables):
    """J-10"""
    return sp.acquisition_tiles(t.squares().select(F.col("id").alias("product_id"), "ring"), t.grid_tiles(), cell=5.0)


@query("basin_tiles", "squares tiles", f"""SELECT 'b' || s.id AS basin_name, t.tile_id, s.x0 AS minx, s.y0 AS miny, s.x0 + s.side AS maxx, s.y0 + s.side AS maxy FROM squares s {MEET}""")
def basin_tiles(t: Tables):
    """J-11"""
    basins = t.squares().select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("basin_name"), "ring")
    return sp.basin_tiles(basins, t.grid_tiles(), cell=5.0)


@query("overlap_area", "squares tiles", f"""SELECT s.id % 100 AS assembly, t.tile_id, round(sum({AREA}), 6) AS area FROM squares s {MEET} GROUP BY 1, 2 HAVING sum({AREA}) >= 3""")
def overlap_area(t: Tables):
    """J-12"""
    a = t.squares().select((F.col("id") % 100).alias("assembly"), "ring")
    out = sp.overlap_area(a, t.grid_tiles(), ["assembly"], cell=5.0, min_area=3.0)
    return out.withColumn("area", F.round("area", 6))


@query("reaches_in", "squares", """SELECT id FROM squares WHERE x0 <= 23.5 AND x0 + side >= 11.5 AND y0 <= 30.5 AND y0 + side >= 20.5""")
def reaches_in(t: Tables):
    """J-13: ids of the geometries meeting a query polygon"""
    poly = [(11.5, 20.5), (23.5, 20.5), (23.5, 30.5), (11.5, 30.5)]
    reaches = t.squares().select("id", F.col("ring").alias("geometry"), F.lit(1.0).alias("area"))
    return ice.river_geometries(reaches, poly, ids_only=True)


@query("reaches_full", "squares", """SELECT id, floor(x0 * 1.2345 * 100) / 100 AS area FROM squares WHERE x0 <= 23.5 AND x0 + side >= 11.5 AND y0 <= 30.5 AND y0 + side >= 20.5""")
def reaches_full(t: Tables):
    """J-13: full form, with the size check: every answer is within the limit"""
    poly = [(11.5, 20.5), (23.5, 20.5), (23.5, 30.5), (11.5, 30.5)]
    reaches = t.squares().select("id", F.col("ring").alias("geometry"), (F.col("x0") * 1.2345).alias("area"))
    return ice.river_geometries(reaches, poly, split=True).select("id", "area")


@query("exclude_crossing", "squares tiles", f"""SELECT s.id, t.tile_id FROM squares s {MEET}
WHERE NOT (s.x0 + s.side BETWEEN t.x0 AND t.x0 + 10 AND s.y0 + s.side >= t.y0 AND s.y0 <= t.y0 + 10)""")
def exclude_crossing(t: Tables):
    """J-23: tiles crossed by the right edge of a square are dropped"""
    pairs = sp.intersecting(t.squares().select("id", "ring"), t.grid_tiles().select("tile_id", "ring"), 5.0).select(
        F.col("a_id").alias("id"), F.col("b_tile_id").alias("tile_id"), F.col("b_ring").alias("ring")
    )
    lines = t.squares().select("id", F.slice("ring", 2, 2).alias("ring"))
    return sp.exclude_crossing(pairs, lines, ["id"], 5.0).select("id", "tile_id")


@query("clip_inside", "squares tiles", f"""SELECT s.id, t.tile_id, round({AREA}, 6) AS area FROM squares s {MEET} WHERE {AREA} > 0""")
def clip_inside(t: Tables):
    """J-29: parts inside; areas of the clipped rings"""
    from firnline.functions.geometry import overlap_with_convex

    out = sp.clip_to_tiles(t.squares().select("id", "ring"), t.grid_tiles().select("tile_id", "ring"), 5.0)
    r = F.col("ring")
    area = overlap_with_convex(r["x"], r["y"], r["x"], r["y"])
    return out.withColumn("area", area).where("area > 0").select("id", "tile_id", F.round("area", 6).alias("area"))


UNCOVERED = """SELECT t.tile_id, CAST(100 - count(u.cx) AS DOUBLE) AS area_outside FROM tiles t
LEFT JOIN (SELECT DISTINCT cx, cy FROM squares s, (SELECT unnest(range(-1, 60)) AS cx), (SELECT unnest(range(-1, 60)) AS cy) WHERE cx >= x0 AND cx < x0 + side AND cy >= y0 AND cy < y0 + side) u
  ON u.cx >= t.x0 AND u.cx < t.x0 + 10 AND u.cy >= t.y0 AND u.cy < t.y0 + 10 GROUP BY 1"""


@query("clip_outside", "squares tiles", UNCOVERED)
def clip_outside(t: Tables):
    """J-29: what all polygons leave of each tile, as rings with holes; the area of
    the rings"""
    shapes = sp.shapes_of(t.squares().select("ring"), t.grid_tiles().select("tile_id", "ring"), 10.0, outside=True)
    r = F.col("ring")
    one = F.aggregate(
        F.sequence(F.lit(0), F.size(r) - 1), F.lit(0.0),
        lambda s, i: s + F.get(r, i)["x"] * F.get(r, (i + 1) % F.size(r))["y"] - F.get(r, (i + 1) % F.size(r))["x"] * F.get(r, i)["y"],
    ) / 2
    area = shapes.groupBy("tile_id").agg(F.sum(one).alias("a"))
    return t.grid_tiles().select("tile_id").join(area, "tile_id", "left").select("tile_id", F.round(F.coalesce("a", F.lit(0.0)), 6).alias("area_outside"))


@query("outside_points", "squares tiles", """
SELECT c_custkey AS id, EXISTS (SELECT 1 FROM tiles t WHERE px > t.x0 AND px < t.x0 + 10 AND py > t.y0 AND py < t.y0 + 10)
  AND NOT EXISTS (SELECT 1 FROM squares s WHERE abs(px - s.x0) + abs(py - s.y0) < s.side) AS inside
FROM (SELECT c_custkey, c_custkey % 59 + 0.3 AS px, c_custkey * 7 % 61 + 0.11 AS py FROM customer)""")
def outside_points(t: Tables):
    """J-29: points in what turned polygons (diamonds) leave of the tiles"""
    x, y, d = F.col("x0"), F.col("y0"), F.col("side")
    corner = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    diamonds = t.squares().select(F.array(corner(x - d, y), corner(x, y - d), corner(x + d, y), corner(x, y + d)).alias("ring"))
    shapes = sp.shapes_of(diamonds, t.grid_tiles().select("tile_id", "ring"), 5.0, outside=True)
    k = F.col("c_custkey")
    pts = t.raw("customer").select(k.alias("id"), (k % 59 + 0.3).cast("double").alias("x"), (k * 7 % 61 + 0.11).cast("double").alias("y"))
    return sp.points_in_shapes(pts, shapes, 5.0).select("id", "inside")


@query("clip_outside_all", "squares tiles", UNCOVERED)
def clip_outside_all(t: Tables):
    """J-29: area left outside all polygons, which overlap; corners are whole numbers"""
    out = sp.clip_to_tiles(t.squares().select("id", "ring"), t.grid_tiles().select("tile_id", "ring"), 5.0, outside=True)
    return out.withColumn("area_outside", F.round("area_outside", 6))


@query("burn", "squares tiles", """
WITH_G""".replace("WITH_G", """SELECT DISTINCT t.tile_id, CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col, 1 AS value FROM squares s JOIN tiles t ON true, (SELECT unnest(range(0, 20)) AS r), (SELECT unnest(range(0, 20)) AS c)
WHERE t.x0 + (c + 0.5) * 0.5 BETWEEN s.x0 AND s.x0 + s.side AND t.y0 + 10 - (r + 0.5) * 0.5 BETWEEN s.y0 AND s.y0 + s.side"""))
def burn(t: Tables):
    """J-25: polygons onto a grid of half-unit pixels"""
    grid = t.grid_tiles().select(
        "tile_id", F.col("x0").alias("ulx"), (F.col("y0") + 10).alias("uly"), F.lit(0.5).alias("size"),
        F.lit(20).alias("nrows"), F.lit(20).alias("ncols"),
    )
    return sp.burn(t.squares().select("id", "ring"), grid, 5.0)


@query("points_in_polygons", "squares", """
WITH_P""".replace("WITH_P", """SELECT c_custkey AS id, EXISTS (SELECT 1 FROM squares s WHERE c_custkey % 53 + 0.25 BETWEEN x0 AND x0 + side AND c_custkey % 47 + 0.25 BETWEEN y0 AND y0 + side) AS inside FROM customer"""))
def points_in_polygons(t: Tables):
    """J-25: land test of points"""
    k = F.col("c_custkey")
    pts = t.raw("customer").select(k.alias("id"), (k % 53 + 0.25).cast("double").alias("x"), (k % 47 + 0.25).cast("double").alias("y"))
    return sp.points_in_polygons(pts, t.squares().select(F.col("id").alias("poly"), "ring"), 5.0).select("id", "inside")


@query("bounds_of", "squares", """SELECT id % 10 AS grp, min(x0) AS minx, min(y0) AS miny, max(x0 + side) AS maxx, max(y0 + side) AS maxy FROM squares GROUP BY 1""")
def bounds_of(t: Tables):
    """A-37"""
    return sp.bounds_of(t.squares().withColumn("grp", F.col("id") % 10), ["grp"])


@query("valid_footprint", "vol", """WITH_F""".replace("WITH_F", """
SELECT tile_id, CAST(min(col) AS DOUBLE) AS minx, CAST(min("row") AS DOUBLE) AS miny, CAST(max(col) AS DOUBLE) AS maxx, CAST(max("row") AS DOUBLE) AS maxy FROM vol WHERE value <> 255 GROUP BY 1"""))
def valid_footprint(t: Tables):
    """A-34: bounds of each product's hull (the hull itself is checked in tests)"""
    p = t.volume_pixels()
    extents = p.select("tile_id").distinct().select("tile_id", F.lit(9).alias("nrows"), F.lit(9).alias("ncols"))
    hull = sp.valid_footprint(p, extents, keys=("tile_id",))
    return sp.bounds_of(hull, ["tile_id"])


@query("aoi_cover", "", """WITH RECURSIVE sq AS (SELECT p_partkey * 37 % 400 AS x0, p_size AS y0, 1 + p_partkey % 2 AS side FROM part),
met AS (SELECT DISTINCT x0 + i AS cx, y0 + j AS cy FROM sq, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j) WHERE i < side AND j < side),
reach(cx, cy, lx, ly) AS (SELECT cx, cy, cx, cy FROM met UNION SELECT m.cx, m.cy, r.lx, r.ly FROM reach r JOIN met m
  ON abs(m.cx - r.cx) + abs(m.cy - r.cy) = 1 AND (m.cx > r.lx OR (m.cx = r.lx AND m.cy >= r.ly))),
low AS (SELECT cx, cy, min(lx * 2147483648 + ly) AS l FROM reach GROUP BY 1, 2),
link AS (SELECT a.l AS a, b.l AS b FROM low a JOIN low b ON abs(a.cx - b.cx) + abs(a.cy - b.cy) = 1 AND a.l <> b.l),
full_part(l, m) AS (SELECT l, l FROM low UNION SELECT f.l, k.b FROM full_part f JOIN link k ON k.a = f.m),
part_of AS (SELECT cx, cy, (SELECT min(m) FROM full_part f WHERE f.l = low.l) AS part FROM low),
o AS (SELECT min(cx) AS ox, min(cy) AS oy FROM met),
c AS (SELECT part, (cx - ox) // 5 AS sx, (cy - oy) // 5 AS sy, cx, cy FROM part_of, o),
n AS (SELECT part, sx, sy, count(*) AS n_cells FROM c GROUP BY ALL),
rows AS (SELECT part, sx, sy, cy + j AS y, min(cx) AS a, max(cx) + 1 AS b FROM c, (SELECT unnest([0, 1]) AS j) GROUP BY ALL),
pt AS (SELECT part, sx, sy, y, a AS x FROM rows UNION SELECT part, sx, sy, y, b FROM rows),
edge AS (SELECT p.part, p.sx, p.sy, p.x, p.y, q.x AS qx, q.y AS qy FROM pt p JOIN pt q ON p.part = q.part AND p.sx = q.sx AND p.sy = q.sy AND (p.x <> q.x OR p.y <> q.y)),
hull AS (SELECT DISTINCT part, sx, sy, x, y FROM edge e WHERE NOT EXISTS (SELECT 1 FROM pt r WHERE r.part = e.part AND r.sx = e.sx AND r.sy = e.sy AND
  ((qx - e.x) * (r.y - e.y) - (qy - e.y) * (r.x - e.x) < 0 OR ((qx - e.x) * (r.y - e.y) - (qy - e.y) * (r.x - e.x) = 0
   AND ((r.x - e.x) * (qx - e.x) + (r.y - e.y) * (qy - e.y) < 0 OR (r.x - qx) * (e.x - qx) + (r.y - qy) * (e.y - qy) < 0)))))
SELECT part, CAST(sx AS BIGINT) AS sx, CAST(sy AS BIGINT) AS sy, n_cells, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM hull JOIN n USING (part, sx, sy)""")
def aoi_cover(t: Tables):
    """A-35: corners of every hull, over scattered squares that form many parts; a
    square reaches a little less than its side, so it meets its own cells alone"""
    k = F.col("p_partkey")
    x, y, side = (k * 37 % 400).cast("double"), F.col("p_size").cast("double"), (1 + k % 2).cast("double")
    squares = t.raw("part").select(sp.box_ring(x + 0.25, y + 0.25, x + side - 0.25, y + side - 0.25).alias("ring"))
    return sp.aoi_cover(squares).select("part", "sx", "sy", "n_cells", F.explode("ring").alias("p")).select("part", "sx", "sy", "n_cells", "p.x", "p.y")


@query("border_lines", "squares", """
SELECT id, x0 AS first_x, y0 AS first_y, x0 + side AS last_x, y0 + side AS last_y FROM squares""")
def border_lines(t: Tables):
    """J-23: scan lines of an ascending footprint"""
    acq = t.squares().withColumn("orbit_dir", F.lit("ascending"))
    out = sp.border_lines(acq)
    first, last = F.element_at("line_first", 1), F.element_at("line_last", 2)
    return out.select(
        "id", first["x"].alias("first_x"), first["y"].alias("first_y"), last["x"].alias("last_x"), last["y"].alias("last_y")
    )


@query("pixel_grid", "", """
SELECT c_custkey AS id, 1000.0::DOUBLE + (c_custkey % 7 + 0.5) * 20 AS x, 5000.0::DOUBLE - (c_custkey % 11 + 0.5) * 20 AS y, CAST(c_custkey % 11 AS INTEGER) AS "row", CAST(c_custkey % 7 AS INTEGER) AS col FROM customer""")
def pixel_grid(t: Tables):
    """F-13: index to centre and back"""
    k = F.col("c_custkey")
    c = P.pixel_centre(k % 11, k % 7, F.lit(1000.0), F.lit(5000.0), F.lit(20.0))
    i = P.pixel_index(F.col("c.x"), F.col("c.y"), F.lit(1000.0), F.lit(5000.0), F.lit(20.0))
    rows = t.raw("customer").select(k.alias("id"), c.alias("c"))
    return rows.select("id", "c.x", "c.y", i["row"].alias("row"), i["col"].alias("col"))


@query("projection_round_trip", "", "SELECT c_custkey AS id, CAST(1 AS BOOLEAN) AS utm_ok, CAST(1 AS BOOLEAN) AS laea_ok FROM customer")
def projection_round_trip(t: Tables):
    """F-14: there and back within a hundredth of a metre (known points in tests)"""
    k = F.col("c_custkey")
    lon, lat = (k % 40 - 10).cast("double") + 0.37, (k % 35 + 35).cast("double") + 0.11
    epsg = (F.lit(32600) + P.utm_zone(lon)).cast("int")
    d = t.raw("customer").select(k.alias("id"), lon.alias("lon"), lat.alias("lat"), epsg.alias("epsg"))
    d = d.withColumn("u", P.lonlat_to_utm(F.col("lon"), F.col("lat"), F.col("epsg"))).withColumn("l", P.lonlat_to_laea(F.col("lon"), F.col("lat")))
    d = d.withColumn("ub", P.utm_to_lonlat(F.col("u.x"), F.col("u.y"), F.col("epsg"))).withColumn("lb", P.laea_to_lonlat(F.col("l.x"), F.col("l.y")))

    def near(s: str):
        return (F.abs(F.col(f"{s}.lon") - F.col("lon")) < 1e-7) & (F.abs(F.col(f"{s}.lat") - F.col("lat")) < 1e-7)

    return d.select("id", near("ub").alias("utm_ok"), near("lb").alias("laea_ok"))


def _utm_tiles(t: Tables):
    """Twenty-five UTM tiles of 90 x 90 pixels of 20 m around 9 E, 47 N."""
    k = F.col("n_nationkey")
    x, y = (k % 5 * 1800 + 480000).cast("double"), (F.floor(k / 5) * 1800 + 5200000).cast("double")
    return t.raw("nation").select(
        k.alias("tile_id"), F.lit(32632).alias("epsg"), x.alias("ulx"), (y + 1800).alias("uly"), (x + 1800).alias("lrx"), y.alias("lry")
    )


def _laea_targets(t: Tables):
    centre = P.lonlat_to_laea(F.lit(9.0), F.lit(47.0))
    k = F.col("r_regionkey")
    return t.raw("region").select(
        k.alias("target_id"),
        (F.floor(centre["x"] / 1000) * 1000 + k * 1000 - 16000).alias("ulx"),
        (F.floor(centre["y"] / 1000) * 1000 - 1000).alias("uly"),
    ).select(
        "target_id", "ulx", "uly", F.lit(20).alias("nrows"), F.lit(20).alias("ncols"),
        sp.box_ring(F.col("ulx"), F.col("uly") - 1000, F.col("ulx") + 1000, F.col("uly")).alias("ring"),
    )


@query("target_sources")
def target_sources(t: Tables):
    """J-24: mosaic targets and the UTM tiles they need"""
    return sp.target_sources(_laea_targets(t).select("target_id", "ring"), _utm_tiles(t)).select("target_id", "tile_id")


@query("season_mosaic")
def season_mosaic(t: Tables):
    """JOB-4 and JOB-12: persistent snow regridded and merged on the target grid"""
    from firnline.plans.snow import season_mosaic as merge

    v = t.volume_pixels()
    snow = v.select(
        (F.col("tile_id") % 25).cast("int").alias("tile_id"),
        (F.col("product_id") % 90).cast("int").alias("row"), (F.col("row") * 10 + F.col("col")).cast("int").alias("col"), "value",
    )
    tiles_map = px.persistent_snow(snow)
    return merge(tiles_map, _utm_tiles(t), _laea_targets(t), 20.0, 50.0)


@query("plan_wet_snow")
def plan_wet_snow(t: Tables):
    """JOB-7: radar slices from parts, tiles in degrees, snow products from events"""
    from firnline.plans.planning import plan_wet_snow as plan

    k = F.col("p_partkey")
    lon, lat = (k % 20).cast("double"), (F.floor(k / 20) % 25 + 35).cast("double")
    day = F.timestamp_seconds(F.lit(1704067200) + F.floor(k / 500) * 86400 + (k % 500) * 30)
    acq = t.raw("part").select(
        F.concat(F.lit("R"), k.cast("string")).alias("product_id"), F.lit("S1A").alias("platform"),
        F.hex(k.cast("long")).alias("take_id"), F.lit(1).alias("slice"), F.lit(1).alias("total_slices"),
        day.alias("start_ts"), (day + F.expr("INTERVAL 25 SECONDS")).alias("stop_ts"), F.lit("ASCENDING").alias("orbit_dir"),
        (k % 7).alias("rel_orbit"), (day + F.expr("INTERVAL 1 HOUR")).alias("published"), k.alias("seq"),
        sp.box_ring(lon, lat, lon + 2.5, lat + 1.5).alias("ring"),
    )
    n = F.col("n_nationkey")
    x, y = (n % 5 * 4 + 0.5).cast("double"), (F.floor(n / 5) * 5 + 36.0).cast("double")
    epsg = (F.lit(32600) + P.utm_zone(x)).cast("int")
    name = F.concat(F.lpad((n + 10).cast("string"), 2, "0"), F.lit("AAA"))
    tiles = t.raw("nation").select(name.alias("tile_id"), epsg.alias("epsg"), sp.box_ring(x, y, x + 1.2, y + 0.9).alias("ring"))
    tracks = t.raw("nation").select(name.alias("tile_id"), F.array((n % 7).cast("long"), ((n + 3) % 7).cast("long")).alias("tracks"))
    mountain = t.raw("nation").where("n_nationkey % 2 = 0").select(name.alias("tile_id"))
    e = t.events()
    snow = e.where("event_type = 'view'").select(
        F.concat(F.lpad((F.col("user_id") % 25 + 10).cast("string"), 2, "0"), F.lit("AAA")).alias("tile_id"),
        F.col("event_id").cast("string").alias("product_id"), F.col("ts").alias("measurement_date"), F.col("ts").alias("publication_date"),
    )
    existing = t.raw("nation").limit(0).select(F.lit("").alias("name"), F.lit(True).alias("wet_snow"), F.lit(True).alias("wet_dry"))
    jobs = plan(acq.withColumn("rel_orbit", F.col("rel_orbit")), tiles, tracks, mountain, snow, existing)["jobs"]
    return jobs.select("name", "tile_id", "track", "assembly_id", F.round("area", 0).alias("area"), "wet_snow", "wet_dry", "snow_id")
