"""Geometry against hand-worked shapes and brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline.functions import geometry as g
from firnline.functions import projections as P
from firnline.operators import spatial as sp
from firnline.plans import ice, snow
from firnline.operators.reaches import TooManyReaches

SQ = np.array([[0, 0], [2, 0], [2, 2], [0, 2]], float)
DIAMOND = np.array([[1, -1], [3, 1], [1, 3], [-1, 1]], float)


def ring(points):
    return [(float(x), float(y)) for x, y in points]


def rings(spark, rows, key="id"):
    return spark.createDataFrame([(k, ring(p)) for k, p in rows], f"{key} string, ring array<struct<x:double,y:double>>")


def test_intersection_and_area():
    far = SQ + 10
    assert g.touches(SQ, DIAMOND) and not g.touches(SQ, far)
    assert g.touches(SQ, SQ * 0.1 + 0.5)  # contained
    assert g.touches(SQ, np.array([[-1, 1], [5, 1]], float))  # line across
    assert not g.touches(SQ, np.array([[-1, 3], [5, 3]], float))
    assert g.ring_area(g.clip_convex(SQ, DIAMOND)) == pytest.approx(4.0)
    assert g.ring_area(g.clip_convex(DIAMOND, SQ[::-1])) == pytest.approx(4.0)
    assert g.ring_area(g.clip_convex(SQ + 1, SQ)) == pytest.approx(1.0)


def test_join_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    a = [(f"a{i}", rng.uniform(0, 20, 2) + g.convex_hull(rng.normal(size=(6, 2)))) for i in range(60)]
    b = [(f"b{i}", rng.uniform(0, 20, 2) + g.convex_hull(rng.normal(size=(5, 2)) * 2)) for i in range(40)]
    want = {(i, j) for i, p in a for j, q in b if g.touches(p, q)}
    for cell, salts in ((1.0, 1), (3.0, 4)):
        got = [(r.a_id, r.b_id) for r in sp.intersecting(rings(spark, a), rings(spark, b), cell, salts=salts).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_known_projection_points(spark):
    r = spark.range(1).select(
        P.lonlat_to_laea(F.lit(5.0), F.lit(50.0)).alias("l"), P.lonlat_to_laea(F.lit(10.0), F.lit(52.0)).alias("o"),
        P.lonlat_to_utm(F.lit(9.0), F.lit(0.0), F.lit(32632)).alias("u"), P.laea_to_lonlat(F.lit(3962799.45), F.lit(2999718.85)).alias("b"),
    ).collect()[0]
    assert (r.l.x, r.l.y) == (pytest.approx(3962799.45, abs=0.01), pytest.approx(2999718.85, abs=0.01))
    assert (r.o.x, r.o.y) == (pytest.approx(4321000), pytest.approx(3210000))
    assert (r.u.x, r.u.y) == (pytest.approx(500000), pytest.approx(0, abs=1e-6))
    assert (r.b.lon, r.b.lat) == (pytest.approx(5, abs=1e-6), pytest.approx(50, abs=1e-6))


def test_valid_footprint_shapes(spark):
    def hull(cells, n=10):
        df = spark.createDataFrame([("p", r, c, 1) for r, c in cells] or [("p", 0, 0, 255)], "product_id string, row int, col int, value int")
        ext = spark.createDataFrame([("p", n, n)], "product_id string, nrows int, ncols int")
        return {(p.x, p.y) for p in sp.valid_footprint(df, ext).collect()[0].ring}

    assert hull([]) == {(0, 0), (9, 0), (9, 9), (0, 9)}
    assert hull([(4, 4)]) == {(3, 3), (5, 3), (5, 5), (3, 5)}
    assert hull([(0, 0), (0, 9)]) == {(0, 0), (9, 0), (9, 1), (0, 1)}
    assert hull([(1, 1), (1, 5), (5, 3), (3, 3)]) == {(1, 1), (5, 1), (3, 5)}


def test_burn_and_points(spark):
    tri = rings(spark, [("t", [(0, 0), (4, 0), (0, 4)])])
    grid = spark.createDataFrame([("g", 0.0, 4.0, 1.0, 4, 4)], "tile_id string, ulx double, uly double, size double, nrows int, ncols int")
    got = {(r.row, r.col) for r in sp.burn(tri, grid, 2.0).collect()}
    want = {(r, c) for r in range(4) for c in range(4) if (c + 0.5) + (4 - r - 0.5) <= 4}
    assert got == want
    pts = spark.createDataFrame([("i", 1.0, 1.0), ("o", 3.0, 3.0)], "id string, x double, y double")
    assert {r.id: r.inside for r in sp.points_in_polygons(pts, tri, 2.0).collect()} == {"i": True, "o": False}


def test_cover_holds_every_tile(spark):
    tiles = [(str(i), SQ * 0.9 + [1.7 * i, 1.1 * i]) for i in range(8)]
    hulls = [np.array([[p.x, p.y] for p in r.ring]) for r in sp.aoi_cover(rings(spark, tiles)).collect()]
    for _, t in tiles:
        pts = np.concatenate([t, t.mean(axis=0, keepdims=True)])
        assert all(any(g.inside(p[None], h)[0] for h in hulls) for p in pts)


def test_border_lines_and_crossing(spark):
    # ascending footprint: south, east, north, west corners in turn
    fp = rings(spark, [("p", [(2, 0), (10, 2), (8, 10), (0, 8)])], "product_id").withColumn("orbit_dir", F.lit("ASCENDING"))
    r = sp.border_lines(fp).collect()[0]
    assert r.valid
    assert [(p.x, p.y) for p in r.line_first] == [(2, 0), (10, 2)]
    assert [(p.x, p.y) for p in r.line_last] == [(0, 8), (8, 10)]
    bad = rings(spark, [("p", [(10, 0), (9, 2), (0, 10), (1, 8)])], "product_id").withColumn("orbit_dir", F.lit("ASCENDING"))
    assert not sp.border_lines(bad).collect()[0].valid
    tiles = spark.createDataFrame([("k", "in", ring(SQ + 4)), ("k", "edge", ring(SQ + [5, 0]))], "key string, tile_id string, ring array<struct<x:double,y:double>>")
    lines = spark.createDataFrame([("k", [(2.0, 0.0), (10.0, 2.0)])], "key string, ring array<struct<x:double,y:double>>")
    assert [x.tile_id for x in sp.exclude_crossing(tiles, lines, ["key"], 1.0).collect()] == ["in"]


def test_reach_guard(spark):
    reaches = rings(spark, [(str(i), SQ + i) for i in range(5)]).select(F.col("id"), F.col("ring").alias("geometry"), F.lit(1.239).alias("area"))
    box = [(0, 0), (9, 0), (9, 9), (0, 9)]
    assert ice.river_geometries(reaches, box).first().area == pytest.approx(1.23)
    with pytest.raises(TooManyReaches):
        ice.river_geometries(reaches, box, limit=4)
    assert ice.river_geometries(reaches, box, ids_only=True, limit=4).count() == 5
    with pytest.raises(ValueError):
        ice.river_ice(reaches, reaches, "2024-01-01", "2024-01-02")


def test_regrid_nearest(spark):
    """Each target pixel gets the source pixel its centre falls in."""
    src = spark.createDataFrame([("32TLS", 32632, 480000.0, 5202000.0, 482000.0, 5200000.0)], "tile_id string, epsg int, ulx double, uly double, lrx double, lry double")
    pix = spark.range(100 * 100).select(F.lit("32TLS").alias("tile_id"), F.floor(F.col("id") / 100).cast("int").alias("row"), (F.col("id") % 100).cast("int").alias("col"), (F.col("id") % 3 == 0).cast("int").alias("value"), F.lit(1).alias("qc"))
    mid = spark.range(1).select(P.utm_to_lonlat(F.lit(481000.0), F.lit(5201000.0), F.lit(32632)).alias("p")).select(P.lonlat_to_laea(F.col("p.lon"), F.col("p.lat")).alias("q")).collect()[0].q
    ux, uy = mid.x - 200, mid.y + 200
    foot = rings(spark, [("E", [(ux, uy - 400), (ux + 400, uy - 400), (ux + 400, uy), (ux, uy)])], "target_id")
    targets = foot.select("target_id", "ring", F.lit(ux).alias("ulx"), F.lit(uy).alias("uly"), F.lit(20).alias("nrows"), F.lit(20).alias("ncols"))
    grid = sp.target_pixels(targets, 20.0)
    out = snow.season_mosaic(pix, src, targets)
    assert out.count() == 400 and out.where("value = 255").count() == 0
    check = grid.withColumn("ll", P.laea_to_lonlat(F.col("x"), F.col("y"))).withColumn("u", P.lonlat_to_utm(F.col("ll.lon"), F.col("ll.lat"), F.lit(32632)))
    want = {(r.row, r.col): int((int((5202000 - r.u.y) // 20) * 100 + int((r.u.x - 480000) // 20)) % 3 == 0) for r in check.collect()}
    assert {(r.row, r.col): r.value for r in out.collect()} == want
    away = targets.withColumn("ulx", F.col("ulx") - 100000)
    assert snow.season_mosaic(pix, src, away).where("value = 255 and qc = 255").count() == 400


def test_outside_counts_overlaps_once(spark, monkeypatch):
    tiles = rings(spark, [("t", SQ * 5), ("far", SQ + 100)], "tile_id")
    polys = [("a", SQ * 2), ("b", SQ * 2 + 2), ("b2", SQ * 2 + 2), ("d", DIAMOND * 2 + 1), ("out", SQ * 3 + [8, -3])]
    monkeypatch.setattr(sp, "STRIP_RINGS", 1)
    for cell in (3.0, 50.0):
        got = {r.tile_id: r.area_outside for r in sp.clip_to_tiles(rings(spark, polys), tiles, cell, outside=True).collect()}
        y, x = np.mgrid[0.01:10:0.02, 0.01:10:0.02]
        pts = np.column_stack([x.ravel(), y.ravel()])
        hit = np.any([g.inside(pts, p) for _, p in polys], axis=0)
        assert got["t"] == pytest.approx(100 * (1 - hit.mean()), abs=0.1) and got["far"] == pytest.approx(4.0)
    same = rings(spark, [("a", SQ), ("b", SQ + 1)])
    assert sp.clip_to_tiles(same, tiles, 3.0, outside=True).where("tile_id = 't'").collect()[0].area_outside == pytest.approx(93.0)


def star(n, seed, cx=50.0, cy=50.0):
    """A ring of n corners around a centre, with radius between 20 and 45."""
    rng = np.random.default_rng(seed)
    at = np.sort(rng.uniform(0, 2 * np.pi, n))
    r = 32 + 8 * np.sin(7 * at) + rng.uniform(-5, 5, n)
    return np.column_stack([cx + r * np.cos(at), cy + r * np.sin(at)])


def ring_rows(rings):
    return [(i, [(float(x), float(y)) for x, y in r]) for i, r in enumerate(rings)]


RING = "id long, ring array<struct<x:double,y:double>>"


def burned(spark, rings, size, n):
    grid = spark.createDataFrame([(1, 0.0, 100.0, size, n, n)], "tile_id int, ulx double, uly double, size double, nrows int, ncols int")
    out = sp.burn(spark.createDataFrame(ring_rows(rings), RING), grid, 60.0)
    return {(r.row, r.col) for r in out.collect()}


def test_burn_of_turned_polygons(spark):
    """Against the test of every centre, with borders, repeated rings and holes by
    self-crossing rings."""
    rings = [star(40, 1), star(40, 1), star(9, 2, 20, 80), np.array([[10, 10], [30, 30], [30, 10], [10, 30.0]]),
             np.array([[60.5, 5.5], [80.5, 5.5], [80.5, 20.5], [60.5, 20.5]]), np.array([[0, 0], [7, 7], [14, 0.0]])]
    got = burned(spark, rings, 1.0, 100)
    rr, cc = np.meshgrid(np.arange(100), np.arange(100), indexing="ij")
    centres = np.column_stack([cc.ravel() + 0.5, 100 - (rr.ravel() + 0.5)])
    hit = np.zeros(len(centres), bool)
    for r in rings:
        hit |= g.inside(centres, r)
    want = {(int(a), int(b)) for a, b in zip(rr.ravel()[hit], cc.ravel()[hit])}
    assert got == want


def test_burn_of_a_hundred_thousand_corners(spark):
    ring = star(100_000, 3)
    got = burned(spark, [ring], 0.5, 200)
    rng = np.random.default_rng(4)
    for r, c in rng.integers(0, 200, (60, 2)):
        assert g._in_portions(np.array([(c + 0.5) * 0.5, 100 - (r + 0.5) * 0.5]), ring) == ((r, c) in got)
    assert len(got) > 10_000


def test_large_rings_touch_as_small_ones_do(monkeypatch):
    rng = np.random.default_rng(6)
    pairs = [(star(60, i, *rng.uniform(0, 200, 2)), star(30, 100 + i, 50, 50)) for i in range(40)]
    want = [bool(g.touches(p[None], q[None])[0]) for p, q in pairs]
    assert 5 < sum(want) < 35
    for limit in (7, 100, 1 << 20):
        monkeypatch.setattr(g, "COMPARED", limit)
        assert [g.touch_of_large(p, q) for p, q in pairs] == want


@pytest.mark.parametrize("seed", range(6))
def test_union_and_difference_as_rings(seed):
    """Turned and self-crossing polygons over a convex window: points, area, and
    each ring's sense."""
    rng = np.random.default_rng(seed)
    window = np.array([[0, 10], [60, 0], [100, 50], [70, 100], [5, 90]], float)
    polys = [star(int(rng.integers(3, 12)), 10 * seed + k, *rng.uniform(0, 100, 2)) * rng.uniform(0.4, 1) for k in range(6)]
    polys += [polys[0], SQ * 10 + 30, np.array([[30, 30], [70, 70], [70, 30], [30, 70.0]])]
    sweep = g.Sweep(polys, window)
    pts = rng.uniform(0, 100, (4000, 2))
    within = g.inside(pts, window)
    covered = np.any([g.inside(pts, p) for p in polys], axis=0) & within
    for outside, want in ((False, covered), (True, within & ~covered)):
        rings = sweep.rings(outside)
        odd = np.sum([g.inside(pts, r) for r in rings], axis=0) % 2 == 1
        assert (odd == want).all()
        assert sum(g.signed_area(r) for r in rings) == pytest.approx(sweep.area(outside), rel=1e-9)
        assert rings and max(g.signed_area(r) for r in rings) > 0
    assert sweep.area() + sweep.area(True) == pytest.approx(g.signed_area(window))


def test_hole_runs_with_the_clock():
    window = SQ * 50
    frame = [np.array(r, float) for r in ([[10, 10], [90, 10], [90, 20], [10, 20]], [[10, 80], [90, 80], [90, 90], [10, 90]],
                                          [[10, 10], [20, 10], [20, 90], [10, 90]], [[80, 10], [90, 10], [90, 90], [80, 90]])]
    got = {(round(g.signed_area(r)), len(r)) for r in g.Sweep(frame, window).rings()}
    assert got == {(6400, 4), (-3600, 4)}
    assert {round(g.signed_area(r)) for r in g.Sweep(frame, window).rings(True)} == {10000, -6400, 3600}
    assert [round(g.signed_area(r)) for r in g.Sweep([], window).rings(True)] == [10000] and g.Sweep([], window).rings() == []


def test_answers_over_the_limit_hold_every_reach(spark):
    """A request over the limit is split: all rows, no answer over the limit."""
    reaches = rings(spark, [(str(i % 9), SQ + i) for i in range(10)]).select(F.col("id"), F.col("ring").alias("geometry"), F.lit(1.239).alias("area"), F.lit("r").alias("eu_hydro_id"))
    box = [(0, 0), (19, 0), (19, 19), (0, 19)]
    for limit, answers in ((10, 1), (4, 3)):
        got = ice.river_geometries(reaches, box, limit=limit, split=True).collect()
        sizes = [sum(r.answer == a for r in got) for a in {r.answer for r in got}]
        assert sorted(r.id for r in got) == sorted(str(i % 9) for i in range(10))
        assert max(sizes) <= limit and len(sizes) >= answers and all(r.area == pytest.approx(1.23) for r in got)
    values = spark.range(30).selectExpr(
        "string(id % 10) river_km_id", "timestamp'2024-01-02' datetime", "1 water_perc", "2 ice_perc", "0 other_perc", "0 cloud_perc", "0 nd_perc", "0 qc", "'Sentinel-1' type"
    )
    asked = dict(hydro_id="r", limit=4)
    with pytest.raises(TooManyReaches):
        ice.river_ice(reaches, values, "2024-01-01", "2024-01-03", **asked)
    got = ice.river_ice(reaches, values, "2024-01-01", "2024-01-03", split=True, **asked).collect()
    assert sorted(r.river_km_id for r in got) == sorted(str(i % 10) for i in range(30) if i % 10 < 9)
    assert all(len({r.river_km_id for r in got if r.answer == a}) <= 4 for a in {r.answer for r in got})


def test_crowded_cells_are_halved(spark, monkeypatch):
    """Many polygons and points in one cell against brute force, with few pairs."""
    rng = np.random.default_rng(8)
    polys = [star(int(rng.integers(3, 9)), i, *rng.uniform(0, 100, 2)) * 0.2 + rng.uniform(0, 70, 2) for i in range(150)]
    polys += [SQ * 10 + 40, polys[0], np.array([[30, 30], [50, 50], [50, 30], [30, 50.0]])]
    pts = np.concatenate([rng.uniform(0, 100, (700, 2)), [[40, 45], [60, 60], [61, 61], [30, 30]]])
    hit = np.any([g.inside(pts, p) for p in polys], axis=0)
    assert 100 < hit.sum() < 650
    rows = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id long, x double, y double")
    held, holds = [], sp._holds
    monkeypatch.setattr(sp, "_holds", lambda ring, x, y: held.append(1) or holds(ring, x, y))
    monkeypatch.setattr(sp, "CELL_ROWS", 4)
    monkeypatch.setattr(sp, "STRIP_RINGS", 12)
    got = {r.id: r.inside for r in sp.points_in_polygons(rows, spark.createDataFrame(ring_rows(polys), RING), 128.0).collect()}
    assert [got[i] for i in range(len(pts))] == hit.tolist()
    assert len(held) > 3  # several sizes of cells

    class Counted(g.Sweep):
        def __init__(self, rings, window, *a):
            if len(rings) > 40:
                raise AssertionError(f"{len(rings)} rings at once")
            super().__init__(rings, window, *a)

    monkeypatch.setattr(sp, "Sweep", Counted)
    tiles = rings(spark, [("a", SQ * 25), ("b", SQ * 25 + [50, 0]), ("c", SQ * 50 + [0, 50])], "tile_id")
    within = np.any([g.inside(pts, t) for t in (SQ * 25, SQ * 25 + [50, 0], SQ * 50 + [0, 50])], axis=0)
    some = np.arange(700)
    for outside, want in ((True, within & ~hit), (False, within & hit)):
        shapes = sp.shapes_of(spark.createDataFrame(ring_rows(polys), RING), tiles, 128.0, outside=outside)
        got = {r.id: r.inside for r in sp.points_in_shapes(rows, shapes, 128.0).collect()}
        assert [got[i] for i in some] == want[some].tolist()


def test_growing_tables_are_shuffled_and_empty_blocks_not_swept(spark, monkeypatch):
    """No table goes to every task whole; what no polygon meets is left as it is."""
    class Held(g.Sweep):
        def __init__(self, rings, window, *a):
            if not rings:
                raise AssertionError("block without polygons swept")
            super().__init__(rings, window, *a)

    monkeypatch.setattr(sp, "Sweep", Held)
    polys = spark.createDataFrame(ring_rows([SQ * 2 + 3]), RING)
    tiles = rings(spark, [("a", SQ * 10), ("far", (SQ * 10 + [96, 0])[::-1]), ("bent", np.array([[200, 0], [206, 0], [207, 0], [203, 5.0]]))], "tile_id")
    pts = [(1, 4.0, 4.0), (2, 1.0, 1.0), (3, 9.0, 9.5), (4, 97.0, 3.0), (5, 105.5, 9.0), (6, 50.0, 5.0), (7, 203.0, 1.0), (8, 200.5, 3.0)]
    points = spark.createDataFrame(pts, "id long, x double, y double")
    for outside, want in ((True, {2, 3, 4, 5, 7}), (False, {1})):
        shapes = sp.shapes_of(polys, tiles, 8.0, outside=outside)
        got = sp.points_in_shapes(points, shapes, 8.0)
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
        assert {r.id for r in got.collect() if r.inside} == want
        areas = {}
        for r in shapes.collect():
            ring = np.array([[p.x, p.y] for p in r.ring])
            assert r.hole == (g.signed_area(ring) < 0)
            areas[r.tile_id] = areas.get(r.tile_id, 0) + g.signed_area(ring)
        assert areas == pytest.approx({"a": 384, "far": 400, "bent": 17.5} if outside else {"a": 16})
