"""Footprint joins without a geometry engine.

Rings are ``ARRAY<STRUCT<x,y>>``.  Each side is cut into square cells; an
equi-join on the cell finds candidates, the cell of the lower-left corner of
the common box keeps each pair once (no distinct afterwards), and an exact test
runs on the survivors in Arrow batches.  The adaptive skew join splits a
crowded cell.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline import codes
from firnline.functions import projections as P
from firnline.functions.geometry import (
    Sweep,
    against_clock,
    clip_convex,
    clipped_ring,
    convex_hull,
    overlap_with_convex,
    rings_intersect,
    signed_area,
    union_area,
    utm_box_ring,
)
from firnline.scale import components, python_partitions, stream_groups
from firnline.session import cut_lineage


def box_ring(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    def pt(x: Column, y: Column) -> Column:
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    return F.array(pt(minx, miny), pt(maxx, miny), pt(maxx, maxy), pt(minx, maxy))


def with_bounds(df: DataFrame, ring: str = "ring", prefix: str = "") -> DataFrame:
    """Bounding box columns of the ring."""
    xs, ys = F.col(ring)["x"], F.col(ring)["y"]
    return (
        df.withColumn(f"{prefix}minx", F.array_min(xs))
        .withColumn(f"{prefix}miny", F.array_min(ys))
        .withColumn(f"{prefix}maxx", F.array_max(xs))
        .withColumn(f"{prefix}maxy", F.array_max(ys))
    )


def bounds_of(df: DataFrame, keys: Sequence[str], ring: str = "ring") -> DataFrame:
    """Bounding box per key over all its rings."""
    return (
        with_bounds(df, ring)
        .groupBy(*keys)
        .agg(
            F.min("minx").alias("minx"), F.min("miny").alias("miny"),
            F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"),
        )
    )


def _cells(df: DataFrame, side: str, cell: float) -> DataFrame:
    def span(low: str, high: str) -> Column:
        return F.sequence(
            F.floor(F.col(f"{side}{low}") / F.lit(cell)), F.floor(F.col(f"{side}{high}") / F.lit(cell))
        )

    return df.withColumn("_cx", F.explode(span("minx", "maxx"))).withColumn(
        "_cy", F.explode(span("miny", "maxy"))
    )


def box_candidates(
    a: DataFrame, b: DataFrame, cell: float, ring_a: str = "ring", ring_b: str = "ring", salts: int = 1
) -> DataFrame:
    """Pairs whose bounding boxes meet, each once.

    Columns of ``a`` come out with prefix ``a_`` and of ``b`` with ``b_``.
    A crowded cell is split by the adaptive skew join.  With ``salts`` the caller
    splits every cell instead; ``b`` is then copied once per salt.
    """
    left = with_bounds(a.select([F.col(c).alias(f"a_{c}") for c in a.columns]), f"a_{ring_a}", "_a_")
    right = with_bounds(b.select([F.col(c).alias(f"b_{c}") for c in b.columns]), f"b_{ring_b}", "_b_")
    left, right = _cells(left, "_a_", cell), _cells(right, "_b_", cell)
    on = ["_cx", "_cy"]
    if salts > 1:
        own = F.xxhash64(*[F.col(f"a_{c}") for c in a.columns if c != ring_a])
        left = left.withColumn("_salt", F.pmod(own, F.lit(salts)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = [*on, "_salt"]
    meet = (
        (F.col("_a_minx") <= F.col("_b_maxx"))
        & (F.col("_b_minx") <= F.col("_a_maxx"))
        & (F.col("_a_miny") <= F.col("_b_maxy"))
        & (F.col("_b_miny") <= F.col("_a_maxy"))
    )
    once = (
        F.floor(F.greatest("_a_minx", "_b_minx") / F.lit(cell)) == F.col("_cx")
    ) & (F.floor(F.greatest("_a_miny", "_b_miny") / F.lit(cell)) == F.col("_cy"))
    drop = [*on] + [f"_{s}_{e}" for s in "ab" for e in ("minx", "miny", "maxx", "maxy")]
    return left.join(right, on).where(meet & once).drop(*drop)


def intersecting(
    a: DataFrame, b: DataFrame, cell: float, ring_a: str = "ring", ring_b: str = "ring", salts: int = 1
) -> DataFrame:
    """Pairs of geometries that touch (borders included)."""
    ra, rb = F.col(f"a_{ring_a}"), F.col(f"b_{ring_b}")
    return box_candidates(a, b, cell, ring_a, ring_b, salts).where(
        rings_intersect(ra["x"], ra["y"], rb["x"], rb["y"])
    )


def acquisition_tiles(acqs: DataFrame, tiles: DataFrame, cell: float = 1.0) -> DataFrame:
    """Tiles met by each acquisition, one row per pair."""
    return intersecting(acqs, tiles, cell).select(
        F.col("a_product_id").alias("product_id"), F.col("b_tile_id").alias("tile_id")
    )


def overlap_area(
    a: DataFrame, tiles: DataFrame, keys_a: Sequence[str], cell: float, min_area: float = codes.MIN_OVERLAP_M2
) -> DataFrame:
    """Summed overlap per (keys of ``a``, tile); small sums are dropped.

    Tiles are convex, so the overlap is the ring clipped by the tile.
    """
    pairs = box_candidates(a, tiles, cell)
    # small in bytes, heavy per row: one input split must not become one task
    pairs = pairs.repartition(python_partitions(pairs), *[f"a_{k}" for k in keys_a], "b_tile_id", "a_ring")
    ra, rb = F.col("a_ring"), F.col("b_ring")
    return (
        pairs.withColumn("area", overlap_with_convex(ra["x"], ra["y"], rb["x"], rb["y"]))
        .groupBy(*[F.col(f"a_{k}").alias(k) for k in keys_a], F.col("b_tile_id").alias("tile_id"))
        .agg(F.sum("area").alias("area"))
        .where(F.col("area") >= min_area)
    )


def intersecting_query(df: DataFrame, polygon: Sequence[tuple[float, float]], ring: str = "ring") -> DataFrame:
    """Rows whose geometry meets one query polygon (box test first)."""
    xs = [float(p[0]) for p in polygon]
    ys = [float(p[1]) for p in polygon]
    near = with_bounds(df, ring, "_q_").where(
        (F.col("_q_minx") <= max(xs)) & (F.col("_q_maxx") >= min(xs))
        & (F.col("_q_miny") <= max(ys)) & (F.col("_q_maxy") >= min(ys))
    )
    qx = F.array(*[F.lit(x) for x in xs])
    qy = F.array(*[F.lit(y) for y in ys])
    return near.where(rings_intersect(F.col(ring)["x"], F.col(ring)["y"], qx, qy)).select(*df.columns)


def basin_tiles(basins: DataFrame, tiles: DataFrame, cell: float) -> DataFrame:
    """Tiles of each basin with the basin's bounds."""
    b = with_bounds(basins)
    return intersecting(b, tiles, cell).select(
        F.col("a_basin_name").alias("basin_name"),
        F.col("b_tile_id").alias("tile_id"),
        *[F.col(f"a_{e}").alias(e) for e in ("minx", "miny", "maxx", "maxy")],
    )


def exclude_crossing(
    tiles: DataFrame, lines: DataFrame, keys: Sequence[str], cell: float
) -> DataFrame:
    """Drop (keys, tile) rows whose tile is crossed by a border line of the key.

    ``tiles``: keys, tile_id, ring.  ``lines``: keys, ring of two points.  A key
    has a handful of tiles and lines, so the equi-join on the key is small.
    """
    l = lines.select(*keys, F.col("ring").alias("_line"))
    t = tiles.select(*keys, "tile_id", F.col("ring").alias("_ring"))
    crossed = (
        t.join(l, list(keys))
        .where(rings_intersect(F.col("_ring")["x"], F.col("_ring")["y"], F.col("_line")["x"], F.col("_line")["y"]))
        .select(*keys, "tile_id")
    )
    return tiles.join(crossed, [*keys, "tile_id"], "left_anti")


def border_lines(acqs: DataFrame, ring: str = "ring", direction: str = "orbit_dir") -> DataFrame:
    """First and last scan line of a radar slice from its footprint corners,
    with ``valid`` telling whether the corners come in the expected order."""
    pts = F.col(ring)

    def extreme(axis: str, largest: bool) -> Column:
        def keyed(p: Column, i: Column) -> Column:
            # of equal corners the first listed counts
            return F.struct(p[axis].alias("k"), (-i if largest else i).alias("i"), p.alias("p"))

        ordered = F.transform(pts, keyed)
        return (F.array_max(ordered) if largest else F.array_min(ordered))["p"]

    up = F.upper(F.col(direction)) == "ASCENDING"
    south, north = extreme("y", False), extreme("y", True)
    west, east = extreme("x", False), extreme("x", True)
    first_near, first_far = F.when(up, south).otherwise(east), F.when(up, east).otherwise(north)
    last_far, last_near = F.when(up, north).otherwise(west), F.when(up, west).otherwise(south)

    def rising(*v: Column) -> Column:
        return (v[0] <= v[1]) & (v[1] <= v[2]) & (v[2] <= v[3])

    lon_ok = F.when(
        up, rising(last_near["x"], first_near["x"], last_far["x"], last_far["x"])
    ).otherwise(rising(last_far["x"], first_far["x"], last_near["x"], first_near["x"]))
    lat_ok = F.when(
        up, rising(first_near["y"], first_far["y"], last_near["y"], last_far["y"])
    ).otherwise(rising(last_near["y"], last_far["y"], first_near["y"], first_far["y"]))
    return (
        acqs.withColumn("line_first", F.array(first_near, first_far))
        .withColumn("line_last", F.array(last_near, last_far))
        .withColumn("valid", lon_ok & lat_ok)
    )


def clip_to_tiles(polys: DataFrame, tiles: DataFrame, cell: float, outside: bool = False) -> DataFrame:
    """Parts of polygons inside each convex tile, or the tile area left over.

    The outside form gives, per tile, the area not covered by any polygon;
    polygons may overlap, what several of them cover counts once.  Its shape comes
    from :func:`shapes_of`.
    """
    if not outside:
        pairs = box_candidates(polys, tiles, cell)
        ra, rb = F.col("a_ring"), F.col("b_ring")
        clipped = pairs.withColumn("ring", clipped_ring(ra["x"], ra["y"], rb["x"], rb["y"]))
        return clipped.where(F.size("ring") >= 3).select(
            F.col("a_id").alias("id"), F.col("b_tile_id").alias("tile_id"), "ring"
        )
    covered = _covered_blocks(polys, tiles, cell).groupBy("tile_id").agg(F.sum("area").alias("_covered"))
    rt = F.col("ring")
    whole = overlap_with_convex(rt["x"], rt["y"], rt["x"], rt["y"])
    return (
        tiles.select("tile_id", whole.alias("_whole"))
        .join(covered, "tile_id", "left")
        .select("tile_id", (F.col("_whole") - F.coalesce("_covered", F.lit(0.0))).alias("area_outside"))
    )


#: Rings that a block takes in before the strip behind them is summed.
STRIP_RINGS = 500


def _covered_blocks(polys: DataFrame, tiles: DataFrame, cell: float) -> DataFrame:
    """Rows ``(tile_id, area)``: what all polygons together cover of each block, the
    part of a tile in one cell.  Equal rings are merged first; a block's rings
    arrive by their left end and leave behind the strip that is summed."""
    left = _cells(with_bounds(polys.select(F.col("ring").alias("a")), "a", "_a_"), "_a_", cell)
    right = _cells(with_bounds(tiles.select("tile_id", F.col("ring").alias("b")), "b", "_b_"), "_b_", cell)
    meet = (
        (F.col("_a_minx") < F.col("_b_maxx"))
        & (F.col("_b_minx") < F.col("_a_maxx"))
        & (F.col("_a_miny") < F.col("_b_maxy"))
        & (F.col("_b_miny") < F.col("_a_maxy"))
    )
    rows = left.join(right, ["_cx", "_cy"]).where(meet).select(
        "tile_id", "_cx", "_cy", F.col("_a_minx").alias("minx"), F.col("_a_maxx").alias("maxx"),
        F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"),
    ).distinct()

    def area(key: tuple, found):
        tile, cx, cy = key
        box = np.array([[cx, cy], [cx + 1, cy], [cx + 1, cy + 1], [cx, cy + 1]], float) * cell
        window, held, fresh, done, total = None, [], 0, -np.inf, 0.0
        for _, _, _, minx, maxx, ax, ay, bx, by in found:
            if window is None:
                window = clip_convex(np.column_stack([bx, by]), box)
                if len(window) < 3:
                    return
            if fresh >= STRIP_RINGS and minx > done:
                total += union_area([r for _, r in held], window, done, minx)
                held, fresh, done = [h for h in held if h[0] > minx], 0, minx
            held.append((maxx, np.column_stack([ax, ay])))
            fresh += 1
        yield tile, total + union_area([r for _, r in held], window, done)

    kind = tiles.schema["tile_id"].dataType.simpleString()
    return stream_groups(rows, ["tile_id", "_cx", "_cy"], ["minx"], f"tile_id {kind}, area double", area)


#: Rows of a cell that may meet in pairs; a cell with more on both sides is halved.
CELL_ROWS = 32
#: Times a cell is halved at most (what is still crowded then is met whole).
HALVINGS = 16


def _edges(ring: Column) -> Column:
    return F.arrays_zip(ring.alias("a"), F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)).alias("b"))


def _cross(e: Column, x: Column, y: Column) -> Column:
    a, b = e["a"], e["b"]
    return (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])


def _odd(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd rule, borders aside."""
    def crosses(e: Column) -> Column:
        up = e["b"]["y"] > e["a"]["y"]
        return ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & F.when(up, _cross(e, x, y) > 0).otherwise(_cross(e, x, y) < 0)

    return F.size(F.filter(_edges(ring), crosses)) % 2 == 1


def _holds(ring: Column, x: Column, y: Column) -> Column:
    """:func:`firnline.functions.geometry.inside` of one point, border included."""
    def on(e: Column) -> Column:
        (ax, bx), (ay, by) = ((e["a"][c], e["b"][c]) for c in "xy")
        return (x >= F.least(ax, bx)) & (x <= F.greatest(ax, bx)) & (y >= F.least(ay, by)) & (y <= F.greatest(ay, by)) & (_cross(e, x, y) == 0)

    return (F.size(ring) >= 3) & (F.exists(_edges(ring), on) | _odd(ring, x, y))


def _covers(ring: Column, bounds: str, cx: str, cy: str, size: float) -> Column:
    """Whether the ring covers a whole cell: no edge passes its inside, and its centre
    is in the ring."""
    x0, y0, x1, y1 = (((F.col(c) + d) * F.lit(size)) for c, d in ((cx, 0), (cy, 0), (cx, 1), (cy, 1)))
    spans = (F.col(f"{bounds}minx") <= x0) & (F.col(f"{bounds}maxx") >= x1) & (F.col(f"{bounds}miny") <= y0) & (F.col(f"{bounds}maxy") >= y1)

    def clear(e: Column) -> Column:
        (ax, bx), (ay, by) = ((e["a"][c], e["b"][c]) for c in "xy")
        away = (F.greatest(ax, bx) <= x0) | (F.least(ax, bx) >= x1) | (F.greatest(ay, by) <= y0) | (F.least(ay, by) >= y1)
        corners = [_cross(e, x, y) for x in (x0, x1) for y in (y0, y1)]
        return away | (F.least(*corners) >= 0) | (F.greatest(*corners) <= 0)

    return F.coalesce(
        spans & (F.size(ring) >= 3) & F.forall(_edges(ring), clear) & _odd(ring, (x0 + x1) / 2, (y0 + y1) / 2), F.lit(False)
    )


def _halved(near: DataFrame, bounds: str, cx: str, cy: str, size: float) -> DataFrame:
    """Rows of cells dealt to the cells of half the size, ``size``, that they meet."""
    for c, axis in ((cx, "x"), (cy, "y")):
        low = F.greatest(F.col(c) * 2, F.floor(F.col(f"{bounds}min{axis}") / F.lit(size)))
        high = F.least(F.col(c) * 2 + 1, F.floor(F.col(f"{bounds}max{axis}") / F.lit(size)))
        near = near.withColumns({"_low": low, "_high": high}).where("_low <= _high").withColumn(c, F.explode(F.sequence("_low", "_high")))
    return near.drop("_low", "_high")


def _leaves(near: DataFrame, cell: float) -> tuple[DataFrame | None, DataFrame]:
    """Cells halved until each has ``STRIP_RINGS`` rings or is covered by one.

    ``near``: ``_cx, _cy``, ring ``a`` and its bounds.  Gives the small cells of those
    that were halved (``_cx, _cy, lx, ly, size``, with or without rings) and the rings
    of all cells (``lx, ly, size``, ring and bounds); a covered cell has its own border
    as only ring.
    """
    key = ["_cx", "_cy", "lx", "ly"]
    at = cut_lineage(near.withColumns({"lx": F.col("_cx"), "ly": F.col("_cy")}))
    size, kids, leaves, rings = float(cell), None, [], []
    for depth in range(HALVINGS + 1):
        load = cut_lineage(at.groupBy(*key).agg(F.count("*").alias("n"), F.bool_or(_covers(F.col("a"), "_a_", "lx", "ly", size)).alias("full")))
        crowded = load.where((F.col("n") > STRIP_RINGS) & ~F.col("full") if depth < HALVINGS else F.lit(False)).select(*key)
        x, y = F.col("lx") * F.lit(size), F.col("ly") * F.lit(size)
        x1, y1 = (F.col("lx") + 1) * F.lit(size), (F.col("ly") + 1) * F.lit(size)
        border = with_bounds(load.where("full").select(*key, box_ring(x, y, x1, y1).alias("a")), "a", "_a_").select(*at.columns)
        some = at.join(load.where("not full").select(*key).hint("merge"), key, "left_semi").join(crowded.hint("merge"), key, "left_anti").select(*at.columns)
        rings.append(border.unionByName(some).withColumn("size", F.lit(size)))
        if kids is not None:
            leaves.append(kids.join(crowded.hint("merge"), key, "left_anti").select(*key, F.lit(size).alias("size")))
        if crowded.isEmpty():
            break
        size /= 2
        two = lambda c: F.explode(F.array(F.col(c) * 2, F.col(c) * 2 + 1))
        kids = crowded.withColumn("lx", two("lx")).withColumn("ly", two("ly")).select(*key)
        at = cut_lineage(_halved(at.join(crowded.hint("merge"), key, "left_semi").select(*at.columns), "_a_", "lx", "ly", size))
    every = rings[0]
    for r in rings[1:]:
        every = every.unionByName(r)
    halved = None
    for r in leaves:
        halved = r if halved is None else halved.unionByName(r)
    return halved, every.drop("_cx", "_cy")


def shapes_of(
    polys: DataFrame, tiles: DataFrame, cell: float, outside: bool = False
) -> DataFrame:
    """What all polygons together cover of each convex tile, or leave uncovered, as
    rings: ``tile_id, cx, cy, hole, ring``.

    Shapes are cut at the cells, and at smaller ones where a cell is crowded, so a
    task takes in ``STRIP_RINGS`` polygons at once; equal rings are merged first.
    Outer rings run against the clock, holes with it, and a point is inside a shape
    if it is inside an odd number of its block's rings.  A cell larger than a tile
    keeps the tile in one piece unless it is crowded.
    """
    near = _cells(with_bounds(polys.select(F.col("ring").alias("a")).distinct(), "a", "_a_"), "_a_", cell)
    blocks = _cells(with_bounds(tiles.select("tile_id", F.col("ring").alias("b")).distinct(), "b", "_b_"), "_b_", cell)
    kind = tiles.schema["tile_id"].dataType.simpleString()
    # polygons away from all tiles are not looked at
    met = blocks.select("_cx", "_cy").distinct().hint("merge")
    halved, rings = _leaves(near.join(met, ["_cx", "_cy"], "left_semi").select(*near.columns), cell)
    if halved is None:
        own = blocks.withColumns({"lx": F.col("_cx"), "ly": F.col("_cy"), "size": F.lit(float(cell))})
    else:
        own = blocks.join(halved.hint("merge"), ["_cx", "_cy"], "left").withColumns(
            {"lx": F.coalesce("lx", "_cx"), "ly": F.coalesce("ly", "_cy"), "size": F.coalesce("size", F.lit(float(cell)))}
        )
    # a tile only touches a block that it has no area in
    low, high = (lambda c: F.col(c) * F.col("size")), (lambda c: (F.col(c) + 1) * F.col("size"))
    own = own.where(
        (F.col("_b_maxx") > low("lx")) & (F.col("_b_minx") < high("lx")) & (F.col("_b_maxy") > low("ly")) & (F.col("_b_miny") < high("ly"))
    )
    found = rings.select(
        F.col("lx").alias("_lx"), F.col("ly").alias("_ly"), F.col("size").alias("_size"),
        F.col("a.x").alias("x"), F.col("a.y").alias("y"), "_a_minx", "_a_maxx", "_a_miny", "_a_maxy",
    )
    meet = (
        (F.col("_lx") == F.col("lx")) & (F.col("_ly") == F.col("ly")) & (F.col("_size") == F.col("size"))
        & (F.col("_a_minx") < F.col("_b_maxx")) & (F.col("_b_minx") < F.col("_a_maxx"))
        & (F.col("_a_miny") < F.col("_b_maxy")) & (F.col("_b_miny") < F.col("_a_maxy"))
    )
    key = ["tile_id", "_cx", "_cy", "lx", "ly", "size"]
    pairs = own.join(found.hint("merge"), meet, "left").select(*key, "x", "y", F.col("b.x").alias("bx"), F.col("b.y").alias("by"))

    def rings_of(group, found):
        tile, cx, cy, lx, ly, size = group
        window, held = None, []
        for *_, x, y, bx, by in found:
            if window is None:
                box = np.array([[lx, ly], [lx + 1, ly], [lx + 1, ly + 1], [lx, ly + 1]], float) * size
                window = clip_convex(np.column_stack([bx, by]), box)
                if len(window) < 3 or abs(signed_area(window)) == 0:
                    return
            if x is not None:
                held.append(np.column_stack([x, y]))
        # most blocks of many tiles meet no polygon: all of the window is left over
        made = Sweep(held, window).rings(outside) if held else [against_clock(window)] * outside
        for r in made:
            yield tile, cx, cy, signed_area(r) < 0, [{"x": float(u), "y": float(v)} for u, v in r]

    return stream_groups(pairs, key, ["x"], f"tile_id {kind}, cx long, cy long, hole boolean, ring array<struct<x:double,y:double>>", rings_of)


def points_in_shapes(points: DataFrame, shapes: DataFrame, cell: float) -> DataFrame:
    """``points`` (``id, x, y``) with ``inside``: whether some block of
    :func:`shapes_of` made with the same ``cell`` holds the point (borders aside)."""
    at = points.withColumns({"cx": F.floor(F.col("x") / F.lit(cell)), "cy": F.floor(F.col("y") / F.lit(cell))})
    r, x, y = F.col("ring"), F.col("x"), F.col("y")
    edges = F.arrays_zip(r.alias("a"), F.concat(F.slice(r, 2, F.size(r)), F.slice(r, 1, 1)).alias("b"))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"]))

    # by a shuffle: both sides grow with the tables, and what Spark guesses of their size
    # from the files would let it send all points to every task
    hits = (
        at.join(shapes.hint("merge"), ["cx", "cy"]).groupBy("id", "tile_id")
        .agg((F.sum(F.size(F.filter(edges, crosses))) % 2 == 1).alias("_in")).where("_in").select("id", F.lit(True).alias("_in")).distinct()
    )
    return points.join(hits.hint("merge"), "id", "left").select(*points.columns, F.coalesce("_in", F.lit(False)).alias("inside"))


# --- grids -------------------------------------------------------------------------
def burn(polys: DataFrame, grid: DataFrame, cell: float) -> DataFrame:
    """Pixels (centres) covered by any polygon, as rows with value 1; a centre on
    a border counts as covered.

    ``grid``: ``tile_id, ulx, uly, size, nrows, ncols``.  Rings become edges, edges
    their crossings with the lines of pixel centres; the sorted crossings of one
    polygon and line are its even-odd spans.  Memory goes with the crossings of one
    line, however many corners a ring has.
    """
    g = grid.withColumn(
        "ring",
        box_ring(
            F.col("ulx"), F.col("uly") - F.col("nrows") * F.col("size"),
            F.col("ulx") + F.col("ncols") * F.col("size"), F.col("uly"),
        ),
    )
    pairs = box_candidates(polys.select("ring"), g, cell).select(
        F.monotonically_increasing_id().alias("pair"), F.col("a_ring").alias("ring"),
        *[F.col(f"b_{c}").alias(c) for c in ("tile_id", "nrows", "ncols")],
        *[F.col(f"b_{c}").cast("double").alias(c) for c in ("ulx", "uly", "size")],
    )
    ring = F.col("ring")
    edges = F.arrays_zip(ring.alias("a"), F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)).alias("b"))
    edge = pairs.where(F.size("ring") > 2).withColumn("e", F.explode(edges)).select(
        "*", *[F.col(f"e.{p}.{c}").alias(f"{p}{c}") for p in "ab" for c in "xy"]
    ).drop("ring", "e")
    low, high = F.least("ay", "by"), F.greatest("ay", "by")

    def line(y: Column) -> Column:
        """Line of centres at a height, with fractions."""
        return (F.col("uly") - y) / F.col("size") - F.lit(0.5)

    first, last = F.greatest(F.lit(0), F.ceil(line(high))), F.least(F.col("nrows") - 1, F.floor(line(low)))
    crossed = (
        edge.withColumns({"low": low, "high": high, "first": first, "last": last}).where("first <= last")
        .repartition("pair", "ax", "ay", "bx", "by")  # a ring's edges leave its task before they become lines
        .withColumn("row", F.explode(F.sequence("first", "last")))
        .withColumn("y", F.col("uly") - (F.col("row") + F.lit(0.5)) * F.col("size"))
    )
    x = F.col("ax") + (F.col("y") - F.col("ay")) * (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))
    flat, top = F.col("low") == F.col("high"), F.col("y") == F.col("high")
    # borders that no span holds: flat edges, and ends of edges on a line from below
    touch = F.when(flat, F.struct(F.least("ax", "bx").alias("from"), F.greatest("ax", "bx").alias("to"))).when(
        top, F.struct(F.when(F.col("ay") == F.col("high"), F.col("ax")).otherwise(F.col("bx")).alias("from"),
                      F.when(F.col("ay") == F.col("high"), F.col("ax")).otherwise(F.col("bx")).alias("to")))
    lines = crossed.groupBy("pair", "tile_id", "ulx", "size", "ncols", "row").agg(
        F.sort_array(F.collect_list(F.when(~flat & ~top, x))).alias("x"), F.collect_set(touch).alias("touch")
    )
    spans = F.transform(
        F.filter("x", lambda _, i: i % 2 == 0),
        lambda v, i: F.struct(v.alias("from"), F.get("x", 2 * i + 1).alias("to")),
    )

    def column(v: Column) -> Column:
        return (v - F.col("ulx")) / F.col("size") - F.lit(0.5)

    covered = lines.withColumn("s", F.explode(F.concat(spans, "touch"))).withColumns({
        "c0": F.greatest(F.lit(0), F.ceil(column(F.col("s.from")))), "c1": F.least(F.col("ncols") - 1, F.floor(column(F.col("s.to")))),
    })
    return (
        covered.where("c0 <= c1").select("tile_id", F.col("row").cast("int").alias("row"), F.explode(F.sequence(F.col("c0").cast("int"), F.col("c1").cast("int"))).alias("col"))
        .distinct().withColumn("value", F.lit(1))
    )


def points_in_polygons(points: DataFrame, polys: DataFrame, cell: float) -> DataFrame:
    """Whether each point lies in any polygon (land test).

    A cell that some polygon covers decides all its points; one with few points or
    few polygons tests them in pairs; the others are halved.  So the pairs grow with
    the rows, not with their product.
    """
    spots = points.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL").distinct()
    size, found, key = float(cell), [], ["_cx", "_cy"]

    def placed(some: DataFrame) -> DataFrame:
        return cut_lineage(some.withColumns({"_cx": F.floor(F.col("x") / F.lit(size)), "_cy": F.floor(F.col("y") / F.lit(size))}))

    spots = placed(spots)
    near = _cells(with_bounds(polys.select(F.col("ring").alias("a")).distinct(), "a", "_a_"), "_a_", cell)
    near = cut_lineage(near.join(spots.select(*key).distinct(), key, "left_semi").select(*near.columns))
    for depth in range(HALVINGS + 1):
        load = cut_lineage(
            near.groupBy(*key).agg(F.count("*").alias("n"), F.bool_or(_covers(F.col("a"), "_a_", "_cx", "_cy", size)).alias("full"))
            .join(spots.groupBy(*key).agg(F.count("*").alias("m")), key)
        )
        few = F.least("n", "m") <= CELL_ROWS if depth < HALVINGS else F.lit(True)
        found.append(spots.join(load.where("full").select(*key), key, "left_semi").select("x", "y"))
        pairs = spots.join(load.where(~F.col("full") & few).select(*key), key, "left_semi").join(near, key)
        x, y = F.col("x"), F.col("y")
        boxed = x.between(F.col("_a_minx"), F.col("_a_maxx")) & y.between(F.col("_a_miny"), F.col("_a_maxy"))
        found.append(pairs.where(boxed & _holds(F.col("a"), x, y)).select("x", "y").distinct())
        crowded = load.where(~F.col("full") & ~few).select(*key)
        if crowded.isEmpty():
            break
        size /= 2
        near = cut_lineage(_halved(near.join(crowded, key, "left_semi").select(*near.columns), "_a_", "_cx", "_cy", size))
        spots = placed(spots.join(crowded, key, "left_semi").select("x", "y"))
    hits = found[0]
    for f in found[1:]:
        hits = hits.unionByName(f)
    # a repeated id is inside with any of its points
    at = points.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    ids = at.join(hits, ["x", "y"], "left_semi").select("id").distinct()
    return points.join(ids.withColumn("_hit", F.lit(True)), "id", "left").select(
        *points.columns, F.coalesce("_hit", F.lit(False)).alias("inside")
    )


# --- hulls --------------------------------------------------------------------------
def valid_footprint(
    px: DataFrame, extents: DataFrame, keys: Sequence[str] = ("product_id",), nodata: int = codes.NODATA
) -> DataFrame:
    """Hull (pixel indices) of the valid pixels of each product.

    The extreme columns of each row are found by an aggregate, so a task gathers
    two points per raster row at most.  No valid pixel gives the whole extent; a
    point or a line gives a rectangle one pixel larger.  ``extents``: keys,
    ``nrows, ncols``.
    """
    rows = (
        px.where(F.col("value") != nodata)
        .groupBy(*keys, "row")
        .agg(F.min("col").alias("first"), F.max("col").alias("last"))
    )
    joined = extents.select(*keys, "nrows", "ncols").join(rows, list(keys), "left")
    names = list(keys)

    def hull(pdf: pd.DataFrame) -> pd.DataFrame:
        nrows, ncols = int(pdf.nrows.iloc[0]), int(pdf.ncols.iloc[0])
        seen = pdf.dropna(subset=["row"])
        if len(seen) == 0:
            ring = np.array([[0, 0], [ncols - 1, 0], [ncols - 1, nrows - 1], [0, nrows - 1]], float)
        else:
            pts = np.concatenate(
                [seen[["first", "row"]].to_numpy(float), seen[["last", "row"]].to_numpy(float)]
            )
            ring = convex_hull(pts)
            if len(ring) < 3:
                low, high = pts.min(axis=0), pts.max(axis=0)
                low = np.where(low == 0, 1, low)
                top = np.array([ncols - 1, nrows - 1], float)
                high = np.where(high == top, top - 1, high)
                (x0, y0), (x1, y1) = low - 1, high + 1
                ring = np.array([[x0, y0], [x1, y0], [x1, y1], [x0, y1]])
        out = {k: [pdf[k].iloc[0]] for k in names}
        out["ring"] = [[{"x": float(x), "y": float(y)} for x, y in ring]]
        return pd.DataFrame(out)

    types = ", ".join(f"{k} {extents.schema[k].dataType.simpleString()}" for k in names)
    return joined.groupBy(*names).applyInPandas(hull, f"{types}, ring array<struct<x:double,y:double>>")


def aoi_cover(tiles: DataFrame, step: float = 1.0, split: float = 5.0) -> DataFrame:
    """Cover of the area: grid cells met by any tile; cells that share a side form
    a part, and each part is replaced by its convex hull inside each coarse cell
    (the hull contains every met cell, so every tile).

    Rows ``part, sx, sy, n_cells, ring``.  ``part`` numbers a part by its least
    cell; the coarse grid starts at the lower left corner of the area's box, which
    is rounded to whole cells.  Cells are distinct, so a coarse cell gathers
    ``(split/step)**2`` of them at most.
    """
    cells = with_bounds(tiles, "ring", "_")
    grid = (
        cells.withColumn("cx", F.explode(F.sequence(F.floor(F.col("_minx") / step), F.ceil(F.col("_maxx") / step) - 1)))
        .withColumn("cy", F.explode(F.sequence(F.floor(F.col("_miny") / step), F.ceil(F.col("_maxy") / step) - 1)))
    )
    box = box_ring(F.col("cx") * step, F.col("cy") * step, (F.col("cx") + 1) * step, (F.col("cy") + 1) * step)
    grid = grid.withColumn("_box", box)
    # a cell's name orders cells by column, then by row
    name = F.col("cx") * F.lit(1 << 31) + F.col("cy")
    met = cut_lineage(
        grid.where(rings_intersect(F.col("ring")["x"], F.col("ring")["y"], F.col("_box")["x"], F.col("_box")["y"]))
        .select("cx", "cy").distinct().withColumn("cell", name)
    )
    ways = met.select(F.col("cell").alias("a"), F.explode(F.array(F.col("cell") + 1, F.col("cell") + F.lit(1 << 31))).alias("b"))
    sides = ways.join(met.select(F.col("cell").alias("b")), "b").select("a", "b")
    part = components(met.select(F.col("cell").alias("node")), sides).select(F.col("node").alias("cell"), F.col("label").alias("part"))
    corner = met.agg(F.min("cx").alias("x0"), F.min("cy").alias("y0"))
    coarse = met.join(part, "cell").join(F.broadcast(corner)).select(
        "part", "cx", "cy",
        F.floor((F.col("cx") - F.col("x0")) * step / split).alias("sx"), F.floor((F.col("cy") - F.col("y0")) * step / split).alias("sy"),
    )

    def hull(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf.cx.to_numpy(float) * step, pdf.cy.to_numpy(float) * step
        pts = np.concatenate([np.column_stack([x + dx, y + dy]) for dx in (0, step) for dy in (0, step)])
        ring = convex_hull(pts)
        return pd.DataFrame(
            {
                "part": [int(pdf.part.iloc[0])], "sx": [int(pdf.sx.iloc[0])], "sy": [int(pdf.sy.iloc[0])], "n_cells": [len(pdf)],
                "ring": [[{"x": float(a), "y": float(b)} for a, b in ring]],
            }
        )

    return coarse.groupBy("part", "sx", "sy").applyInPandas(
        hull, "part long, sx long, sy long, n_cells long, ring array<struct<x:double,y:double>>"
    )


# --- reprojection ----------------------------------------------------------------------
def tile_ring_lonlat(tiles: DataFrame, points_per_edge: int = 1) -> DataFrame:
    """Tile outline of a UTM grid as a densified ring in degrees."""
    ring = utm_box_ring(points_per_edge, laea=False)
    return tiles.withColumn("ring", ring("ulx", "uly", "lrx", "lry", "epsg"))


def tile_ring_laea(tiles: DataFrame, points_per_edge: int = 1) -> DataFrame:
    """The same outline on the European equal-area grid."""
    ring = utm_box_ring(points_per_edge, laea=True)
    return tiles.withColumn("ring", ring("ulx", "uly", "lrx", "lry", "epsg"))


def target_sources(targets: DataFrame, sources: DataFrame, cell: float = 200_000.0, points_per_edge: int = 10) -> DataFrame:
    """Source tiles (UTM) meeting each equal-area target.

    ``targets``: ``target_id`` and a LAEA ``ring``; ``sources``: tile grid.
    """
    s = tile_ring_laea(sources, points_per_edge).select("tile_id", "epsg", "ulx", "uly", "lrx", "lry", "ring")
    return intersecting(targets.select("target_id", "ring"), s, cell).select(
        F.col("a_target_id").alias("target_id"), F.col("b_tile_id").alias("tile_id"),
        *[F.col(f"b_{c}").alias(c) for c in ("epsg", "ulx", "uly", "lrx", "lry")],
    )


def target_pixels(targets: DataFrame, size: float) -> DataFrame:
    """Pixel centres of equal-area grids; the other columns are kept.

    ``targets``: ``target_id, t_ulx, t_uly`` or ``ulx, uly``, with ``nrows,
    ncols``.  Grid rows are spread over the tasks before columns are added.
    """
    ulx, uly = (f"t_{c}" if f"t_{c}" in targets.columns else c for c in ("ulx", "uly"))
    lines = targets.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("nrows") - 1)))
    lines = lines.repartition(python_partitions(targets), "target_id", "row")
    cells = lines.withColumn("col", F.explode(F.sequence(F.lit(0), F.col("ncols") - 1)))
    centre = P.pixel_centre(F.col("row"), F.col("col"), F.col(ulx), F.col(uly), F.lit(float(size)))
    return cells.withColumn("x", centre["x"]).withColumn("y", centre["y"]).drop("nrows", "ncols", "ring")


def regrid_nearest(
    targets: DataFrame, source_pixels: DataFrame, pairs: DataFrame, source_size: float, target_size: float
) -> DataFrame:
    """Nearest source pixel of each target pixel centre.

    ``targets``: ``target_id, ulx, uly, nrows, ncols``; ``pairs``: output of
    :func:`target_sources`.  The small pair table is joined first; one grid line
    at a time is then projected as an array, so the only large shuffle is the one
    on the source pixel.
    """
    grids = targets.select(
        "target_id", F.col("ulx").alias("t_ulx"), F.col("uly").alias("t_uly"), "nrows", "ncols"
    )
    lines = (
        pairs.join(grids, "target_id")
        .withColumn("target_row", F.explode(F.sequence(F.lit(0), F.col("nrows") - 1)))
        .repartition(python_partitions(targets), "target_id", "tile_id", "target_row")
    )

    def project(batches):
        for pdf in batches:
            made = []
            for t in pdf.itertuples(index=False):
                col = np.arange(t.ncols)
                lon, lat = P.laea_inverse(
                    np, t.t_ulx + (col + 0.5) * target_size, np.full(t.ncols, t.t_uly - (t.target_row + 0.5) * target_size)
                )
                x, y = P.utm_forward(np, lon, lat, t.epsg)
                ok = (x >= t.ulx) & (x < t.lrx) & (y <= t.uly) & (y > t.lry)
                n = int(ok.sum())
                if n:
                    made.append(
                        pd.DataFrame(
                            {
                                "target_id": [t.target_id] * n, "tile_id": [t.tile_id] * n,
                                "target_row": np.full(n, t.target_row), "target_col": col[ok],
                                "row": np.floor((t.uly - y[ok]) / source_size).astype("int32"),
                                "col": np.floor((x[ok] - t.ulx) / source_size).astype("int32"),
                            }
                        )
                    )
            if made:
                yield pd.concat(made, ignore_index=True)

    kind = {c: pairs.schema[c].dataType.simpleString() for c in ("target_id", "tile_id")}
    schema = (
        f"target_id {kind['target_id']}, tile_id {kind['tile_id']}, target_row int, target_col int, row int, col int"
    )
    return lines.mapInPandas(project, schema).join(source_pixels, ["tile_id", "row", "col"])
