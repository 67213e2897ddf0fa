"""Exact polygon tests on coordinate arrays, used inside Arrow tasks.

Rings are lists of x and y without the repeated closing point.  A ring of two
points is a line.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firnline.functions import projections
from firnline.schemas import RING


def _points(xs, ys) -> np.ndarray:
    pts = np.column_stack([np.asarray(xs, float), np.asarray(ys, float)])
    if len(pts) > 3 and np.array_equal(pts[0], pts[-1]):
        pts = pts[:-1]
    return pts


def inside(points: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """Which points lie in the ring; its border counts as inside.

    Shapes ``(..., p, 2)`` and ``(..., r, 2)`` with equal leading dimensions, so
    one call serves a single ring or a whole batch of rings.
    """
    if ring.shape[-2] < 3:
        return np.zeros(points.shape[:-1], bool)
    a, b = ring[..., None, :, :], np.roll(ring, -1, axis=-2)[..., None, :, :]
    px, py = points[..., :, None, 0], points[..., :, None, 1]
    ax, ay, bx, by = a[..., 0], a[..., 1], b[..., 0], b[..., 1]
    cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
    between = (
        (px >= np.minimum(ax, bx)) & (px <= np.maximum(ax, bx)) & (py >= np.minimum(ay, by)) & (py <= np.maximum(ay, by))
    )
    on_border = ((cross == 0) & between).any(axis=-1)
    spans = (ay > py) != (by > py)
    to_right = np.where(by > ay, cross > 0, cross < 0)
    return on_border | ((spans & to_right).sum(axis=-1) % 2 == 1)


def segments_cross(p: np.ndarray, q: np.ndarray, closed_p: bool, closed_q: bool) -> np.ndarray:
    """Whether any segment of one chain touches a segment of the other (batched
    like :func:`inside`)."""
    a, b = (p, np.roll(p, -1, axis=-2)) if closed_p else (p[..., :-1, :], p[..., 1:, :])
    c, d = (q, np.roll(q, -1, axis=-2)) if closed_q else (q[..., :-1, :], q[..., 1:, :])

    def side(o, s, t):
        return np.sign(
            (s[..., 0] - o[..., 0]) * (t[..., 1] - o[..., 1])
            - (s[..., 1] - o[..., 1]) * (t[..., 0] - o[..., 0])
        )

    a, b = a[..., :, None, :], b[..., :, None, :]
    c, d = c[..., None, :, :], d[..., None, :, :]
    s1, s2 = side(a, b, c), side(a, b, d)
    s3, s4 = side(c, d, a), side(c, d, b)
    overlap = (
        (np.minimum(a, b) <= np.maximum(c, d)) & (np.minimum(c, d) <= np.maximum(a, b))
    ).all(axis=-1)
    return ((s1 * s2 <= 0) & (s3 * s4 <= 0) & overlap).any(axis=(-2, -1))


def touches(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether two geometries share a point (batched)."""
    crossing = segments_cross(p, q, p.shape[-2] > 2, q.shape[-2] > 2)
    return crossing | inside(p[..., :1, :], q)[..., 0] | inside(q[..., :1, :], p)[..., 0]


#: Pairs of corners or edges compared at once.
COMPARED = 1 << 20


def touch_of_large(p: np.ndarray, q: np.ndarray) -> bool:
    """:func:`touches` for two rings whose edge pairs are too many for one array:
    only edges inside the other's box are compared, in portions along x."""
    def edges(r: np.ndarray, other: np.ndarray) -> np.ndarray:
        e = np.stack([r, np.roll(r, -1, axis=0)], axis=1)[: len(r) if len(r) > 2 else len(r) - 1]
        low, high = other.min(axis=0), other.max(axis=0)
        e = e[((e.min(axis=1) <= high) & (e.max(axis=1) >= low)).all(axis=1)]
        return e[np.argsort(e[:, :, 0].min(axis=1))]

    a, b = edges(p, q), edges(q, p)
    begins, ends = b[:, :, 0].min(axis=1), np.maximum.accumulate(b[:, :, 0].max(axis=1)) if len(b) else b[:, 0, 0]
    step = max(1, COMPARED // max(1, min(len(b), COMPARED)))
    for i in range(0, len(a), step):
        part = a[i : i + step]
        lo = np.searchsorted(ends, part[:, :, 0].min(), "left")
        hi = np.searchsorted(begins, part[:, :, 0].max(), "right")
        for j in range(lo, hi, COMPARED):
            other = b[j : min(hi, j + COMPARED)]
            if segments_cross(np.repeat(part, len(other), axis=0), np.tile(other, (len(part), 1, 1)), False, False).any():
                return True
    return any(
        len(r) > 2 and _in_portions(one, r)
        for one, r in ((p[0], q), (q[0], p))
    )


def _in_portions(point: np.ndarray, ring: np.ndarray) -> bool:
    """:func:`inside` for one point; a ring's edges are counted in portions."""
    a, b = ring, np.roll(ring, -1, axis=0)
    odd = False
    for i in range(0, len(ring), COMPARED):
        (ax, ay), (bx, by) = a[i : i + COMPARED].T, b[i : i + COMPARED].T
        cross = (bx - ax) * (point[1] - ay) - (by - ay) * (point[0] - ax)
        within = (np.minimum(ax, bx) <= point[0]) & (point[0] <= np.maximum(ax, bx)) & (np.minimum(ay, by) <= point[1]) & (point[1] <= np.maximum(ay, by))
        if ((cross == 0) & within).any():
            return True
        odd ^= bool((((ay > point[1]) != (by > point[1])) & np.where(by > ay, cross > 0, cross < 0)).sum() % 2)
    return odd


def _batches(ax: pd.Series, ay: pd.Series, bx: pd.Series, by: pd.Series):
    """Row numbers and stacked rings of rows with equal vertex counts; together they
    have at most ``COMPARED`` pairs of corners, or there is one row."""
    rings_a = [_points(x, y) for x, y in zip(ax, ay)]
    rings_b = [_points(x, y) for x, y in zip(bx, by)]
    groups: dict[tuple[int, int], list[int]] = {}
    for i, (a, b) in enumerate(zip(rings_a, rings_b)):
        groups.setdefault((len(a), len(b)), []).append(i)
    for (n, m), rows in groups.items():
        step = max(1, COMPARED // max(1, n * m))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            yield np.array(some), np.stack([rings_a[i] for i in some]), np.stack([rings_b[i] for i in some])


def clip_convex(subject: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Part of ``subject`` within a convex window."""
    area2 = np.sum(window[:, 0] * np.roll(window[:, 1], -1) - np.roll(window[:, 0], -1) * window[:, 1])
    win = window if area2 > 0 else window[::-1]
    out = subject
    for a, b in zip(win, np.roll(win, -1, axis=0)):
        if len(out) == 0:
            break
        dist = (b[0] - a[0]) * (out[:, 1] - a[1]) - (b[1] - a[1]) * (out[:, 0] - a[0])
        kept = []
        for i in range(len(out)):
            j = (i + 1) % len(out)
            if dist[i] >= 0:
                kept.append(out[i])
            if (dist[i] > 0 > dist[j]) or (dist[i] < 0 < dist[j]):
                kept.append(out[i] + (out[j] - out[i]) * dist[i] / (dist[i] - dist[j]))
        out = np.array(kept).reshape(-1, 2)
    return out


def ring_area(ring: np.ndarray) -> np.ndarray:
    """Area of one ring or of a batch of rings."""
    if ring.shape[-2] < 3:
        return np.zeros(ring.shape[:-2])
    x, y = ring[..., 0] - ring[..., :1, 0], ring[..., 1] - ring[..., :1, 1]
    return np.abs(np.sum(x * np.roll(y, -1, axis=-1) - np.roll(x, -1, axis=-1) * y, axis=-1)) / 2


class Sweep:
    """Rings, overlapping or not, over a convex window: cut at every corner and
    crossing into strips in which no two edges cross.

    Edges enter a list by their left end and leave it by their right one; an edge
    is compared with those in the list, a strip looks at those alone.
    """

    def __init__(self, rings: list[np.ndarray], window: np.ndarray, low: float = -np.inf, high: float = np.inf):
        self.low, self.high = max(low, window[:, 0].min()), min(high, window[:, 0].max())
        every = [window, *rings]
        a, b = np.concatenate(every), np.concatenate([np.roll(r, -1, axis=0) for r in every])
        owner = np.repeat(np.arange(len(every)), [len(r) for r in every])
        self.corners = a[:, 0]
        slanted = a[:, 0] != b[:, 0]
        a, b, owner = a[slanted], b[slanted], owner[slanted]
        back = a[:, 0] > b[:, 0]
        a[back], b[back] = b[back], a[back].copy()
        order = np.argsort(a[:, 0], kind="stable")
        self.a, self.b, self.owner = a[order], b[order], owner[order]
        self.slope = (self.b[:, 1] - self.a[:, 1]) / (self.b[:, 0] - self.a[:, 0])

    def y(self, edge: np.ndarray, x: float) -> np.ndarray:
        """Height of edges at ``x``, exact at their ends."""
        (ax, ay), (bx, by) = self.a[edge].T, self.b[edge].T
        return np.where(x == bx, by, np.where(x == ax, ay, ay + self.slope[edge] * (x - ax)))

    def cuts(self) -> np.ndarray:
        base = self.a[:, 1] - self.slope * self.a[:, 0]
        active, found = np.zeros(0, int), [self.corners, [self.low, self.high]]
        for i in range(len(self.a)):
            active = active[self.b[active, 0] > self.a[i, 0]]
            others = active[self.slope[active] != self.slope[i]]
            x = (base[others] - base[i]) / (self.slope[i] - self.slope[others])
            found.append(x[(x > self.a[i, 0]) & (x < self.b[i, 0]) & (x > self.a[others, 0]) & (x < self.b[others, 0])])
            active = np.append(active, i)
        xs = np.unique(np.concatenate(found))
        return xs[(xs >= self.low) & (xs <= self.high)]

    def strips(self, outside: bool):
        """``(x0, x1, lower edges, upper edges)`` of each strip: the spans of the
        window that some ring covers, or that none does."""
        if self.low >= self.high:
            return
        xs = self.cuts()
        active, entered = np.zeros(0, int), 0
        for x0, x1 in zip(xs[:-1], xs[1:]):
            upto = int(np.searchsorted(self.a[:, 0], x0, side="right"))
            active = np.concatenate([active, np.arange(entered, upto)])
            entered = upto
            active = active[self.b[active, 0] > x0]
            mid = (x0 + x1) / 2
            y = self.y(active, mid)
            order = np.lexsort((y, self.owner[active]))
            edge, y = active[order], y[order]
            (floor, roof), (y_floor, y_roof) = edge[:2], y[:2]
            begin, end, y_begin, y_end = edge[2::2], edge[3::2], y[2::2], y[3::2]
            some = (y_end > y_floor) & (y_begin < y_roof)
            begin, end, y_begin, y_end = begin[some], end[some], y_begin[some], y_end[some]
            under, over = y_begin <= y_floor, y_end >= y_roof
            begin, end = np.where(under, floor, begin), np.where(over, roof, end)
            y_begin, y_end = np.maximum(y_begin, y_floor), np.minimum(y_end, y_roof)
            order = np.argsort(y_begin, kind="stable")
            lower, upper, reached = [], [], -np.inf
            for k in order:
                if y_begin[k] > reached:
                    lower.append(begin[k])
                    upper.append(end[k])
                    reached = y_end[k]
                elif y_end[k] > reached:
                    upper[-1], reached = end[k], y_end[k]
            if outside:
                lower, upper = [floor, *upper], [*lower, roof]
                gap = self.y(np.array(upper), mid) > self.y(np.array(lower), mid)
                lower, upper = np.array(lower)[gap], np.array(upper)[gap]
            yield x0, x1, np.array(lower, int), np.array(upper, int)

    def area(self, outside: bool = False) -> float:
        return float(sum(
            (x1 - x0) * (self.y(upper, (x0 + x1) / 2) - self.y(lower, (x0 + x1) / 2)).sum() for x0, x1, lower, upper in self.strips(outside)
        ))

    def rings(self, outside: bool = False) -> list[np.ndarray]:
        """Borders of what is covered (or not): outer rings run against the clock,
        holes with it.  The upright sides of neighbouring strips cancel out."""
        strips = [s for s in self.strips(outside) if len(s[2])]
        size = max(np.abs(self.a).max(), np.abs(self.b).max()) if len(self.a) else 1.0
        near = 1e-12 * size * 16
        sides: dict[float, list] = {}  # x: spans that end there, spans that begin there
        for x0, x1, lower, upper in strips:
            sides.setdefault(x0, [[], []])[1] += list(zip(self.y(lower, x0), self.y(upper, x0)))
            sides.setdefault(x1, [[], []])[0] += list(zip(self.y(lower, x1), self.y(upper, x1)))
        heights = {}  # heights at an x that differ by rounding alone are one
        for x, both in sides.items():
            ys = np.unique([v for spans in both for span in spans for v in span])
            first = np.concatenate([[True], np.diff(ys) > near])
            heights[x] = (ys, ys[first][np.cumsum(first) - 1])

        def at(x: float, y: float) -> tuple[float, float]:
            ys, same = heights[x]
            return x, float(same[np.searchsorted(ys, y)])

        ways: dict[tuple, list] = {}

        def way(p: tuple, q: tuple) -> None:
            if p != q:
                ways.setdefault(p, []).append(q)

        for x0, x1, lower, upper in strips:
            for lo0, lo1, up0, up1 in zip(self.y(lower, x0), self.y(lower, x1), self.y(upper, x0), self.y(upper, x1)):
                way(at(x0, lo0), at(x1, lo1))
                way(at(x1, up1), at(x0, up0))
        for x, (ends, begins) in sides.items():
            marks = sorted({v for spans in (ends, begins) for span in spans for v in (at(x, span[0])[1], at(x, span[1])[1])})
            for y0, y1 in zip(marks[:-1], marks[1:]):
                held = [any(at(x, s)[1] <= y0 and y1 <= at(x, e)[1] for s, e in spans) for spans in (ends, begins)]
                if held[0] and not held[1]:
                    way((x, y0), (x, y1))
                elif held[1] and not held[0]:
                    way((x, y1), (x, y0))
        out = []
        while ways:
            start = next(iter(ways))
            ring, here = [], start
            while True:
                ring.append(here)
                after = ways[here].pop()
                if not ways[here]:
                    del ways[here]
                here = after
                if here == start:
                    break
            r = bent(np.array(ring))
            if len(r) > 2:
                out.append(r)
        return out


def bent(ring: np.ndarray) -> np.ndarray:
    """The ring without corners at which it goes straight on."""
    before, behind = ring - np.roll(ring, 1, axis=0), np.roll(ring, -1, axis=0) - ring
    bend = np.abs(before[:, 0] * behind[:, 1] - before[:, 1] * behind[:, 0])
    return ring[bend > 1e-12 * np.hypot(*before.T) * np.hypot(*behind.T)]


def against_clock(ring: np.ndarray) -> np.ndarray:
    """The same ring, turned against the clock, with its bent corners alone."""
    return bent(ring if signed_area(ring) > 0 else ring[::-1])


def signed_area(ring: np.ndarray) -> float:
    """Area, positive if the ring runs against the clock."""
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y) / 2)


def union_area(rings: list[np.ndarray], window: np.ndarray, low: float = -np.inf, high: float = np.inf) -> float:
    """Area that rings, overlapping or not, cover of a convex window between two x."""
    return Sweep(rings, window, low, high).area() if rings else 0.0


def convex_hull(points: np.ndarray) -> np.ndarray:
    """Counter-clockwise hull without collinear points."""
    pts = np.unique(points, axis=0)
    if len(pts) <= 2:
        return pts

    def half(seq):
        chain: list[np.ndarray] = []
        for p in seq:
            while len(chain) >= 2:
                u, v = chain[-1] - chain[-2], p - chain[-2]
                if u[0] * v[1] - u[1] * v[0] > 0:
                    break
                chain.pop()
            chain.append(p)
        return chain

    lower, upper = half(pts), half(pts[::-1])
    return np.array(lower[:-1] + upper[:-1])


@F.pandas_udf(T.BooleanType())
def rings_intersect(ax: pd.Series, ay: pd.Series, bx: pd.Series, by: pd.Series) -> pd.Series:
    out = np.zeros(len(ax), bool)
    for rows, p, q in _batches(ax, ay, bx, by):
        out[rows] = touches(p, q) if p.shape[-2] * q.shape[-2] <= COMPARED else touch_of_large(p[0], q[0])
    return pd.Series(out)


@F.pandas_udf(T.DoubleType())
def overlap_with_convex(ax: pd.Series, ay: pd.Series, wx: pd.Series, wy: pd.Series) -> pd.Series:
    """Area of a ring within a convex window; only rings leaving it are clipped."""
    out = np.zeros(len(ax), float)
    for rows, p, w in _batches(ax, ay, wx, wy):
        out[rows] = ring_area(p)
        leaves = ~inside(p, w).all(axis=-1) if p.shape[-2] * w.shape[-2] <= COMPARED else np.ones(len(p), bool)
        for k in np.flatnonzero(leaves):
            out[rows[k]] = ring_area(clip_convex(p[k], w[k]))
    return pd.Series(out)


@F.pandas_udf(RING)
def clipped_ring(ax: pd.Series, ay: pd.Series, wx: pd.Series, wy: pd.Series) -> pd.Series:
    return pd.Series(
        [
            [{"x": float(p[0]), "y": float(p[1])} for p in clip_convex(_points(a, b), _points(c, d))]
            for a, b, c, d in zip(ax, ay, wx, wy)
        ]
    )


@F.pandas_udf(T.DoubleType())
def overlap_in_utm(ax: pd.Series, ay: pd.Series, wx: pd.Series, wy: pd.Series, epsg: pd.Series) -> pd.Series:
    """Square metres shared by a ring and a convex window given in degrees,
    measured in the UTM zone of ``epsg``."""

    def flat(xs, ys, zone: int) -> np.ndarray:
        pts = _points(xs, ys)
        return np.column_stack(projections.utm_forward(np, pts[:, 0], pts[:, 1], zone))

    return pd.Series(
        [
            float(ring_area(clip_convex(flat(a, b, e), flat(c, d, e))))
            for a, b, c, d, e in zip(ax, ay, wx, wy, epsg)
        ],
        dtype=float,
    )


def utm_box_ring(points_per_edge: int, laea: bool):
    """Ring of a UTM box with extra points on its edges, in degrees or on the
    European equal-area grid."""

    @F.pandas_udf(RING)
    def ring(ulx: pd.Series, uly: pd.Series, lrx: pd.Series, lry: pd.Series, epsg: pd.Series) -> pd.Series:
        step = np.arange(points_per_edge) / points_per_edge
        out = []
        for x0, y1, x1, y0, zone in zip(ulx, uly, lrx, lry, epsg):
            xs, ys = np.array([x0, x1, x1, x0]), np.array([y0, y0, y1, y1])
            px = (xs[:, None] + (np.roll(xs, -1) - xs)[:, None] * step).ravel()
            py = (ys[:, None] + (np.roll(ys, -1) - ys)[:, None] * step).ravel()
            x, y = projections.utm_inverse(np, px, py, zone)
            if laea:
                x, y = projections.laea_forward(np, x, y)
            out.append([{"x": float(u), "y": float(v)} for u, v in zip(x, y)])
        return pd.Series(out)

    return ring
