"""Plane geometry on doubles: polygons are rings, arrays of (x, y); the last point joins the first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Ring = list[tuple[float, float]]


def edges(ring: Ring) -> list[tuple[float, float, float, float]]:
    """The ring's sides (x1, y1, x2, y2); a repeated last point is dropped."""
    points = ring[:-1] if len(ring) > 1 and ring[0] == ring[-1] else ring
    return [(*a, *b) for a, b in zip(points, points[1:] + points[:1], strict=True)]


def _edge_array(sides: list[tuple[float, float, float, float]]) -> Column:
    return F.array(*[F.struct(*[F.lit(float(v)).alias(k) for k, v in zip(("x1", "y1", "x2", "y2"), side, strict=True)]) for side in sides])


def inside(x: Column, y: Column, rings: list[Ring]) -> Column:
    """Whether a point is in the polygon (outer ring, then holes), by the parity of sides that a ray to the right crosses."""
    sides = [s for r in rings for s in edges(r)]
    if not sides:
        return F.lit(False)
    xs, ys = [s[0] for s in sides], [s[1] for s in sides]
    box = x.between(min(xs), max(xs)) & y.between(min(ys), max(ys))
    crossed = F.filter(_edge_array(sides), lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]))
    return F.coalesce(F.when(box, F.size(crossed) % 2 == 1).otherwise(F.lit(False)), F.lit(False))


def distance_to_ring(x: Column, y: Column, ring: Ring) -> Column:
    """Distance from a point to the nearest side."""

    def to_side(x1: float, y1: float, x2: float, y2: float) -> Column:
        dx, dy = x2 - x1, y2 - y1
        length = dx * dx + dy * dy
        at = F.lit(0.0) if length == 0 else F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((x - x1) * dx + (y - y1) * dy) / length))
        return F.sqrt(F.pow(x - (x1 + at * dx), 2) + F.pow(y - (y1 + at * dy), 2))

    sides = [to_side(*s) for s in edges(ring)]
    return reduce(F.least, sides) if len(sides) > 1 else sides[0]


def within_buffer(x: Column, y: Column, ring: Ring, buffer: float) -> Column:
    """Whether a point is in the polygon or at most ``buffer`` outside."""
    return inside(x, y, [ring]) | (distance_to_ring(x, y, ring) <= buffer)


def centroid(ring: Column) -> Column:
    """Area centroid (x, y) of a ring column, array of (x, y), by the shoelace formula."""
    n = F.size(ring)
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, (i + 1) % n).alias("b")))
    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("area", "x", "y")])

    def step(acc: Column, p: Column) -> Column:
        cross = p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"]
        return F.struct((acc["area"] + cross).alias("area"), (acc["x"] + (p["a"]["x"] + p["b"]["x"]) * cross).alias("x"), (acc["y"] + (p["a"]["y"] + p["b"]["y"]) * cross).alias("y"))

    return F.aggregate(pairs, zero, step, lambda s: F.struct((s["x"] / (3 * s["area"])).alias("x"), (s["y"] / (3 * s["area"])).alias("y")))
