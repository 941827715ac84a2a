import random

import pytest
from arborlens.operators import planar
from pyspark.sql import functions as F

SEGMENT = "x1 double, y1 double, x2 double, y2 double"
POLYGON = "polygon_id long, rings array<array<struct<x:double,y:double>>>"


def faces(spark, rows):
    return sorted((round(r.area, 9), r.n_sides, len(r.ring)) for r in planar.polygonize(spark.createDataFrame(rows, SEGMENT)).collect())


def square(x, y, s=1.0):
    p = [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    return [(*a, *b) for a, b in zip(p, p[1:] + p[:1], strict=True)]


def test_faces(spark):
    assert faces(spark, square(0.0, 0.0)) == [(1, 4, 4)]
    # a shared side given twice, in both directions, a segment of no length, and one without an end
    two = square(0.0, 0.0) + square(1.0, 0.0) + [(5.0, 5.0, 5.0, 5.0), (1.0, 1.0, None, 0.0)]
    assert faces(spark, two) == [(1, 4, 4), (1, 4, 4)]
    # a dead end inside, a bridge to another square, and a tree that bounds nothing
    loose = square(0.0, 0.0) + square(3.0, 0.0, 2.0) + [(0.0, 0.0, 0.5, 0.5), (0.5, 0.5, 0.6, 0.4), (1.0, 1.0, 3.0, 0.0), (9.0, 9.0, 8.0, 8.0), (9.0, 9.0, 10.0, 8.0)]
    assert faces(spark, loose) == [(1, 4, 4), (4, 4, 4)]
    assert faces(spark, [(0.0, 0.0, 1.0, 1.0)]) == [] and faces(spark, []) == []


def test_rings_are_in_order(spark):
    n = 100
    import math

    p = [(math.cos(2 * math.pi * i / n), math.sin(2 * math.pi * i / n)) for i in range(n)]
    rows = [(*a, *b) for a, b in zip(p, p[1:] + p[:1], strict=True)]
    random.Random(1).shuffle(rows)
    ring = [(q.x, q.y) for q in planar.polygonize(spark.createDataFrame(rows, SEGMENT)).first()["ring"]]
    k = ring.index(p[0])
    assert ring[k:] + ring[:k] == p


def test_lattice_with_fans(spark):
    """A lattice of 12 by 9 with one diagonal in each cell, in random order and direction."""
    rows = [(float(i), float(j), float(i + 1), float(j)) for i in range(12) for j in range(10)] + [(float(i), float(j), float(i), float(j + 1)) for i in range(13) for j in range(9)]
    rows += [(float(i), float(j), float(i + 1), float(j + 1)) for i in range(12) for j in range(9)]
    random.Random(2).shuffle(rows)
    assert faces(spark, [r if i % 2 else (*r[2:], *r[:2]) for i, r in enumerate(rows)]) == [(0.5, 3, 3)] * 216


def brute(x, y, rings):
    odd = False
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1], strict=True):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def test_points_in_polygons(spark):
    r = random.Random(3)
    polygons = []
    for k in range(120):
        cx, cy, s, n = r.uniform(-5, 5), r.uniform(-5, 5), r.choice([0.05, 0.5, 3, 40]), r.choice([3, 4, 9, 40])
        rings = [[(round(cx + r.uniform(-s, s), 3), round(cy + r.uniform(-s, s), 3)) for _ in range(n)] for _ in range(r.choice([1, 2]))]  # crossing sides as well
        polygons.append((k, rings))
    polygons += [(500, [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]]), (501, [[(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0), (1.0, 0.0)]]), (502, []), (503, [[(1.0, 1.0)]])]
    points = [(i, round(r.uniform(-6, 6), 2), round(r.uniform(-6, 6), 2)) for i in range(400)] + [(900, 1.0, 0.5), (901, 0.0, 0.0), (902, None, 1.0)]
    df = spark.createDataFrame(points, "seq long, x double, y double")
    got = sorted((g.seq, g.polygon_id) for g in planar.in_polygons(df, spark.createDataFrame(polygons, POLYGON)).collect())
    want = sorted((i, k) for i, x, y in points if x is not None for k, rings in polygons if brute(x, y, rings))
    assert got == want and len(want) > 1000
    assert planar.in_polygons(df, spark.createDataFrame([], POLYGON)).count() == 0


def test_many_polygons_leave_the_plan_small(spark):
    corner = lambda dx, dy: F.struct((F.col("id") % 100 * 1.0 + dx).alias("x"), (F.floor(F.col("id") / 100) * 1.0 + dy).alias("y"))
    polygons = spark.range(10_000).select(F.col("id").alias("polygon_id"), F.array(F.array(corner(0.25, 0.25), corner(0.75, 0.25), corner(0.75, 0.75), corner(0.25, 0.75))).alias("rings"))
    points = spark.range(20_000).select(F.col("id").alias("seq"), (F.col("id") % 100 + F.when(F.col("id") < 10_000, 0.5).otherwise(0.1)).alias("x"), (F.floor(F.col("id") / 100) % 100 + 0.5).alias("y"))
    found = planar.in_polygons(points, polygons)
    assert found.where("seq = polygon_id").count() == found.count() == 10_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 20_000 and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("size", [1e-6, 1e6])
def test_sizes(spark, size):
    rings = [[(0.0, 0.0), (size, 0.0), (size, size), (0.0, size)]]
    points = spark.createDataFrame([(1, size / 2, size / 2), (2, size * 2, size / 2), (3, size * 0.01, size * 0.99)], "seq long, x double, y double")
    assert sorted(r.seq for r in planar.in_polygons(points, spark.createDataFrame([(1, rings)], POLYGON)).collect()) == [1, 3]


def test_cells_are_not_collected(spark):
    """Cells of polygons, more by far than Spark's estimates of them, never go through the driver, not even where much may be broadcast."""
    corner = lambda dx, dy: F.struct((F.col("id") % 100 + dx).alias("x"), (F.floor(F.col("id") / 100) % 20 + dy).alias("y"))
    ring = F.array(corner(0.25, 0.25), corner(0.75, 0.25), corner(0.75, 0.75), corner(0.25, 0.75))
    polygons = spark.range(6000).select(F.col("id").alias("polygon_id"), F.array(ring).alias("rings"))  # 2,000 places, three polygons each
    points = spark.range(2000).select(F.col("id").alias("seq"), (F.col("id") % 100 + 0.5).alias("x"), (F.floor(F.col("id") / 100) + 0.5).alias("y"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        found = planar.in_polygons(points, polygons)
        assert found.where("seq = polygon_id % 2000").count() == found.count() == 6000
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_of_one_id_are_one_polygon(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    hole = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)]
    points = spark.createDataFrame([(1, 1.5, 1.5), (2, 3.0, 3.0)], "seq long, x double, y double")
    rows = [(7, [ring]), (7, [hole]), (8, [ring]), (8, [ring]), (9, [ring, hole]), (None, [ring])]
    assert sorted((r.seq, r.polygon_id) for r in planar.in_polygons(points, spark.createDataFrame(rows, POLYGON)).collect()) == [(2, 7), (2, 9)]


@pytest.mark.parametrize("task_sides", [20, 250_000])
def test_faces_over_several_tasks(spark, task_sides):
    """Lattices with dead ends, bridges, an island on a bridge within a face and a tree give the same faces however few sides a task has."""
    rows = [s for i in range(6) for j in range(4) for s in square(float(i), float(j))]
    rows += [(0.0, 0.0, -0.5, -0.5), (6.0, 4.0, 7.0, 4.5), (7.0, 4.5, 8.0, 4.0), (7.0, 4.5, 8.0, 5.0), *square(8.0, 4.0, 3.0)]
    rows += [(8.0, 4.0, 9.0, 5.0), *square(9.0, 5.0), (9.0, 5.0, 9.2, 5.2), (9.0, 5.0, 9.3, 5.2), (20.0, 0.0, 21.0, 1.0), (21.0, 1.0, 22.0, 0.0), (21.0, 1.0, 21.0, 2.0)]
    random.Random(4).shuffle(rows)
    found = planar.polygonize(spark.createDataFrame(rows, SEGMENT), task_sides)
    assert sorted((round(r.area, 9), r.n_sides, len(r.ring)) for r in found.collect()) == [(1, 4, 4)] * 25 + [(9, 4, 4)]
    for r in found.collect():
        ring = [(p.x, p.y) for p in r.ring]
        assert sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True)) / 2 == pytest.approx(r.area)
    assert found.select("face_id").distinct().count() == 26
