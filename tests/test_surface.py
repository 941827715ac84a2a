import random

import numpy as np
from arborlens.operators import points, rays, surface
from pyspark.sql import functions as F


def cloud(spark, rows):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], "seq long, x double, y double, z double")


def test_noise_on_a_plane_shrinks_and_edges_stay(spark):
    r = random.Random(1)
    # two walls that meet at a right angle, far from 0
    flat = [(r.uniform(0, 6), r.uniform(0, 6), r.gauss(0, 0.03)) for _ in range(4000)]
    wall = [(6 + r.gauss(0, 0.03), r.uniform(0, 6), r.uniform(0, 6)) for _ in range(4000)]
    rows = [(500_000 + x, 5_000_000 + y, 200 + z) for x, y, z in flat + wall] + [(500_900.0, 5_000_000.0, 200.0)]
    got = np.array([(p.x, p.y, p.z) for p in surface.smooth_on_planes(cloud(spark, rows), 0.5).orderBy("seq").collect()]) - [500_000, 5_000_000, 200]
    before = np.array(rows) - [500_000, 5_000_000, 200]
    middle = (before[:4000, 0] < 5) & (before[:4000, 0] > 1)
    assert got[:4000][middle, 2].std() < 0.3 * before[:4000][middle, 2].std()
    high = before[4000:8000, 2] > 1.5
    assert (got[4000:8000][high, 0] - 6).std() < 0.3 * 0.03
    # at the edge no plane fits: points stay there
    edge = (np.abs(before[:8000, 0] - 6) < 0.3) & (before[:8000, 2] < 0.3)
    assert edge.sum() > 100 and np.abs(got[:8000][edge] - before[:8000][edge]).max() < 0.1
    assert np.allclose(got[8000], before[8000])
    odd = spark.createDataFrame([(0, None, 1.0, 1.0)], "seq long, x double, y double, z double")
    assert surface.smooth_on_planes(odd, 0.5).first()["y"] == 1.0


def test_opening_equals_brute_force(spark):
    r = random.Random(2)
    raster = {(x, y): r.uniform(0, 9) for x in range(14) for y in range(11) if r.random() < 0.8}
    df = spark.createDataFrame([(x, y, z) for (x, y), z in raster.items()], "cell_x long, cell_y long, z double")
    for reach in (1, 3):
        window = lambda at, f, of, reach=reach: f(of[x, y] for x in range(at[0] - reach, at[0] + reach + 1) for y in range(at[1] - reach, at[1] + reach + 1) if (x, y) in of)
        low = {c: window(c, min, raster) for c in raster}
        assert {(q.cell_x, q.cell_y): q.z for q in surface.opening(df, reach).collect()} == {c: window(c, max, low) for c in raster}


def test_terrain_under_a_crown(spark):
    """A slope with a crown over part of it, below which no ground was seen, and a trunk."""
    rows = [(x + 0.5, y + 0.5, 0.1 * x) for x in range(20) for y in range(20) if not (8 <= x < 12 and 8 <= y < 12)]
    rows += [(x + 0.5, y + 0.5, 12.0) for x in range(6, 14) for y in range(6, 14)] + [(3.5, 3.5, 5.0)]
    found = surface.terrain(cloud(spark, rows), 1.0)
    got = {(q.cell_x, q.cell_y): (q.z, q.filled) for q in found.collect()}
    assert len(got) == 400 and all(abs(z - 0.1 * x) < 0.25 for (x, _), (z, _) in got.items())
    assert {c for c, (_, filled) in got.items() if filled} == {(x, y) for x in range(8, 12) for y in range(8, 12)}
    heights = {q.seq: q.height for q in surface.above_ground(cloud(spark, rows), found, 1.0).collect()}
    assert abs(heights[len(rows) - 1] - 4.7) < 0.01


def overlap(s, e, v, cell):
    """Length, as a share of the ray, of what it has inside the voxel."""
    lo, hi = 0.0, 1.0
    for a in range(3):
        d, low, high = e[a] - s[a], v[a] * cell, (v[a] + 1) * cell
        if d == 0:
            if not low <= s[a] < high:
                return 0.0
            continue
        t = sorted(((low - s[a]) / d, (high - s[a]) / d))
        lo, hi = max(lo, t[0]), min(hi, t[1])
    return hi - lo


def test_points_that_later_rays_pass_go(spark):
    r = random.Random(3)
    cell = 0.5
    rows = []
    for i in range(150):
        end = [round(r.uniform(-4, 4), 3) + 0.00037 for _ in range(3)]
        start = [round(r.uniform(-0.3, 0.3), 3) + 0.00051 for _ in range(3)] if i % 5 else [end[0], end[1], end[2] + 3]
        rows.append((i, *end, *start, float(r.randint(0, 40))))
    df = spark.createDataFrame(rows, "seq long, x double, y double, z double, sx double, sy double, sz double, gps_time double")
    voxel = lambda p: tuple(int(np.floor(c / cell)) for c in p)
    ends = {x[0]: voxel(x[1:4]) for x in rows}
    hit = {(i, v) for i, *q in rows for v in set(ends.values()) if v != ends[i] and overlap(q[3:6], q[0:3], v, cell) > 0}
    gone = {i for i, v in ends.items() if any(w == v and rows[j][7] > rows[i][7] for j, w in hit)}
    got = {x.seq for x in rays.without_passed(df, cell).collect()}
    assert got == set(ends) - gone and len(gone) > 5
    counted = {(x.vx, x.vy, x.vz): x.n_rays for x in rays.passages(df, cell).collect()}
    assert all(counted.get(v, 0) == sum(w == v for _, w in hit) for v in set(ends.values()))
    odd = spark.createDataFrame([(1, None, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0), (2, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, None)], df.schema)
    assert rays.without_passed(odd, cell).count() == 2


def test_other_point_operators(spark):
    c = cloud(spark, [(1, 2, 3), (4, 5, 6)]).withColumn("gps_time", F.col("seq").cast("double"))
    with_rays = points.with_ray(c)
    ends, starts = points.ray_ends(with_rays)
    assert ends.columns == c.columns and [tuple(r) for r in starts.orderBy("time").collect()] == [(0.0, 1.0, 2.0, 13.0), (1.0, 4.0, 5.0, 16.0)]
    lasting = cloud(spark, [(0.1, 0.1, 0.1), (0.2, 0.2, 0.2), (5, 5, 5)]).withColumn("gps_time", F.col("seq") * 10.0)
    assert sorted(r.seq for r in points.without_transients(lasting, 1.0, 5.0).collect()) == [0, 1]
