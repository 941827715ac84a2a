import random

import numpy as np
import pytest
from arborlens.functions import geometry
from arborlens.operators import points, records, spatial
from arborlens.plans import jobs
from pyspark.sql import functions as F


def cloud(spark, rows):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], "seq long, x double, y double, z double")


def test_voxels(spark):
    c = cloud(spark, [(0.1, 0.1, 0.1), (0.4, 0.2, 0.3)])
    got = {m: points.voxel_downsample(c, 0.5, m).collect() for m in ("center", "first", "mean")}
    assert [len(v) for v in got.values()] == [1, 1, 1]
    assert tuple(got["center"][0])[1:] == (0.25, 0.25, 0.25)
    assert tuple(got["first"][0]) == (0, 0.1, 0.1, 0.1)
    assert tuple(got["mean"][0])[1:] == pytest.approx((0.25, 0.15, 0.2))
    assert points.voxel_downsample(cloud(spark, [(-0.1, 0, 0), (0.1, 0, 0)]), 0.5).count() == 2
    r = random.Random(1)
    many = cloud(spark, [[r.uniform(-2, 2) for _ in range(3)] for _ in range(500)])
    want = sorted(map(tuple, points.voxel_downsample(many, 0.5, "first").collect()))
    assert sorted(map(tuple, points.voxel_downsample(many.repartition(7), 0.5, "first").collect())) == want


def test_centre_ferry_decimate_and_info(spark):
    c = cloud(spark, [(0, 0, 2), (10, 4, 9)])
    assert [tuple(r)[1:] for r in points.center_cloud(c).orderBy("seq").collect()] == [(-5, -2, 0), (5, 2, 7)]
    assert [r.gps_time for r in points.ferry(c).orderBy("seq").collect()] == [0, 10]
    ten = cloud(spark, [(i, 0, 0) for i in range(10)])
    assert sorted(r.seq for r in points.decimate(ten, 4).collect()) == [0, 4, 8]
    assert points.sampled_until(ten, lambda d: d.count() < 4)[1] == 4
    assert points.cloud_info(ten).first()["max_x"] == 9
    assert points.first_point(ten).first()["seq"] == 0


def test_crop_and_tiles(spark):
    square = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    hole = [(0.4, 0.4), (0.6, 0.4), (0.6, 0.6), (0.4, 0.6)]
    c = cloud(spark, [(0.5, 0.5, 0), (2, 2, 0), (0.1, 0.9, 0)])
    assert sorted(r.seq for r in jobs.clip(c, [square]).collect()) == [0, 2]
    assert [r.seq for r in jobs.clip(c, [square, hole]).collect()] == [2]
    t = points.tiles(cloud(spark, [(0.95, 0.5, 0)]), 1, 0.1)
    assert sorted((r.tile_x, r.tile_y, r.is_buffer) for r in t.collect()) == [(0, 0, False), (1, 0, True)]


def test_geometry(spark):
    ring = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    row = spark.range(1).select(geometry.centroid(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ring])).alias("c"), geometry.within_buffer(F.lit(3.0), F.lit(1.0), ring, 1.0).alias("near"), geometry.within_buffer(F.lit(3.1), F.lit(1.0), ring, 1.0).alias("far")).first()
    assert (row.c.x, row.c.y, row.near, row.far) == (1, 1, True, False)


def test_near_points_equal_brute_force(spark):
    r = random.Random(5)
    rows = [[r.uniform(0, 0.3) for _ in range(3)] for _ in range(300)] + [[0.1, 0.1, 0.1]] * 3
    c = cloud(spark, rows)
    p = np.array(rows)
    for axes in (["x", "y"], ["x", "y", "z"]):
        d = np.sqrt(((p[:, None, : len(axes)] - p[None, :, : len(axes)]) ** 2).sum(-1)) + np.eye(len(p)) * 9
        got = {x.seq: x.duplicated_xy for x in spatial.mark_near(c, axes, 0.02).collect()}
        assert got == {i: bool((d[i] < 0.02).any()) for i in range(len(p))}


def test_nearest_thin_denoise_smooth(spark):
    r = random.Random(6)
    rows = [[round(r.uniform(0, 1), 3) for _ in range(3)] for _ in range(200)]
    c, p = cloud(spark, rows), np.array(rows)
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1)) + np.eye(len(p)) * 9
    got = {x.seq: (x.nearest, round(x.distance, 9)) for x in spatial.nearest(c, c, ["x", "y", "z"], 0.15, exclude_equal=True).collect()}
    want = {i: (int(d[i].argmin()), round(float(d[i].min()), 9)) for i in range(len(p)) if d[i].min() <= 0.15}
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
    kept = []
    for i in range(len(p)):
        if all(d[i, j] >= 0.2 for j in kept):
            kept.append(i)
    assert sorted(x.seq for x in spatial.thin(c, ["x", "y", "z"], 0.2).collect()) == kept
    assert spatial.without_outliers(cloud(spark, [*rows, (9, 9, 9)]), ["x", "y", "z"], 0.5).where("seq = 200").isEmpty()
    assert spatial.smooth(c, ["x", "y", "z"], 0.2).count() == len(rows)


def test_icp_undoes_a_shift(spark):
    lattice = points.regular_cloud(spark, 5)
    moved, matrix = points.icp(points.translate(lattice, 0.1, -0.05, 0.08), lattice, 0.5, rounds=3)
    assert np.allclose(matrix[:3, 3], [-0.1, 0.05, -0.08], atol=1e-6)
    assert moved.join(lattice.select("seq", F.col("x").alias("q")), "seq").where("abs(x - q) > 1e-6").isEmpty()
    assert points.rotate_z(lattice, 90).where("seq = 1").first()["y"] == pytest.approx(1)


def test_as_of_and_restore(spark):
    a = spark.createDataFrame([(1, 5.0), (1, 1.0), (2, 9.0)], "k int, t double")
    b = spark.createDataFrame([(1, 2.0, "p"), (1, 5.0, "q"), (2, 10.0, "r")], "k int, t double, v string")
    got = sorted((r.k, r.t, r.v) for r in points.as_of(a, b, "t", "t", ["v"], ["k"]).collect())
    assert got == [(1, 1.0, None), (1, 5.0, "q"), (2, 9.0, None)]


def test_numbering_is_gapless_over_partitions(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v")).repartition(9)
    got = records.number_rows(df, [F.col("v").asc()], "n").collect()
    assert all(r.n == r.v + 1 for r in got) and len(got) == 1000


def test_record_policies(spark):
    rows = [(1, "a", None, "x"), (2, "a", None, None), (3, "b", 5, None), (4, "b", 7, None), (5, "c", None, None), (6, "c", None, "y"), (7, "c", None, "z")]
    df = spark.createDataFrame(rows, "seq int, uuid string, date int, status string")
    assert sorted(r.seq for r in records.last_record(df, "uuid", "date", "status", ["date", "status"], ["seq"]).collect()) == [1, 4, 6]
    left = spark.createDataFrame([(None,), (1,), (2,)], "k int")
    right = spark.createDataFrame([(None,), (2,)], "q int")
    assert [r.k for r in records.without_keys(left, right, "k", "q").collect()] == [1]
