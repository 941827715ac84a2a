"""Trees of two clouds, and alignment of clouds that lie far apart."""

import numpy as np
import pytest
from arborlens.operators import points, registration, trees
from arborlens.plans import jobs
from pyspark.sql import functions as F

CLOUD = "seq long, x double, y double, z double, segment_id long"


def stem(tree, x, y, height, start=0):
    return [(start + k, x, y, 0.25 + 0.5 * k, tree) for k in range(int(height * 2))]


def test_trees_matched_gone_and_new(spark):
    first = spark.createDataFrame(stem(1, 0.5, 0.5, 4) + stem(2, 5.5, 0.5, 3) + stem(3, 9.5, 9.5, 2) + [(99, 0.5, 0.5, 0.5, None), (98, None, 0.5, 0.5, 3)], CLOUD)
    # tree 11 is 1 grown, 12 is the lower and 13 the upper part of 2, 14 has come
    second = spark.createDataFrame(stem(11, 0.5, 0.5, 5) + [(k, 5.5, 0.5, 0.25 + 0.5 * k, 12 if k < 4 else 13) for k in range(6)] + stem(14, 20.5, 0.5, 1), CLOUD)
    got = {(r.state, r.first, r.second, r.likeliest, r.shared, r.n_first, r.n_second, r.growth) for r in trees.match(first, second, 0.5).collect()}
    assert got == {
        ("matched", 1, 11, None, 8, 8, 10, 1.0),
        ("matched", 2, 12, None, 4, 6, 4, -1.0),
        ("new", None, 13, 2, 2, 0, 2, None),
        ("gone", 3, None, None, 0, 5, 0, None),
        ("new", None, 14, None, 0, 0, 2, None),
    }


def test_trees_of_equal_overlap_and_empty_clouds(spark):
    same = [(i, 0.5, 0.5, 0.5, t) for i, t in enumerate((4, 3))]
    a, b = spark.createDataFrame(same, CLOUD), spark.createDataFrame([(0, 0.5, 0.5, 0.5, 8), (1, 0.5, 0.5, 0.5, 7), (2, 0.5, 0.5, 0.5, 7)], CLOUD)
    got = {(r.state, r.first, r.second, r.likeliest) for r in trees.match(a, b, 1.0).collect()}
    assert got == {("matched", 3, 7, None), ("gone", 4, None, 7), ("new", None, 8, 3)}
    none = a.where("false")
    assert {r.state for r in trees.match(a, none, 1.0).collect()} == {"gone"} and {r.state for r in trees.match(none, b, 1.0).collect()} == {"new"}
    assert trees.match(none, none, 1.0).isEmpty()


@pytest.fixture(scope="module")
def plot(spark):
    """Thirty stems of different heights on ground that rises."""
    at, rows = np.random.default_rng(3), []
    for t in range(30):
        x, y, h = at.uniform(0, 30), at.uniform(0, 20), at.uniform(2, 9)
        rows += [(x + 0.1 * np.cos(a), y + 0.1 * np.sin(a), 0.05 * x + z) for z in np.arange(0, h, 0.25) for a in (0, 2, 4)]
    df = spark.createDataFrame([(i, *map(float, r), 0) for i, r in enumerate(rows)], CLOUD).drop("segment_id")
    return df.coalesce(2).cache()


@pytest.mark.parametrize("degrees", [90, 217.3, -33])
def test_far_clouds_meet(spark, plot, degrees):
    far = points.translate(points.rotate_z(plot, degrees), 140, -60, 12)
    matrix, score = registration.coarse(far, plot, 0.5)
    away = F.greatest(*[F.abs(F.col(a) - F.col(f"q{a}")) for a in points.XYZ])
    beside = plot.select("seq", *[F.col(a).alias(f"q{a}") for a in points.XYZ])
    assert 0.4 < score <= 1 + 1e-9 and points.affine(far, matrix.tolist()).join(beside, "seq").agg(F.max(away)).first()[0] < 1.2
    moved = jobs.align(plot, far, 0.75, coarse=0.25)
    assert moved.join(beside, "seq").agg(F.max(away)).first()[0] < 1e-3


def test_part_of_a_cloud_is_found(spark, plot):
    far = points.translate(points.rotate_z(plot.where("x < 18"), 120), -50, 10, 1)
    moved, _ = registration.register(far, plot, 0.5, 1.0)
    beside = plot.select("seq", F.col("x").alias("qx"), F.col("y").alias("qy"))
    assert moved.join(beside, "seq").where("abs(x - qx) + abs(y - qy) > 1e-3").isEmpty()


def test_nothing_to_align(spark, plot):
    none = plot.where("false")
    for a, b in ((none, plot), (plot, none), (none, none)):
        matrix, score = registration.coarse(a, b, 0.5)
        assert score == 0 and (matrix == np.eye(4)).all()
    one = spark.createDataFrame([(0, 3.0, 4.0, 5.0), (1, None, 1.0, 1.0)], "seq long, x double, y double, z double")
    matrix, _ = registration.coarse(one, points.translate(one, 1, 2, 3), 0.5)
    assert np.allclose(matrix[:3, :3] @ [3, 4, 5] + matrix[:3, 3], [4, 6, 8])
    with pytest.raises(ValueError):
        registration.coarse(plot, plot, 0)


def test_wide_clouds_get_larger_cells(spark):
    df = spark.createDataFrame([(i, 1000.0 * i, 300.0 * (i * i % 7), 0.0) for i in range(20)], "seq long, x double, y double, z double")
    matrix, score = registration.coarse(points.translate(df, 5, 5, 0), df, 0.01)
    assert score > 0.99 and abs(matrix[0, 3]) < 160 and abs(matrix[1, 3]) < 160
