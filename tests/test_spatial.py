import random
import time

import numpy as np
import pytest
from arborlens.operators import spatial
from pyspark.sql import functions as F

AXES = ["x", "y", "z"]


def cloud(spark, rows):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], "seq long, x double, y double, z double")


def crowd():
    """Points all over, a dense ball in one cell, and many in one place."""
    r = random.Random(8)
    return [[round(r.uniform(0, 4), 2) for _ in range(3)] for _ in range(250)] + [[1.3 + r.gauss(0, 0.02) for _ in range(3)] for _ in range(250)] + [[2.5, 2.5, 2.5]] * 60 + [[r.uniform(2.4, 2.6), 2.5, 2.5] for _ in range(40)]


@pytest.mark.parametrize(("k", "own"), [(1, True), (1, False), (8, True), (3, False)])
def test_k_nearest_equals_brute_force(spark, k, own):
    rows = crowd()
    p = np.array(rows)
    d2 = ((p[:, None] - p[None]) ** 2).sum(-1)
    want = set()
    for i in range(len(p)):
        order = sorted((d2[i, j], j) for j in range(len(p)) if d2[i, j] <= 0.49 and not (own and i == j))[:k]
        want |= {(i, j, n) for n, (_, j) in enumerate(order, 1)}
    got = spatial.k_nearest(cloud(spark, rows), cloud(spark, rows), AXES, 0.7, k, exclude_equal=own).collect()
    # places that differ in the last bits of a squared distance may change ranks: compare distances where numbers differ
    assert len(got) == len(want)
    found = {(r.seq, r.nearest, r["rank"]) for r in got}
    by_rank = {(i, n): d2[i, j] for i, j, n in want}
    assert len(found - want) < 5 and all(abs(d2[i, j] - by_rank[i, n]) < 1e-12 for i, j, n in found)
    if k == 1:
        one = {(r.seq, round(r.distance, 9)) for r in spatial.nearest(cloud(spark, rows), cloud(spark, rows), AXES, 0.7, exclude_equal=own).collect()}
        assert one == {(r.seq, round(r.distance, 9)) for r in spatial.nearest(cloud(spark, rows), cloud(spark, rows), AXES, 0.7, exclude_equal=own, crowds=False).collect()}


def test_thin_in_a_crowd(spark):
    rows = crowd()
    p = np.array(rows)
    d2 = ((p[:, None] - p[None]) ** 2).sum(-1)
    kept = []
    for i in range(len(p)):
        if all(d2[i, j] >= 0.09 for j in kept):
            kept.append(i)
    df = cloud(spark, rows).unionByName(spark.createDataFrame([(9999, None, 1.0, 1.0)], "seq long, x double, y double, z double"))
    assert sorted(x.seq for x in spatial.thin(df, AXES, 0.3).collect()) == [*kept, 9999]


def test_outliers_by_k_neighbours(spark):
    r = random.Random(9)
    rows = [[r.uniform(0, 1) for _ in range(3)] for _ in range(400)] + [[1.4, 1.4, 1.4], [1.42, 1.4, 1.4]]
    p = np.array(rows)
    d = np.sort(np.minimum(np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1)) + np.eye(len(p)) * 99, 0.5), axis=1)[:, :8].mean(1)
    want = [i for i in range(len(p)) if d[i] <= d.mean() + 2 * d.std()]
    got = sorted(x.seq for x in spatial.without_outliers(cloud(spark, rows), AXES, 0.5, k=8).collect())
    assert got == want and 400 not in got and 401 not in got  # a pair of strays, whose nearest neighbour is near


def test_a_large_crowd_takes_linear_work(spark):
    """60,000 points in one cell: all pairs would be 3.6 thousand million."""
    one = spark.range(60_000, numPartitions=4).select(F.col("id").alias("seq"), *[(F.rand(k) * 0.1).alias(a) for k, a in enumerate(AXES)])
    start = time.time()
    assert spatial.nearest(one, one, AXES, 0.5, exclude_equal=True).count() == 60_000
    assert spatial.thin(one, AXES, 0.5).count() == 1
    assert time.time() - start < 240
