"""Jobs and small functions that no other test calls."""

from arborlens.operators import authors, points, records
from arborlens.plans import census_run, jobs
from arborlens.sources import text
from arborlens.streaming import latest
from pyspark.sql import functions as F


def cloud(spark, rows):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], "seq long, x double, y double, z double")


def test_cloud_jobs(spark):
    c = cloud(spark, [(0.1, 0.1, 0.1), (0.2, 0.2, 0.3), (11.0, 0.5, 2.0)])
    assert sorted((r.x, r.tile_x, r.tile_y, r.is_buffer) for r in jobs.tiled_voxelize(c, 1.0, 10.0).collect()) == [(0.5, 0, 0, False), (11.5, 1, 0, False)]
    ready = jobs.segmentation_input(c, None, add_time=True)
    assert [(r.gps_time, r.sx, r.sz) for r in ready.orderBy("seq").collect()] == [(0.1, 0.1, 10.1), (0.2, 0.2, 10.3), (11.0, 11.0, 12.0)]
    assert jobs.segmentation_input(c, 1.0).count() == 2
    trees, raster = jobs.tree_report(c.withColumn("segment_id", F.lit(7)), 5.0)
    assert (trees.first()["n"], trees.first()["segment_id"]) == (3, 7) and sorted((r.cell_x, r.n) for r in raster.collect()) == [(0, 2), (2, 1)]


def test_alignment_by_a_sample(spark):
    lattice = points.regular_cloud(spark, 5)
    moved = jobs.align(lattice, points.translate(lattice, 0.1, -0.05, 0.08), 0.5, every=2)
    assert moved.join(lattice.select("seq", F.col("x").alias("q")), "seq").where("abs(x - q) > 1e-6").isEmpty()


def test_new_ids_above_all(spark):
    df = spark.createDataFrame([(9000, 1), (9000, 2), (5, 3), (5, 4)], "fid long, seq int")
    order = [F.col("seq").asc()]
    assert sorted((r.seq, r.fid) for r in records.rekey_duplicates(df, "fid", order, order, above_all=True).collect()) == [(1, 9000), (2, 9001), (3, 5), (4, 9002)]
    assert sorted((r.seq, r.fid) for r in records.rekey_duplicates(df, "fid", order, order).collect()) == [(1, 9000), (2, 5001), (3, 5), (4, 5002)]


def test_days_and_weeks_by_year(spark):
    rows = [(0, "Old", "2023-01-04"), (1, None, "2024-01-03"), (2, "New", "2024-01-04")]
    df = spark.createDataFrame(rows, "seq int, crew string, d string").select("seq", "crew", F.col("d").cast("timestamp_ntz").alias("date"))
    crews = lambda **s: [r.crew for r in authors.infer_authors(df, **s).orderBy("seq").collect()]
    assert crews() == ["Old", "Old", "New"] and crews(by_year=True) == ["Old", "New", "New"]
    assert [r.seq for r in census_run.edited_on(df, ["2024-01-03", "2024-02-01"]).collect()] == [1]


def test_trajectory_and_metadata_files(spark, tmp_path):
    (tmp_path / "t.txt").write_text("%time x y z\n1.5 2 3 4\n2.5 3 4 5\n")
    assert [tuple(r) for r in text.read_trajectory(spark, str(tmp_path / "t.txt")).orderBy("time").collect()] == [(1.5, 2, 3, 4), (2.5, 3, 4, 5)]
    text.write_metadata(cloud(spark, [(1, 2, 3)]), str(tmp_path / "meta"))
    assert spark.read.json(str(tmp_path / "meta")).first()["z"] == 3.0


def test_usage_by_window(spark):
    rows = [("2024-01-01 00:00:05", 50.0, 1.0), ("2024-01-01 00:00:50", 70.0, 3.0), ("2024-01-01 00:01:00", 10.0, 2.0)]
    df = spark.createDataFrame(rows, "t string, Percent double, RAM double").withColumn("Time", F.col("t").cast("timestamp"))
    got = [(r.mean_percent, r.max_ram) for r in latest.usage_by_window(df).orderBy("start").collect()]
    assert got == [(60.0, 3.0), (10.0, 2.0)]
