import json
import zipfile

import numpy as np
import pytest
from arborlens.operators import authors, reports
from arborlens.sources import gpkg, las, text
from arborlens.streaming import latest
from pyspark.sql import functions as F


def test_gpkg_round_trip_over_folders(spark, tmp_path):
    rows = [(1, "u1", 12.5, True, 1.0, 2.0), (2, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "fid long, uuid string, dbh double, seen boolean, x double, y double")
    gpkg.write_to_all(df, [str(tmp_path / "a.gpkg"), str(tmp_path / "sub" / "b.gpkg")], "trees")
    back = gpkg.read_gpkg(spark, str(tmp_path), "trees")
    got = sorted(back.collect(), key=lambda r: (r.device, r.fid))
    assert len(got) == 4 and {r.device.rsplit("/", 1)[1] for r in got} == {"a.gpkg", "b.gpkg"}
    assert (got[0].uuid, got[0].dbh, got[0].seen, got[0].x, got[0].y, got[0].z) == ("u1", 12.5, True, 1.0, 2.0, None)
    assert got[1].x is None and got[1].geom_wkb is None and got[1].uuid is None
    assert [r.seq for r in gpkg.sequenced(back).orderBy("seq").collect()] == [0, 1, 2, 3]
    gpkg.write_gpkg(df.limit(1), str(tmp_path / "a.gpkg"), "trees")
    assert gpkg.read_gpkg(spark, str(tmp_path / "a.gpkg"), "trees").count() == 1
    with pytest.raises(FileNotFoundError):
        gpkg.read_gpkg(spark, str(tmp_path / "sub" / "*.none"), "trees") if (tmp_path / "none").exists() else gpkg.read_gpkg(spark, _empty(tmp_path), "trees")


def _empty(tmp_path):
    (tmp_path / "empty").mkdir()
    return str(tmp_path / "empty")


def test_lines_of_wkb():
    import struct

    line = struct.pack("<BII", 1, 2, 3) + struct.pack("<6d", 0, 0, 1, 0, 1, 1)
    assert gpkg.line_of(line) == [(0, 0), (1, 0), (1, 1)]
    assert gpkg.point_of(struct.pack(">BIddd", 0, 1001, 1, 2, 3)) == (1, 2, 3)
    assert gpkg.point_of(None) == (None, None, None)


def test_las_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(i, i * 1.5, -i * 0.25, 100 + i * 0.001, i, float(i)) for i in range(1000)], "seq long, x double, y double, z double, intensity int, gps_time double")
    las.write_las(df, str(tmp_path / "c.las"))
    back = las.read_las(spark, str(tmp_path)).orderBy("seq").collect()
    assert len(back) == 1000
    assert np.allclose([r.x for r in back], [i * 1.5 for i in range(1000)], atol=5e-4)
    assert np.allclose([r.z for r in back], [100 + i * 0.001 for i in range(1000)], atol=5e-4)
    assert back[7].intensity == 7 and back[7].gps_time == 7 and back[7].r is None
    with pytest.raises(ValueError, match="not a LAS"):
        las.header(b"LASX" + bytes(300))
    las.write_tiles(df, str(tmp_path / "tiles"), 500)
    assert spark.read.parquet(str(tmp_path / "tiles")).count() == 1000


def test_text_formats(spark, tmp_path):
    (tmp_path / "t.txt").write_text("QuadratID TagID\n13   5\n 13\t6\n")
    assert [tuple(r) for r in text.read_table(spark, str(tmp_path / "t.txt"), "QuadratID int, TagID int").collect()] == [(13, 5), (13, 6)]
    assert text.read_csv_if_there(spark, str(tmp_path / "no.csv"), "uuid string").count() == 0
    (tmp_path / "v.csv").write_text("uuid\nu1\n")
    assert text.read_csv_if_there(spark, str(tmp_path / "v.csv"), "uuid string").first()["uuid"] == "u1"
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    (tmp_path / "p.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    assert text.read_geojson_rings(spark, str(tmp_path / "p.geojson")) == [[(0, 0), (1, 0), (1, 1), (0, 0)]]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("d/a.tif", b"A")
        z.writestr("b.txt", b"B")
    assert [(r.name, bytes(r.content)) for r in text.read_zip_members(spark, str(tmp_path / "z.zip"), ".tif").collect()] == [("d/a.tif", b"A")]
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "x double, y double, z double")
    text.write_xyz(df, str(tmp_path / "xyz"))
    assert text.read_xyz(spark, str(tmp_path / "xyz")).first()["z"] == 3.0
    text.write_segments(df.withColumn("segment_id", F.lit(4)), str(tmp_path / "seg"))
    assert spark.read.parquet(str(tmp_path / "seg")).first()["segment_id"] == 4
    (tmp_path / "u.tsv").write_text("Time\tPercent\tCores\tRAM\n2024-01-01 00:00:05\t50\t8\t1.5\n")
    assert text.read_usage_log(spark, str(tmp_path / "u.tsv")).first()["Cores"] == 8
    (tmp_path / "r.md").write_text("done progess_percentage of total_standing")
    assert reports.render_template(text.read_template(spark, str(tmp_path / "r.md")), {"progess_percentage": 5, "total_standing": 9}) == "done 5 of 9"


def test_authors(spark):
    rows = [(0, None, "2024-01-01"), (1, "Červený, x.", "2024-01-01"), (2, "Modrý", "2024-01-01"), (3, None, "2024-01-03"), (4, None, "2024-05-01"), (5, " ", None)]
    df = spark.createDataFrame(rows, "seq int, crew string, d string").select("seq", "crew", F.col("d").cast("timestamp_ntz").alias("date"))
    assert [r.crew for r in authors.infer_authors(df).orderBy("seq").collect()] == ["Cervenyx", "Cervenyx", "Modry", "Cervenyx", "unknown_mapper", "unknown_mapper"]


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, 0, "old"), ("a", 3, 1, "new"), ("a", 3, 2, "tie"), ("b", None, 3, "only")], "uuid string, date int, seq int, v string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = latest.latest_records(stream).writeStream.format("memory").queryName("latest_test").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert sorted((r.uuid, r.v) for r in spark.table("latest_test").collect()) == [("a", "new"), ("b", "only")]


def test_gpkg_by_row_ids(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 3 + 7).alias("fid"), F.concat(F.lit("tree "), "id").alias("uuid"), (F.col("id") / 2).alias("x"), F.col("id").cast("double").alias("y")).repartition(4)
    gpkg.write_gpkg(df, str(tmp_path / "new" / "big.gpkg"), "trees")
    assert [p.name for p in (tmp_path / "new").iterdir()] == ["big.gpkg"]
    parts = gpkg.read_gpkg(spark, str(tmp_path), "trees", piece_bytes=60_000)
    assert parts.rdd.getNumPartitions() > 3
    sizes = parts.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 3 and max(r["count"] for r in sizes) < 3000
    got = sorted((r.fid, r.uuid, r.x, r.y) for r in parts.collect())
    assert got == sorted(tuple(r) for r in df.collect())
    whole = gpkg._read_whole(spark, str(tmp_path), "trees", None)
    assert whole.columns == parts.columns and sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    gpkg.write_gpkg(df.limit(0), str(tmp_path / "new" / "big.gpkg"), "trees")
    assert gpkg.read_gpkg(spark, str(tmp_path), "trees").count() == 0
    plain = spark.createDataFrame([("a", 1), (None, None)], "site string, n long")
    gpkg.write_gpkg(plain, str(tmp_path / "plain.gpkg"), "sites")
    assert sorted(map(str, gpkg.read_gpkg(spark, str(tmp_path / "plain.gpkg"), "sites").drop("device").collect())) == sorted(map(str, plain.collect()))


def a_cloud(spark, n):
    i = F.col("id")
    colours = [((i * k) % 65536).cast("int").alias(c) for c, k in zip("rgb", (1, 7, 300), strict=True)]
    return spark.range(n).select(i.alias("seq"), (i * 1.5).alias("x"), (-i * 0.25).alias("y"), (100 + i * 0.001).alias("z"), (i % 60000).cast("int").alias("intensity"), i.cast("double").alias("gps_time"), *colours)


def test_las_by_record_ranges(spark, tmp_path):
    df = a_cloud(spark, 20_000).repartition(5)
    las.write_las(df, str(tmp_path / "c.las"))
    assert [p.name for p in tmp_path.iterdir()] == ["c.las"]
    whole = las.read_las(spark, str(tmp_path))
    cut = las.read_las(spark, str(tmp_path), piece_bytes=100_000)
    assert whole.rdd.getNumPartitions() == 1 and cut.rdd.getNumPartitions() == 7
    rows = sorted(cut.collect(), key=lambda r: r.seq)
    assert rows == sorted(whole.collect(), key=lambda r: r.seq)
    assert [r.seq for r in rows] == list(range(20_000)) and [r.r for r in rows[:3]] == [0, 1, 2]
    assert np.allclose([r.x for r in rows], [i * 1.5 for i in range(20_000)], atol=5e-4)
    h = las.header((tmp_path / "c.las").read_bytes()[:400])
    assert (h["count"], h["format"], h["min"][1], h["max"][0]) == (20_000, 3, -19_999 * 0.25, 19_999 * 1.5)
    assert las.read_las(spark, str(tmp_path), "z double, file string").columns == ["z", "file"]
    las.write_las(df.limit(0), str(tmp_path / "c.las"))
    assert las.read_las(spark, str(tmp_path)).count() == 0


def test_las_over_two_gigabytes(tmp_path):
    """A sparse file of 100 million points: a task reads its own range alone, and counts of 64 bits are read."""
    n, size = 100_000_000, 28
    path = str(tmp_path / "big.las")
    last = las.packed({a: np.array([1.0, 2.0]) for a in "xyz"}, [0.0] * 3, 0.001, 1)
    with open(path, "wb") as f:
        f.write(las.head(n, [0.0] * 3, [2.0] * 3, [0.0] * 3, 0.001, 1))
        f.truncate(227 + n * size)
        f.seek(227 + (n - 2) * size)
        f.write(last.tobytes())
    reader = las.LasReader(path, las.T._parse_datatype_string("seq long, x double"), las.PIECE_BYTES)
    parts = reader.partitions()
    assert len(parts) == 42
    batches = list(reader.read(parts[-1]))
    assert sum(b.num_rows for b in batches) < n // 40 and batches[-1].column(1).to_pylist()[-2:] == [1.0, 2.0] and batches[-1].column(0).to_pylist()[-1] == n - 1
    assert las.header(las.head(5_000_000_000, [0.0] * 3, [1.0] * 3, [0.0] * 3, 0.001, 1))["count"] == 5_000_000_000
    with open(path, "r+b") as f:
        f.truncate(227 + (n - 1) * size)
    with pytest.raises(ValueError, match="ends before"):
        list(reader.read(parts[-1]))


def test_las_wide_formats_and_errors(spark, tmp_path):
    rows = np.zeros(3, np.dtype(las.FORMATS[7]))
    rows["X"], rows["flags"], rows["classification"], rows["scan_angle"], rows["gps_time"], rows["g"] = [1, 2, 3], 0x35, 200, -5000, 9.5, 77
    out = bytearray(las.head(3, [0.0] * 3, [0.003, 0, 0], [0.0] * 3, 0.001, 3))
    out[104], out[105:107] = 7, rows.dtype.itemsize.to_bytes(2, "little")
    (tmp_path / "w.las").write_bytes(bytes(out) + rows.tobytes())
    r = las.read_las(spark, str(tmp_path)).orderBy("seq").first()
    assert (r.x, r.return_number, r.classification, r.scan_angle, r.gps_time, r.g) == (0.001, 5, 200, -30, 9.5, 77)
    for column, what in (("x", "too far out"), ("intensity", "doesn't fit")):
        with pytest.raises(Exception, match=what):
            las.write_las(a_cloud(spark, 3).withColumn(column, F.when(F.col("seq") == 1, 1e12).otherwise(0).cast(dict(a_cloud(spark, 1).dtypes)[column] if column == "x" else "long")), str(tmp_path / "bad.las"))
    assert [p.name for p in tmp_path.iterdir()] == ["w.las"]


def test_las_parts(spark, tmp_path):
    made = las.write_las_parts(a_cloud(spark, 2500).repartition(3), str(tmp_path / "parts"), points=1000)
    assert sorted((r.name, r.points) for r in made.collect()) == [("part-00000000.las", 1000), ("part-00000001.las", 1000), ("part-00000002.las", 500)]
    back = las.read_las(spark, str(tmp_path / "parts")).orderBy("seq").collect()
    assert np.allclose([r.x for r in back], [i * 1.5 for i in range(2500)], atol=5e-4)
