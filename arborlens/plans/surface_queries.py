"""Queries of line work, polygons, neighbours, rays and surfaces, each with the same in SQL by brute force where SQL can say it.

The cloud is that of the other queries: the first three numbers of each embedding.
"""

from __future__ import annotations

from arborlens.operators import planar, points, rays, registration, spatial, surface, trees
from arborlens.plans.queries import _CLOUD, _cloud, query, read
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LATTICE = """WITH l AS (SELECT DISTINCT l_suppkey AS k, round(l_discount * 100)::BIGINT AS x, round(l_tax * 100)::BIGINT AS y FROM lineitem),
x AS (SELECT k, x, lead(x) OVER (PARTITION BY k ORDER BY x) AS x2 FROM (SELECT DISTINCT k, x FROM l)),
y AS (SELECT k, y, lead(y) OVER (PARTITION BY k ORDER BY y) AS y2 FROM (SELECT DISTINCT k, y FROM l))
SELECT k AS supplier, x, y, ((x2 - x) * (y2 - y))::DOUBLE AS area, 4::BIGINT AS n_sides FROM x JOIN y USING (k) WHERE x2 IS NOT NULL AND y2 IS NOT NULL"""


def lattice(spark: SparkSession, d: str) -> DataFrame:
    """Line work beside each other for all suppliers: lines at their discounts and taxes, and a loose end each."""
    at = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.round(F.col("l_discount") * 100).cast("long").alias("x"), F.round(F.col("l_tax") * 100).cast("long").alias("y"))
    gaps = lambda c: at.select("k", c).distinct().withColumn(f"{c}2", F.lead(c).over(Window.partitionBy("k").orderBy(c)))
    xs, ys = gaps("x"), gaps("y")
    shifted = lambda c: (F.col(c) + 100 * F.col("k")).cast("double")
    upright = xs.join(ys.where("y2 is not null"), "k").select(shifted("x").alias("x1"), F.col("y").cast("double").alias("y1"), shifted("x").alias("x2"), F.col("y2").cast("double").alias("y2"))
    across = ys.join(xs.where("x2 is not null"), "k").select(shifted("x").alias("x1"), F.col("y").cast("double").alias("y1"), shifted("x2").alias("x2"), F.col("y").cast("double").alias("y2"))
    corner = at.groupBy("k").agg(F.min("x").alias("x"), F.min("y").cast("double").alias("y"))
    loose = corner.select(shifted("x").alias("x1"), F.col("y").alias("y1"), (shifted("x") - 0.5).alias("x2"), (F.col("y") - 0.5).alias("y2"))
    return upright.unionByName(across).unionByName(loose)


@query(_LATTICE)
def polygonize_lattice(spark, d):
    low = lambda a: F.array_min(F.transform("ring", lambda p: p[a]))
    faces = planar.polygonize(lattice(spark, d)).select(low("x").alias("_x"), low("y").cast("long").alias("y"), "area", "n_sides")
    return faces.select(F.floor(F.col("_x") / 100).cast("long").alias("supplier"), F.pmod(F.col("_x").cast("long"), F.lit(100)).alias("x"), "y", "area", "n_sides")


# A triangle with a square hole, around a place that the part's key gives
_OUTER, _HOLE = [(-0.043, -0.041), (0.047, -0.037), (0.003, 0.049)], [(-0.011, -0.012), (0.009, -0.012), (0.009, 0.008), (-0.011, 0.008)]
_SIDES = ", ".join(f"{{'a': {a[0]}, 'b': {a[1]}, 'c': {b[0]}, 'd': {b[1]}}}" for r in (_OUTER, _HOLE) for a, b in zip(r, r[1:] + r[:1], strict=True))


@query(f"""{_CLOUD}, g AS (SELECT p_partkey, (p_partkey * 7919 % 2000) / 1000.0::DOUBLE - 1 AS cx, (p_partkey * 104729 % 2000) / 1000.0::DOUBLE - 1 AS cy FROM part),
s AS (SELECT p_partkey, cx, cy, cx + e.a::DOUBLE AS x1, cy + e.b::DOUBLE AS y1, cx + e.c::DOUBLE AS x2, cy + e.d::DOUBLE AS y2 FROM g, (SELECT unnest([{_SIDES}]) AS e))
SELECT seq, p_partkey AS polygon_id FROM p JOIN s ON abs(p.x - cx) < 0.1 AND abs(p.y - cy) < 0.1
WHERE (y1 > p.y) <> (y2 > p.y) AND p.x < (x2 - x1) * (p.y - y1) / (y2 - y1) + x1 GROUP BY seq, p_partkey HAVING count(*) % 2 = 1""")
def points_in_polygons(spark, d):
    place = lambda n: F.col("p_partkey") * n % 2000 / F.lit(1000.0) - 1
    ring = lambda r: F.array(*[F.struct((place(7919) + a).alias("x"), (place(104729) + b).alias("y")) for a, b in r])
    polygons = read(spark, d, "part").select(F.col("p_partkey").alias("polygon_id"), F.array(ring(_OUTER), ring(_HOLE)).alias("rings"))
    return planar.in_polygons(_cloud(spark, d), polygons).select("seq", "polygon_id")


_PAIRS = "n AS (SELECT a.seq, b.seq AS nearest, pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) AS d2 FROM p a JOIN p b ON a.seq <> b.seq AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) <= {r} * {r})"


@query(f"""{_CLOUD}, {_PAIRS.format(r=0.1)}, r AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY d2, nearest) AS rank FROM n)
SELECT seq, nearest, round(sqrt(d2), 6) AS distance, rank::INTEGER AS rank FROM r WHERE rank <= 3""")
def three_nearest(spark, d):
    c = _cloud(spark, d)
    return spatial.k_nearest(c, c, list(points.XYZ), 0.1, 3, exclude_equal=True).withColumn("distance", F.round("distance", 6))


@query(f"""{_CLOUD}, {_PAIRS.format(r=0.2)}, r AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY d2, nearest) AS r FROM n),
m AS (SELECT p.seq, (coalesce(sum(sqrt(d2)), 0) + (8 - count(d2)) * 0.2::DOUBLE) / 8 AS d FROM p LEFT JOIN r ON p.seq = r.seq AND r <= 8 GROUP BY p.seq)
SELECT seq FROM m WHERE d <= (SELECT avg(d) + 2 * stddev_pop(d) FROM m)""")
def denoise_by_eight(spark, d):
    return spatial.without_outliers(_cloud(spark, d), list(points.XYZ), 0.2, k=8).select("seq")


_SLAB = ", ".join(f"least((({v}) * 0.25 - s{a}) / ({a} - s{a}), (({v} + 1) * 0.25 - s{a}) / ({a} - s{a})) AS lo_{a}, greatest((({v}) * 0.25 - s{a}) / ({a} - s{a}), (({v} + 1) * 0.25 - s{a}) / ({a} - s{a})) AS hi_{a}" for a, v in zip("xyz", ("v.vx", "v.vy", "v.vz"), strict=True))


@query(f"""{_CLOUD}, r AS (SELECT *, 0.0131::DOUBLE AS sx, 0.0171::DOUBLE AS sy, 0.0113::DOUBLE AS sz, (seq * 7919 % 1009)::DOUBLE AS t, floor(x / 0.25)::BIGINT AS vx, floor(y / 0.25)::BIGINT AS vy, floor(z / 0.25)::BIGINT AS vz FROM p),
v AS (SELECT DISTINCT vx, vy, vz FROM r), s AS (SELECT v.vx, v.vy, v.vz, t, {_SLAB} FROM r JOIN v ON r.vx <> v.vx OR r.vy <> v.vy OR r.vz <> v.vz),
l AS (SELECT vx, vy, vz, max(t) AS last FROM s WHERE least(1, hi_x, hi_y, hi_z) > greatest(0, lo_x, lo_y, lo_z) GROUP BY ALL)
SELECT seq FROM r LEFT JOIN l USING (vx, vy, vz) WHERE NOT coalesce(last > t, FALSE)""")
def points_not_passed(spark, d):
    seen = _cloud(spark, d).select("*", *[F.lit(v).alias(f"s{a}") for a, v in zip("xyz", (0.0131, 0.0171, 0.0113), strict=True)], (F.col("seq") * 7919 % 1009).cast("double").alias("gps_time"))
    return rays.without_passed(seen, 0.25).select("seq")


def _opened(source: str, out: str, reach: int) -> str:
    """SQL for one opening of a raster."""
    near = f"abs(a.cell_x - b.cell_x) <= {reach} AND abs(a.cell_y - b.cell_y) <= {reach}"
    return f"""{out}_low AS (SELECT a.cell_x, a.cell_y, min(b.z) AS z FROM {source} a JOIN {source} b ON {near} GROUP BY ALL),
{out} AS (SELECT a.cell_x, a.cell_y, max(b.z) AS z FROM {out}_low a JOIN {out}_low b ON {near} GROUP BY ALL)"""


_RASTER = f"{_CLOUD}, g AS (SELECT floor(x / 0.05)::BIGINT AS cell_x, floor(y / 0.05)::BIGINT AS cell_y, min(z) AS z FROM p GROUP BY 1, 2)"
_BARE = "{out} AS (SELECT a.* FROM {source} a JOIN {opened} o USING (cell_x, cell_y) WHERE a.z - o.z <= 0.02 + 0.3 * {reach} * 0.05)"


@query(f"{_RASTER}, {_opened('g', 'o', 2)} SELECT * FROM o")
def raster_opening(spark, d):
    return surface.opening(points.ground(_cloud(spark, d), 0.05), 2)


@query(f"""{_RASTER}, {_opened("g", "o1", 1)}, {_BARE.format(out="b1", source="g", opened="o1", reach=1)}, {_opened("b1", "o2", 2)}, {_BARE.format(out="b2", source="b1", opened="o2", reach=2)},
h AS (SELECT cell_x, cell_y FROM g WHERE (cell_x, cell_y) NOT IN (SELECT (cell_x, cell_y) FROM b2))
SELECT cell_x, cell_y, round(z, 9) AS z, FALSE AS filled FROM b2
UNION ALL SELECT h.cell_x, h.cell_y, round(avg(b2.z), 9), TRUE FROM h JOIN b2 ON abs(h.cell_x - b2.cell_x) <= 1 AND abs(h.cell_y - b2.cell_y) <= 1 GROUP BY ALL""")
def terrain_raster(spark, d):
    return surface.terrain(_cloud(spark, d), 0.05, reaches=(1, 2), step=0.02, fill_rounds=1).withColumn("z", F.round("z", 9))


@query(f"""{_CLOUD}, c AS (SELECT *, floor(x / 0.1)::BIGINT AS c0, floor(y / 0.1)::BIGINT AS c1, floor(z / 0.1)::BIGINT AS c2 FROM p), k AS (SELECT DISTINCT c0, c1, c2 FROM c)
SELECT k.c0, k.c1, k.c2, count(*) AS n, round(avg(x), 6) + 0.0 AS mx, round(avg(y), 6) + 0.0 AS my, round(avg(z), 6) + 0.0 AS mz FROM k JOIN c ON abs(c.c0 - k.c0) <= 1 AND abs(c.c1 - k.c1) <= 1 AND abs(c.c2 - k.c2) <= 1 GROUP BY ALL""")
def surroundings(spark, d):
    found = surface.local_planes(_cloud(spark, d), 0.1)
    return found.select(*[F.col(f"_c{i}").alias(f"c{i}") for i in range(3)], "n", *[(F.round(f"m{i}", 6) + 0.0).alias(f"m{a}") for i, a in enumerate("xyz")])


@query()
def smooth_on_planes(spark, d):
    """SQL has no eigenvectors; what the planes rest on is the query before."""
    return surface.smooth_on_planes(_cloud(spark, d), 0.1, flat=0.3)


# the second cloud lacks other trees than the first, and its trees have other names
_TREES = """, a AS (SELECT segment_id AS t, floor(x / 0.1)::BIGINT AS i, floor(y / 0.1)::BIGINT AS j, floor(z / 0.1)::BIGINT AS k, z FROM p WHERE seq % 3 <> 0 AND segment_id % 5 <> 0),
b AS (SELECT 1000 - segment_id AS t, floor(x / 0.1)::BIGINT AS i, floor(y / 0.1)::BIGINT AS j, floor(z / 0.1)::BIGINT AS k, z FROM p WHERE seq % 3 <> 1 AND segment_id % 5 <> 1),
o AS (SELECT u.t AS f, v.t AS s, count(*) AS shared FROM (SELECT DISTINCT t, i, j, k FROM a) u JOIN (SELECT DISTINCT t, i, j, k FROM b) v USING (i, j, k) GROUP BY u.t, v.t),
x AS (SELECT f, first(s ORDER BY shared DESC, s) AS s, max(shared) AS shared FROM o GROUP BY f), y AS (SELECT s, first(f ORDER BY shared DESC, f) AS f, max(shared) AS shared FROM o GROUP BY s),
m AS (SELECT x.f, x.s, x.shared FROM x JOIN y ON x.f = y.f AND x.s = y.s),
na AS (SELECT t, count(*) AS n, max(z) - min(z) AS h FROM a GROUP BY t), nb AS (SELECT t, count(*) AS n, max(z) - min(z) AS h FROM b GROUP BY t)"""


@query(f"""{_CLOUD}{_TREES} SELECT 'matched' AS state, f AS first, s AS second, NULL AS likeliest, shared, na.n AS n_first, nb.n AS n_second, round(nb.h - na.h, 6) AS growth FROM m JOIN na ON na.t = f JOIN nb ON nb.t = s
UNION ALL SELECT 'gone', na.t, NULL, x.s, coalesce(x.shared, 0), na.n, 0, NULL FROM na LEFT JOIN x ON x.f = na.t WHERE na.t NOT IN (SELECT f FROM m)
UNION ALL SELECT 'new', NULL, nb.t, y.f, coalesce(y.shared, 0), 0, nb.n, NULL FROM nb LEFT JOIN y ON y.s = nb.t WHERE nb.t NOT IN (SELECT s FROM m)""")
def tree_difference(spark, d):
    p = _cloud(spark, d)
    second = p.where("seq % 3 <> 1 and segment_id % 5 <> 1").withColumn("segment_id", 1000 - F.col("segment_id"))
    return trees.match(p.where("seq % 3 <> 0 and segment_id % 5 <> 0"), second, 0.1).withColumn("growth", F.round("growth", 6))


# the cloud was turned and moved far away, so registration gives the cloud itself
@query(f"{_CLOUD} SELECT seq, round(x, 3) + 0.0 AS x, round(y, 3) + 0.0 AS y, round(z, 3) + 0.0 AS z FROM p")
def register_far(spark, d):
    p = _cloud(spark, d)
    far = points.translate(points.rotate_z(p, 90), 7, -5, 3)
    moved, _ = registration.register(far, p, 0.05, 0.05, rounds=5)
    return moved.select("seq", *[(F.round(a, 3) + F.lit(0.0)).alias(a) for a in points.XYZ])
