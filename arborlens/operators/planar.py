"""Faces of line work, and points in many polygons, as joins.

Line work is a table of segments x1, y1, x2, y2 that meet at their ends alone. Polygons are rows: an id and rings, arrays of
arrays of (x, y), the outer ring and then holes; nothing of them goes into a plan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from arborlens.operators.records import saved, stored
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Directed sides that one task follows around their faces, about.
TASK_SIDES = 250_000
#: Rows of cells that a polygon is cut into: one for so many sides, within these bounds.
SIDES_PER_ROW, LEAST_ROWS, MOST_ROWS = 8, 8, 256


def _least_in_cycle(pointers: DataFrame) -> DataFrame:
    """Per _id the least _id on the cycle that _next leads around, as _face. In each round a row looks twice as far as before, so rounds grow with the logarithm of the longest cycle."""
    at = saved(pointers.select("_id", "_next", F.least("_id", "_next").alias("_face")))
    while True:
        far = at.select(F.col("_id").alias("_next"), F.col("_next").alias("_then"), F.col("_face").alias("_there"))
        step = saved(at.join(far, "_next").select("_id", F.col("_then").alias("_next"), F.least("_face", "_there").alias("_face"), (F.col("_there") < F.col("_face")).alias("_new")))
        at = step.drop("_new")
        # when no row finds less, the stretches that end where others begin agree all around
        if step.where("_new").isEmpty():
            return at.select("_id", "_face")


def _places(pointers: DataFrame) -> DataFrame:
    """Per _id its steps to the last row of its cycle (_left), the one before the row that names the cycle."""
    at = saved(pointers.select("_id", F.when(F.col("_next") != F.col("_face"), F.col("_next")).alias("_next"), F.when(F.col("_next") != F.col("_face"), 1).otherwise(0).cast("long").alias("_left")))
    while not at.where("_next is not null").isEmpty():
        far = at.select(F.col("_id").alias("_next"), F.col("_next").alias("_then"), F.col("_left").alias("_more"))
        at = saved(at.join(far, "_next", "left").select("_id", F.col("_then").alias("_next"), (F.col("_left") + F.coalesce("_more", F.lit(0))).alias("_left")))
    return at.select("_id", "_left")


def _around(following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pointers that lead around cycles or end at len(following): the least place on the cycle (len(following) on a chain that ends), and the steps to the last place before the least one."""
    n = len(following)
    least, jump = np.append(np.arange(n), n), np.append(following, n)
    for _ in range(n.bit_length()):
        least, jump = np.minimum(least, least[jump]), jump[jump]
    face = np.where(jump[:n] < n, least[:n], n)
    jump = np.append(np.where((following == face) | (face == n), n, following), n)
    left = (jump < n).astype(np.int64)
    for _ in range(n.bit_length()):
        left, jump = left + left[jump], jump[jump]
    return face, left[:n]


_FACES = "area double, n_sides long, ring array<struct<x:double,y:double>>"
_OPEN = ("ux", "uy", "ax", "ay", "bx", "by")


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The faces whose points all lie in the task, and, of the others, each side u -> a that comes in at a point of the task with the side a -> b that follows.

    Around a point the outgoing sides are sorted by angle; a side that comes in goes on along the one clockwise of its way back. A side with one such face on both sides bounds nothing;
    both its directions are then on that face, so that face alone is followed again without it.
    """
    batches = [x for x in batches if x.num_rows]
    if not batches:
        return
    held = pa.Table.from_batches(batches)
    ax, ay, bx, by = (held.column(c).to_numpy() for c in ("ax", "ay", "bx", "by"))
    order = np.lexsort((by, bx, np.arctan2(by - ay, bx - ax), ay, ax))
    ax, ay, bx, by = ax[order], ay[order], bx[order], by[order]
    n, a, b = len(ax), np.empty(len(ax), complex), np.empty(len(ax), complex)
    a.real, a.imag, b.real, b.imag = ax, ay, bx, by
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    last = np.append(first[1:], n) - 1
    before = np.arange(n) - 1
    before[first] = last
    points, node = a[first], np.repeat(np.arange(len(first)), last - first + 1)
    far = np.minimum(np.searchsorted(points, b), len(points) - 1)
    inside = points[far] == b
    key = node * len(points) + far
    here = np.flatnonzero(inside)
    by_key = here[np.argsort(key[here])]
    twin = np.full(n, n)
    twin[here] = by_key[np.searchsorted(key[by_key], far[here] * len(points) + node[here])]
    following = np.append(before, n)[twin]
    face, left = _around(following)
    closed = face < n
    loose = np.append(closed & (face == np.append(face, n)[twin]), False)
    outer = np.flatnonzero(~np.append(closed, False)[twin])
    if loose.any():
        while (hit := loose[following] & ~loose[:n]).any():
            following[hit] = before[following[hit]]
        kept = np.flatnonzero(closed & ~loose[:n])
        place = np.full(n + 1, len(kept))
        place[kept] = np.arange(len(kept))
        face, left = _around(place[following[kept]])
        ax, ay, bx, by = ax[kept], ay[kept], bx[kept], by[kept]
    else:
        kept = np.flatnonzero(closed)
        face, left = face[kept], left[kept]
        ax, ay, bx, by = ax[kept], ay[kept], bx[kept], by[kept]
    u, c = b[outer], b[before[outer]]
    opened = [u.real, u.imag, a.real[outer], a.imag[outer], c.real, c.imag]
    ring = np.lexsort((-left, face))
    starts = np.flatnonzero(np.append(True, np.diff(face[ring]) != 0)) if len(ring) else np.empty(0, np.int64)
    sizes = np.diff(starts, append=len(ring))
    area = np.add.reduceat(((ax * by - bx * ay) / 2)[ring], starts) if len(ring) else np.empty(0)
    good = area > 0
    ring = ring[np.repeat(good, sizes)]
    at = pa.StructArray.from_arrays([pa.array(ax[ring]), pa.array(ay[ring])], names=["x", "y"])
    rings = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes[good])).astype(np.int32)), at)
    names = ["area", "n_sides", "ring", *_OPEN]
    none = lambda m, k: pa.nulls(m, k)
    made, rest = int(good.sum()), len(outer)
    columns = [pa.array(area[good]), pa.array(sizes[good].astype(np.int64)), rings]
    yield from pa.Table.from_arrays([*columns, *[none(made, pa.float64())] * 6], names=names).to_batches(max_chunksize=10_000)
    yield from pa.Table.from_arrays([none(rest, c.type) for c in columns] + [pa.array(v) for v in opened], names=names).to_batches(max_chunksize=10_000)


def _without_loose(half: DataFrame, loose: DataFrame) -> DataFrame:
    """half without the loose sides: a side that a loose one follows goes on along the next one clockwise that isn't loose. Rounds grow with the logarithm of the loose sides around one point."""
    onward = half.select(F.col("_id").alias("_twin"), F.col("_next").alias("_then"))
    skip = saved(half.join(loose, "_id").select("_id", "_twin").join(onward, "_twin").select("_id", "_then"))
    far = lambda: skip.select(F.col("_id").alias("_then"), F.col("_then").alias("_more"))
    open_, now = None, skip.join(far(), "_then", "left_semi").count()
    # around points where all sides are loose nothing is ever found; elsewhere each round finds some
    while now != open_:
        skip = saved(skip.join(far(), "_then", "left").select("_id", F.coalesce("_more", "_then").alias("_then")))
        open_, now = now, skip.join(loose.select(F.col("_id").alias("_then")), "_then", "left_semi").count()
    past = skip.select(F.col("_id").alias("_next"), "_then")
    kept = half.join(loose, "_id", "left_anti").join(past, "_next", "left")
    return saved(kept.select("_id", "_twin", F.coalesce("_then", "_next").alias("_next"), "ax", "ay", "bx", "by"))


def _wide_faces(opened: DataFrame) -> DataFrame:
    """The bounded faces of the sides that no task could follow to the end: area, n_sides, ring."""
    keyed = saved(opened.withColumn("_id", F.monotonically_increasing_id()))
    named = lambda name, *ends: keyed.select(F.col("_id").alias(name), *[F.col(c).alias(e) for c, e in zip(("ux", "uy", "ax", "ay"), ends, strict=True)]).hint("merge")
    half = keyed.join(named("_next", "ax", "ay", "bx", "by"), ["ax", "ay", "bx", "by"]).join(named("_twin", "ax", "ay", "ux", "uy"), ["ux", "uy", "ax", "ay"], "left")
    half = saved(half.select("_id", "_twin", "_next", F.col("ux").alias("ax"), F.col("uy").alias("ay"), F.col("ax").alias("bx"), F.col("ay").alias("by")))
    faces = saved(half.join(_least_in_cycle(half), "_id"))
    other = faces.select(F.col("_id").alias("_twin"), F.col("_face").alias("_over"))
    loose = saved(faces.join(other, "_twin").where("_face = _over").select("_id"))
    if not loose.isEmpty():
        half = _without_loose(half, loose)
        faces = saved(half.join(_least_in_cycle(half), "_id"))
    cross = (F.col("ax") * F.col("by") - F.col("bx") * F.col("ay")) / 2
    bounded = faces.groupBy("_face").agg(F.sum(cross).alias("area"), F.count(F.lit(1)).alias("n_sides")).where("area > 0")
    mine = saved(faces.join(bounded, "_face"))
    placed = mine.join(_places(mine), "_id")
    ring = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_left")).alias("k"), F.col("ax").alias("x"), F.col("ay").alias("y")))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return placed.groupBy("_face").agg(F.first("area").alias("area"), F.first("n_sides").alias("n_sides"), ring.alias("ring")).drop("_face")


def polygonize(segments: DataFrame, task_sides: int = TASK_SIDES) -> DataFrame:
    """The bounded faces of line work: face_id, area, n_sides and ring, an array of (x, y) against the clock, the first point not repeated.

    Segments of no length and repeated ones count once or not at all; null coordinates are left out. Dead ends and bridges, which have the
    same face on both sides, bound nothing and go before faces are made. A part of the line work that lies within a face of another
    isn't cut out of it. Faces have no order; a ring must fit in a row, the unbounded face never becomes one.

    Sides are dealt by ranges of the points that they leave, about task_sides to a task, which follows the faces that lie within its
    range; only faces over several ranges are followed by joins, in rounds that look twice as far each time.
    """
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    ends = segments.select(*[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]).dropna()
    ends = ends.select(*[(F.col(c) + 0.0).alias(c) for c in ends.columns]).where(a != b)  # -0 is 0
    sides = ends.select(F.least(a, b).alias("p"), F.greatest(a, b).alias("q")).distinct()
    both = sides.select(F.explode(F.array(F.struct(F.col("p").alias("a"), F.col("q").alias("b")), F.struct(F.col("q").alias("a"), F.col("p").alias("b")))).alias("h"))
    out = both.select(*[F.col(f"h.{e}.{c}").alias(f"{e}{c}") for e in "ab" for c in "xy"])
    tasks = max(1, math.ceil(2 * ends.count() / task_sides))
    found = stored(out.repartitionByRange(tasks, "ax", "ay").mapInArrow(_trace, ", ".join([_FACES, *[f"{c} double" for c in _OPEN]])))
    faces, opened = found.where("n_sides is not null").select("area", "n_sides", "ring"), found.where("n_sides is null").select(*_OPEN)
    if not opened.isEmpty():
        faces = faces.unionByName(_wide_faces(opened))
    return faces.select(F.monotonically_increasing_id().alias("face_id"), "area", "n_sides", "ring")


def _sides(rings: Column) -> Column:
    """All sides of a polygon's rings, closed where they aren't."""
    pair = lambda r: F.transform(r, lambda p, i: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), F.get(r, (i + 1) % F.size(r))["x"].alias("x2"), F.get(r, (i + 1) % F.size(r))["y"].alias("y2")))
    return F.flatten(F.transform(rings, pair))


def _crossings(sides: Column, x: Column | None, y: Column) -> Column:
    """Where sides cross the height y, to the right of x if given."""
    at = lambda e: (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
    hit = F.filter(sides, lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (F.lit(True) if x is None else x < at(e)))
    return F.transform(hit, at)


def _sized(each: DataFrame) -> DataFrame:
    """Adds the size of a polygon's cells, _c = 2 ** _level, by its sides _s."""
    box = lambda f, a: f(F.transform("_s", lambda e: e[a]))
    size = F.greatest(box(F.array_max, "x1") - box(F.array_min, "x1"), box(F.array_max, "y1") - box(F.array_min, "y1"))
    rows = F.least(F.greatest(F.size("_s") / SIDES_PER_ROW, F.lit(float(LEAST_ROWS))), F.lit(float(MOST_ROWS)))
    level = F.when(size > 0, F.ceil(F.log2(size / rows))).otherwise(0).cast("int")
    return each.withColumn("_level", level).withColumn("_c", F.pow(F.lit(2.0), F.col("_level")))


def _strips(sized: DataFrame) -> DataFrame:
    """For each row of cells of a polygon (_pid, _cy; also _level and _c) the sides at its height, _row. A row is made from its polygon's row alone."""
    cell = lambda v: F.floor(v / F.col("_c")).cast("bigint")
    ends = F.transform("_s", lambda e: e["y1"])
    heights = sized.withColumn("_cy", F.explode(F.sequence(cell(F.array_min(ends)), cell(F.array_max(ends)))))
    at = F.filter("_s", lambda e: (cell(F.least(e["y1"], e["y2"])) <= F.col("_cy")) & (cell(F.greatest(e["y1"], e["y2"])) >= F.col("_cy")))
    return heights.select("_pid", "_level", "_c", "_cy", at.alias("_row")).where(F.size("_row") > 0)


def cover(sized: DataFrame) -> DataFrame:
    """The square cells that each polygon touches: _pid, _level (cells have sides of 2 ** _level), _cx, _cy, and _border: whether a side passes the cell; else it lies within.

    A polygon's cells fit its size and its number of sides: LEAST_ROWS to MOST_ROWS of them along its longer side. They come from the polygon's
    row without a shuffle, and hold none of its sides (see _strips).
    """
    at = _strips(sized)
    low, high = F.col("_cy") * F.col("_c"), (F.col("_cy") + 1) * F.col("_c")
    cell = lambda v: F.floor(v / F.col("_c")).cast("bigint")

    def passed(e: Column) -> Column:
        """Cells of the row that a side passes, a little widened."""
        left, right = F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])
        along = lambda y: F.when(e["y1"] == e["y2"], F.lit(None)).otherwise(e["x1"] + (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]))
        from_, to = along(F.greatest(F.least(e["y1"], e["y2"]), low)), along(F.least(F.greatest(e["y1"], e["y2"]), high))
        slack = F.col("_c") * 1e-9 + (F.abs(left) + F.abs(right)) * 4e-15
        return F.sequence(cell(F.greatest(left, F.coalesce(F.least(from_, to), left)) - slack), cell(F.least(right, F.coalesce(F.greatest(from_, to), right)) + slack))

    border = F.array_distinct(F.flatten(F.transform("_row", passed)))
    # cells within: their middle is within, and no side passes them
    cuts = F.array_sort(_crossings(F.col("_row"), None, (F.col("_cy") + 0.5) * F.col("_c")))

    def between(k: Column) -> Column:
        first, last = F.ceil(F.get("_x", k) / F.col("_c") - 0.5).cast("bigint"), F.floor(F.get("_x", k + 1) / F.col("_c") - 0.5).cast("bigint")
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    spans = F.flatten(F.transform(F.sequence(F.lit(0), F.size("_x") - 2, F.lit(2)), between))
    rows = at.select("_pid", "_level", "_c", "_cy", border.alias("_b"), cuts.alias("_x"))
    rows = rows.withColumn("_w", F.when(F.size("_x") > 1, F.array_except(spans, F.col("_b"))).otherwise(F.array().cast("array<bigint>")))
    marked = lambda c, v: F.transform(c, lambda x: F.struct(x.alias("x"), F.lit(v).alias("border")))
    cells = rows.select("_pid", "_level", "_cy", F.explode(F.concat(marked("_b", True), marked("_w", False))).alias("_k"))
    return cells.select("_pid", "_level", F.col("_k.x").alias("_cx"), "_cy", F.col("_k.border").alias("_border"))


def in_polygons(points: DataFrame, polygons: DataFrame, polygon: str = "polygon_id", rings: str = "rings", x: str = "x", y: str = "y") -> DataFrame:
    """points, once for each polygon that they lie in, with its id: by the parity of sides that a ray to the right crosses, so holes and rings in any direction will do.

    Rows of one id are one polygon; a row without id is left out. Polygons of equal rings are looked for once. Points and polygons meet by the cells that cover the
    polygons; only points in cells that a side passes are tested, against the sides at the cell's height. A point in no polygon has no row; null coordinates lie nowhere. Of neighbours that share
    a side, a point on it lies in one.

    Cells are many more than their polygons, which Spark's estimates of sizes don't see; so joins with them are merged, and none is collected for a broadcast.
    """
    whole = polygons.where(F.col(polygon).isNotNull()).groupBy(F.col(polygon).alias("_id")).agg(_sides(F.flatten(F.collect_list(rings))).alias("_s")).where(F.size("_s") > 0).withColumn("_h", F.xxhash64("_s"))
    shapes = saved(_sized(whole.groupBy("_h", "_s").agg(F.min("_id").alias("_pid"))))
    members = whole.hint("merge").join(shapes.select("_h", "_s", "_pid"), ["_h", "_s"]).select("_id", "_pid")
    # sizes of cells: a few numbers between the exponents of the smallest and the largest polygon
    levels = [r[0] for r in shapes.select("_level").distinct().collect()]
    if not levels:
        return points.select("*", F.lit(None).cast(polygons.schema[polygon].dataType).alias(polygon)).limit(0)
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    at = points.where(px.isNotNull() & py.isNotNull()).withColumn("_level", F.explode(F.array(*[F.lit(v).cast("int") for v in sorted(levels)])))
    at = at.withColumn("_cx", F.floor(px / F.pow(F.lit(2.0), F.col("_level"))).cast("bigint")).withColumn("_cy", F.floor(py / F.pow(F.lit(2.0), F.col("_level"))).cast("bigint"))
    met = at.join(cover(shapes).hint("merge"), ["_level", "_cx", "_cy"])
    # a cell within has no height to be tested at
    met = met.withColumn("_at", F.when(F.col("_border"), F.col("_cy"))).drop("_level", "_cx", "_cy")
    rows_at = _strips(shapes).select("_pid", F.col("_cy").alias("_at"), "_row")
    tested = met.join(rows_at.hint("merge"), ["_pid", "_at"], "left")
    hits = tested.where(~F.col("_border") | (F.size(_crossings(F.col("_row"), px, py)) % 2 == 1))
    return hits.join(members.hint("merge"), "_pid").select(*[f"`{c}`" for c in points.columns], F.col("_id").alias(polygon))
