"""Point clouds as DataFrames: seq, x, y, z and attributes; seq is the order of ingest. Grids are anchored at 0."""

from __future__ import annotations

import numpy as np
from arborlens.functions.geometry import Ring, inside
from arborlens.operators.spatial import crowded, nearest
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

XYZ = ("x", "y", "z")


def cell_of(c: str | Column, size: float) -> Column:
    return F.floor((F.col(c) if isinstance(c, str) else c) / F.lit(float(size))).cast("bigint")


def voxel_downsample(df: DataFrame, cell: float, mode: str = "center", seq: str = "seq", axes: tuple[str, ...] = XYZ) -> DataFrame:
    """One point per occupied voxel: its centre, its ``first`` point, or the ``mean``; other columns are those of the first point. Partial aggregation makes each task's voxels small before the shuffle."""
    if cell <= 0 or mode not in ("center", "first", "mean"):
        raise ValueError("cell must be over 0, mode one of center, first, mean")
    keys = [cell_of(a, cell).alias(f"_v{i}") for i, a in enumerate(axes)]
    first = [F.min_by(c, seq).alias(c) for c in df.columns if mode == "first" or c not in axes]
    means = [F.avg(a).alias(a) for a in axes] if mode == "mean" else []
    out = df.groupBy(*keys).agg(*first, *means)
    if mode == "center":
        out = out.select("*", *[((F.col(f"_v{i}") + 0.5) * F.lit(float(cell))).alias(a) for i, a in enumerate(axes)])
    return out.select(df.columns)


def tiles(df: DataFrame, size: float, buffer: float = 0.0) -> DataFrame:
    """df with tile_x, tile_y and is_buffer: each point in its own tile and, as a buffer copy, in each tile whose buffered square it lies in."""
    tx, ty = cell_of("x", size), cell_of("y", size)
    if buffer <= 0:
        return df.withColumn("tile_x", tx).withColumn("tile_y", ty).withColumn("is_buffer", F.lit(False))
    span = lambda c: F.sequence(cell_of(F.col(c) - buffer, size), cell_of(F.col(c) + buffer, size))
    out = df.withColumn("tile_x", F.explode(span("x"))).withColumn("tile_y", F.explode(span("y")))
    return out.withColumn("is_buffer", (F.col("tile_x") != tx) | (F.col("tile_y") != ty))


def crop(df: DataFrame, rings: list[Ring]) -> DataFrame:
    """Points in the polygon; the box of the outer ring reaches the scan as a pushed-down filter."""
    xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
    if not xs:
        return df.limit(0)
    return df.where(F.col("x").between(min(xs), max(xs)) & F.col("y").between(min(ys), max(ys))).where(inside(F.col("x"), F.col("y"), rings))


def affine(df: DataFrame, matrix: list[list[float]], axes: tuple[str, ...] = XYZ) -> DataFrame:
    """Applies the upper three rows of a 4 x 4 matrix."""
    moved = {a: sum((F.col(b) * float(matrix[i][j]) for j, b in enumerate(axes)), F.lit(0.0)) + float(matrix[i][3]) for i, a in enumerate(axes)}
    return df.select(*[moved[c].alias(c) if c in moved else F.col(c) for c in df.columns])


def translate(df: DataFrame, dx: float = 0, dy: float = 0, dz: float = 0) -> DataFrame:
    return affine(df, [[1, 0, 0, dx], [0, 1, 0, dy], [0, 0, 1, dz]])


def rotate_z(df: DataFrame, degrees: float) -> DataFrame:
    c, s = float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))
    return affine(df, [[c, -s, 0, 0], [s, c, 0, 0], [0, 0, 1, 0]])


def rotate(df: DataFrame, axis: tuple[float, float, float], degrees: float) -> DataFrame:
    """Turns a cloud about an axis through 0."""
    x, y, z = np.array(axis, float) / np.linalg.norm(axis)
    k = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
    turn = np.eye(4)
    turn[:3, :3] = np.eye(3) + np.sin(np.radians(degrees)) * k + (1 - np.cos(np.radians(degrees))) * k @ k
    return affine(df, turn.tolist())


def combine(clouds: list[DataFrame], cell: float, order: Column) -> DataFrame:
    """One cloud from several: of each voxel the points of the cloud whose least ``order`` (a column of the points) there is least; equal ones go to the cloud listed first."""
    marked = [c.withColumn("_cloud", F.lit(i)) for i, c in enumerate(clouds)]
    every = marked[0]
    for c in marked[1:]:
        every = every.unionByName(c)
    keys = [f"_v{i}" for i in range(len(XYZ))]
    at = every.select("*", *[cell_of(a, cell).alias(k) for a, k in zip(XYZ, keys, strict=True)])
    first = at.groupBy(*keys).agg(F.min(F.struct(order.alias("o"), F.col("_cloud").alias("c"))).getField("c").alias("_cloud"))
    return at.join(first, [*keys, "_cloud"], "left_semi").select(clouds[0].columns)


def difference(a: DataFrame, b: DataFrame, cell: float) -> DataFrame:
    """Voxels that either cloud occupies: points of each, and whether the voxel is common, only in the first, or only in the second."""
    keys = [cell_of(x, cell).alias(f"v{x}") for x in XYZ]
    count = lambda df, n: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    both = count(a, "n_first").join(count(b, "n_second"), [f"v{x}" for x in XYZ], "full")
    filled = both.fillna(0, ["n_first", "n_second"])
    return filled.withColumn("state", F.when(F.col("n_second") == 0, "removed").when(F.col("n_first") == 0, "added").otherwise("common"))


def colour_by(df: DataFrame, column: str, low: tuple[int, int, int] = (0, 0, 255), high: tuple[int, int, int] = (255, 0, 0)) -> DataFrame:
    """r, g, b on the line from low to high by the column's place between its least and greatest value (all low where these are equal); null where it is null. The bounds are one row."""
    bounds = df.agg(F.min(column).cast("double").alias("_lo"), F.max(column).cast("double").alias("_hi"))
    place = F.when(F.col(column).isNotNull(), F.when(F.col("_hi") > F.col("_lo"), (F.col(column) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(0.0))
    out = df.join(F.broadcast(bounds))
    shades = {c: F.floor(F.lit(a) + place * F.lit(b - a) + F.lit(0.5)).cast("int") for c, a, b in zip("rgb", low, high, strict=True)}
    return out.withColumns(shades).drop("_lo", "_hi")


def prune(df: DataFrame, least_height: float, segment: str = "segment_id") -> DataFrame:
    """Points of trees that are at least so high, from their lowest point to their highest."""
    tall = segment_info(df, segment).where(F.col("height") >= least_height).select(segment)
    return df.join(tall, segment, "left_semi").select(df.columns)


def ferry(df: DataFrame, source: str = "x", target: str = "gps_time") -> DataFrame:
    return df.withColumn(target, F.col(source))


def decimate(df: DataFrame, n: int, seq: str = "seq") -> DataFrame:
    """Every n-th point, from the one numbered 0."""
    return df.where(F.col(seq) % n == 0)


def sampled_until(df: DataFrame, accept: object, steps: tuple[int, ...] = (1, 4, 6, 8, 10)) -> tuple[DataFrame, int]:
    """The least decimation that ``accept`` (a test on the DataFrame) allows."""
    for n in steps:
        if accept(out := df if n == 1 else decimate(df, n)):
            return out, n
    raise RuntimeError(f"not accepted at one in {steps[-1]}")


def first_point(df: DataFrame, seq: str = "seq") -> DataFrame:
    return df.orderBy(seq).limit(1)


def cloud_info(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), *[f(a).alias(f"{n}_{a}") for a in XYZ for n, f in (("min", F.min), ("max", F.max))])


def center_cloud(df: DataFrame) -> DataFrame:
    """Moves the middle of x and y, and the least z, to 0. The bounds are one row, beside which the points stay where they are."""
    bounds = df.agg(((F.min("x") + F.max("x")) / 2).alias("_x"), ((F.min("y") + F.max("y")) / 2).alias("_y"), F.min("z").alias("_z"))
    out = df.join(F.broadcast(bounds))
    return out.select(*[(F.col(c) - F.col(f"_{c}")).alias(c) if c in XYZ else F.col(c) for c in df.columns])


def mean_center(df: DataFrame) -> DataFrame:
    means = df.agg(*[F.avg(a).alias(f"_{a}") for a in XYZ])
    out = df.join(F.broadcast(means))
    return out.select(*[(F.col(c) - F.col(f"_{c}")).alias(c) if c in XYZ else F.col(c) for c in df.columns])


def segment_info(df: DataFrame, segment: str = "segment_id") -> DataFrame:
    """Per tree: points, bounds and height."""
    aggs = [f(a).alias(f"{n}_{a}") for a in XYZ for n, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("n"), *aggs, (F.max("z") - F.min("z")).alias("height"))


def segment_of_colour(df: DataFrame, name: str = "segment_id") -> DataFrame:
    """One number for each colour (r, g, b)."""
    return df.withColumn(name, F.shiftleft(F.col("r").cast("bigint"), 16) + F.shiftleft(F.col("g").cast("bigint"), 8) + F.col("b"))


def split(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """The points for which the condition holds, and all others (null included)."""
    hit = F.coalesce(condition, F.lit(False))
    return df.where(hit), df.where(~hit)


def density(df: DataFrame, cell: float) -> DataFrame:
    """Points per square cell, the data of a density image."""
    return df.groupBy(cell_of("x", cell).alias("cell_x"), cell_of("y", cell).alias("cell_y")).agg(F.count(F.lit(1)).alias("n"))


def ground(df: DataFrame, cell: float) -> DataFrame:
    """Lowest point of each cell: an approximate terrain raster."""
    return df.groupBy(cell_of("x", cell).alias("cell_x"), cell_of("y", cell).alias("cell_y")).agg(F.min("z").alias("z"))


def restore(decimated: DataFrame, full: DataFrame, cell: float, columns: list[str]) -> DataFrame:
    """Gives each point of the full cloud the named columns of its voxel's point in the decimated one."""
    keyed = lambda df: df.select("*", *[cell_of(a, cell).alias(f"_v{a}") for a in XYZ])
    labels = keyed(decimated).groupBy(*[f"_v{a}" for a in XYZ]).agg(*[F.min_by(c, "seq").alias(c) for c in columns])
    return keyed(full.drop(*columns)).join(labels, [f"_v{a}" for a in XYZ], "left").drop(*[f"_v{a}" for a in XYZ])


def without_transients(df: DataFrame, cell: float, least_span: float) -> DataFrame:
    """Points of voxels that were seen over at least the time span."""
    keys = [f"_v{a}" for a in XYZ]
    at = df.select("*", *[cell_of(a, cell).alias(f"_v{a}") for a in XYZ])
    lasting = at.groupBy(*keys).agg((F.max("gps_time") - F.min("gps_time")).alias("_s")).where(F.col("_s") >= least_span).select(*keys)
    return at.join(lasting, keys, "left_semi").select(df.columns)


def with_ray(df: DataFrame, vector: tuple[float, float, float] = (0.0, 0.0, -10.0)) -> DataFrame:
    """Ray starts sx, sy, sz: each point less a fixed ray vector."""
    return df.select("*", *[(F.col(a) - F.lit(float(v))).alias(f"s{a}") for a, v in zip(XYZ, vector, strict=True)])


def ray_ends(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A ray cloud's points, and its starts as a trajectory (time, x, y, z)."""
    return df.drop("sx", "sy", "sz"), df.select(F.col("gps_time").alias("time"), *[F.col(f"s{a}").alias(a) for a in XYZ])


def as_of(left: DataFrame, right: DataFrame, left_time: str, right_time: str, columns: list[str], by: list[str], width: float | None = None) -> DataFrame:
    """left with the columns of the right row of equal ``by`` whose time is the latest up to its own.

    One sort of both sides together: the last value seen is carried along. Right rows come before
    left rows of the same time; several of one time count as their last in order of the columns.
    ``width`` cuts time (a number) into spans, each a task's work, for a trajectory without keys or with few of
    them: the last right row of each span is handed on through a table of a row per span.
    """
    value = right.select(F.struct(*columns)).schema[0].dataType
    span = lambda t: F.floor(F.col(t).cast("double") / F.lit(float(width))).cast("bigint") if width else F.lit(0).cast("bigint")
    a = left.select("*", F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(value).alias("_v"), span(left_time).alias("_span"))
    empty = [F.col(c) if c in by else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns]
    b = right.select(*empty, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.struct(*columns).alias("_v"), span(right_time).alias("_span"))
    both = a.unionByName(b)
    if width:
        lasts = both.groupBy(*by, "_span").agg(F.max(F.when(F.col("_side") == 0, F.struct("_t", "_v"))).alias("_m"))
        before = F.last(F.col("_m._v"), ignorenulls=True).over(Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1))  # over a row per span
        handed = lasts.select(*by, "_span", before.alias("_v")).where("_v is not null")
        none = [F.col(c) if c in by else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns]
        both = both.unionByName(handed.select(*none, F.lit(None).cast(a.schema["_t"].dataType).alias("_t"), F.lit(0).alias("_side"), "_v", "_span"))
    # what is handed on has no time, and nulls come first
    w = Window.partitionBy(*by, "_span").orderBy("_t", "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_last", F.last("_v", ignorenulls=True).over(w)).where("_side = 1")
    return out.select(*left.columns, *[F.col(f"_last.{c}").alias(c if c not in left.columns else f"{c}_right") for c in columns])


def icp(moving: DataFrame, fixed: DataFrame, radius: float, rounds: int = 20, tolerance: float = 1e-6) -> tuple[DataFrame, np.ndarray]:
    """Moves a cloud onto another by iterated closest points; returns it and the 4 x 4 matrix.

    Each round is a grid join and sums; the driver sees 3 x 3 moments and solves them.
    """
    total = np.eye(4)
    at, crowds = moving, crowded(fixed, list(XYZ), radius)
    for _ in range(rounds):
        pairs = nearest(at, fixed, list(XYZ), radius, crowds=crowds)
        p = at.select("seq", *[F.col(a).alias(f"p{a}") for a in XYZ]).join(pairs, "seq").join(fixed.select(F.col("seq").alias("nearest"), *[F.col(a).alias(f"q{a}") for a in XYZ]), "nearest")
        row = p.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"{s}{a}").alias(f"{s}{a}") for s in "pq" for a in XYZ], *[F.avg(F.col(f"p{a}") * F.col(f"q{b}")).alias(f"m{a}{b}") for a in XYZ for b in XYZ]).first()
        if not row["n"] or row["n"] < 3:
            break
        mp, mq = (np.array([row[f"{s}{a}"] for a in XYZ]) for s in "pq")
        h = np.array([[row[f"m{a}{b}"] for b in XYZ] for a in XYZ]) - np.outer(mp, mq)
        u, _, vt = np.linalg.svd(h)
        r = vt.T @ np.diag([1, 1, np.sign(np.linalg.det(vt.T @ u.T))]) @ u.T
        step = np.eye(4)
        step[:3, :3], step[:3, 3] = r, mq - r @ mp
        total = step @ total
        at = affine(moving, total.tolist())
        if np.abs(step - np.eye(4)).max() < tolerance:
            break
    return at, total


def regular_cloud(spark: object, n: int, step: float = 1.0) -> DataFrame:
    """A synthetic cloud of n ** 3 points on a lattice."""
    i = F.col("id")
    return spark.range(n**3).select(i.alias("seq"), *[(F.expr(f"id div {n**k} % {n}") * step).cast("double").alias(a) for k, a in enumerate(XYZ)])
