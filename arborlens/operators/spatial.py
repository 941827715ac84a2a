"""Neighbour search on a grid: equi-joins on cells instead of a nested loop.

Cells are ints; a point's neighbours within the radius lie in the cells around its own. Exact
distances decide at the end, so the grid never changes a result.
"""

from __future__ import annotations

from functools import reduce
from itertools import product
from math import sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cells(axes: list[str], side: float) -> list[Column]:
    return [F.floor(F.col(a) / F.lit(side)).cast("bigint").alias(f"_c{i}") for i, a in enumerate(axes)]


def around(axes: int, reach: int, own: bool = True) -> Column:
    """All offsets of cells within reach along each axis, as an array of structs."""
    found = [o for o in product(range(-reach, reach + 1), repeat=axes) if own or any(o)]
    return F.array(*[F.struct(*[F.lit(v).cast("bigint").alias(f"o{i}") for i, v in enumerate(o)]) for o in found])


def square_distance(axes: list[str], a: str = "_a", b: str = "_b") -> Column:
    return reduce(lambda x, y: x + y, [F.pow(F.col(f"{a}{i}") - F.col(f"{b}{i}"), 2) for i in range(len(axes))])


def mark_near(df: DataFrame, axes: list[str], distance: float, name: str = "duplicated_xy", key: str = "seq") -> DataFrame:
    """Flags each row that has another row closer than ``distance``; null coordinates count as 0.

    Cells are so small that all points of one are closer than the distance. So every row of a
    cell of two rows or more is flagged by a count, and only rows alone in their cell look into the
    cells around: the work grows with the rows, not with the square of a crowd at one place.
    ``key`` tells rows apart.
    """
    side = distance / sqrt(len(axes)) * (1 - 1e-9)
    at = df.select(key, *[F.coalesce(F.col(a).cast("double"), F.lit(0.0)).alias(f"_a{i}") for i, a in enumerate(axes)])
    names = [f"_c{i}" for i in range(len(axes))]
    at = at.select("*", *cells([f"_a{i}" for i in range(len(axes))], side))
    counted = at.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_k"))
    crowded = counted.where("_n > 1").select(*names)
    alone = at.join(counted.where("_n = 1").select(F.col("_k").alias(key)), key, "left_semi")
    probes = alone.withColumn("_o", F.explode(around(len(axes), 2, own=False))).select(key, *[F.col(f"_a{i}") for i in range(len(axes))], *[(F.col(c) + F.col(f"_o.o{i}")).alias(c) for i, c in enumerate(names)])
    others = at.select(*[F.col(f"_a{i}").alias(f"_b{i}") for i in range(len(axes))], *names)
    near = probes.join(others, names).where(square_distance(axes) < distance * distance).select(key).distinct()
    flagged = at.join(crowded, names, "left_semi").select(key).unionByName(near).withColumn("_hit", F.lit(True))
    return df.join(flagged, key, "left").withColumn(name, F.coalesce("_hit", F.lit(False))).drop("_hit").select(*df.columns, name)


#: Points of a cell beyond which it is split; and splits, each halving the side, after which points are as good as in one place.
CAP, MOST_DEPTH = 32, 48


def crowded(df: DataFrame, axes: list[str], side: float) -> bool:
    """Whether a cell of that side holds more than CAP points."""
    at = df.groupBy(*cells(axes, side)).agg(F.count(F.lit(1)).alias("_n"))
    return not at.where(F.col("_n") > CAP).limit(1).isEmpty()


def tree(points: DataFrame, n: int, side: float) -> tuple[list[DataFrame], DataFrame]:
    """Cells that are split while they hold more than CAP points, with columns _b0 ... of the points' places.

    Returns the cells of each depth (side / 2 ** depth): _c0 ..., _n, their points' bounds _lo0, _hi0 ..., _leaf; and the points with their leaf's _depth and cell.
    """
    from arborlens.operators.records import saved

    names = [f"_c{i}" for i in range(n)]
    bounds = [f(f"_b{i}").alias(f"_{k}{i}") for i in range(n) for k, f in (("lo", F.min), ("hi", F.max))]
    rest, made, placed = saved(points), [], None
    for depth in range(MOST_DEPTH):
        at = rest.select("*", *cells([f"_b{i}" for i in range(n)], side / 2**depth))
        found = saved(at.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), *bounds).withColumn("_leaf", (F.col("_n") <= CAP) | F.lit(depth == MOST_DEPTH - 1)))
        made.append(found)
        mine = at.join(found.where("_leaf").select(*names), names).withColumn("_depth", F.lit(depth))
        placed = mine if placed is None else placed.unionByName(mine)
        if found.where("not _leaf").isEmpty():
            break
        rest = saved(at.join(found.where("not _leaf").select(*names), names, "left_semi").select(points.columns))
    return made, placed


def k_nearest(left: DataFrame, right: DataFrame, axes: list[str], radius: float, k: int, key: str = "seq", right_key: str = "seq", exclude_equal: bool = False) -> DataFrame:
    """For each left row its k nearest right rows within the radius: key, right_key as ``nearest``, distance, rank from 1. Equal distances go to the least right key.

    Right points lie in cells that are split where they crowd. Each left point starts with the cells around it and goes down: it leaves out a cell that is
    farther than the farthest bound of cells that hold k points together, and looks into those that are left,
    until all are leaves of at most CAP points. So a crowd costs each point some cells a depth, not all of its points.
    Of right points in one place only the k + 1 of least key take part.
    """
    from arborlens.operators.records import saved

    n, need = len(axes), k + 1 if exclude_equal else k
    names = [f"_c{i}" for i in range(n)]
    here = [f"_b{i}" for i in range(n)]
    b = right.select(F.col(right_key).alias("_rk"), *[F.col(x).cast("double").alias(c) for x, c in zip(axes, here, strict=True)]).dropna()
    w = Window.partitionBy(*here).orderBy("_rk")
    b = b.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1).drop("_r")
    depths, placed = tree(b, n, radius)
    gap = lambda i: F.greatest(F.col(f"_lo{i}") - F.col(f"_a{i}"), F.col(f"_a{i}") - F.col(f"_hi{i}"), F.lit(0.0))
    reach = lambda i: F.greatest(F.abs(F.col(f"_lo{i}") - F.col(f"_a{i}")), F.abs(F.col(f"_hi{i}") - F.col(f"_a{i}")))
    near = reduce(lambda x, y: x + y, [F.pow(gap(i), 2) for i in range(n)])
    far = reduce(lambda x, y: x + y, [F.pow(reach(i), 2) for i in range(n)])
    mine = ["_lk", *[f"_a{i}" for i in range(n)]]
    kept = [*mine, "_depth", *names, "_n", "_leaf", "_near", "_far"]
    by_far = Window.partitionBy("_lk").orderBy("_far").rowsBetween(Window.unboundedPreceding, 0)

    def pruned(found: DataFrame) -> DataFrame:
        reached = found.where(F.col("_near") <= radius * radius).withColumn("_sum", F.sum("_n").over(by_far))
        bound = F.coalesce(F.min(F.when(F.col("_sum") >= need, F.col("_far"))).over(Window.partitionBy("_lk")), F.lit(float("inf")))
        return reached.withColumn("_bound", bound).where("_near <= _bound").select(kept)

    a = left.select(F.col(key).alias("_lk"), *[F.col(x).cast("double").alias(f"_a{i}") for i, x in enumerate(axes)]).dropna()
    start = a.select("*", *cells([f"_a{i}" for i in range(n)], radius), F.explode(around(n, 1)).alias("_o")).select(*mine, *[(F.col(c) + F.col(f"_o.o{i}")).alias(c) for i, c in enumerate(names)])
    found = saved(pruned(start.join(depths[0], names).withColumns({"_near": near, "_far": far, "_depth": F.lit(0)})))
    for depth, below in enumerate(depths[1:], start=1):
        parents = below.select("*", *[F.expr(f"floor({c} / 2)").cast("bigint").alias(f"_p{i}") for i, c in enumerate(names)])
        open_ = found.where("not _leaf").select(*mine, *[F.col(c).alias(f"_p{i}") for i, c in enumerate(names)])
        opened = open_.join(parents, [f"_p{i}" for i in range(n)]).withColumns({"_near": near, "_far": far, "_depth": F.lit(depth)})
        found = saved(pruned(found.where("_leaf").unionByName(opened.select(kept))))
    pairs = found.select(*mine, "_depth", *names).join(placed, ["_depth", *names]).withColumn("_d", square_distance(axes)).where(F.col("_d") <= radius * radius)
    pairs = pairs.where("_lk <> _rk") if exclude_equal else pairs
    ranked = pairs.select("_lk", "_rk", "_d").withColumn("rank", F.row_number().over(Window.partitionBy("_lk").orderBy("_d", "_rk"))).where(F.col("rank") <= k)
    return ranked.select(F.col("_lk").alias(key), F.col("_rk").alias("nearest"), F.sqrt("_d").alias("distance"), "rank")


def nearest(left: DataFrame, right: DataFrame, axes: list[str], radius: float, key: str = "seq", right_key: str = "seq", exclude_equal: bool = False, crowds: bool | None = None) -> DataFrame:
    """For each left row the nearest right row within the radius: key, right_key as ``nearest``, distance. Equal distances go to the least right key.

    Where no cell of the radius' side holds more than CAP right points (looked up, unless crowds says so), a point is compared with those of the cells around; else
    by ``k_nearest``, which splits crowded cells. The result is the same.
    """
    if crowded(right, axes, radius) if crowds is None else crowds:
        return k_nearest(left, right, axes, radius, 1, key, right_key, exclude_equal).drop("rank")
    names = [f"_c{i}" for i in range(len(axes))]
    a = left.select(F.col(key).alias("_lk"), *[F.col(x).cast("double").alias(f"_a{i}") for i, x in enumerate(axes)])
    b = right.select(F.col(right_key).alias("_rk"), *[F.col(x).cast("double").alias(f"_b{i}") for i, x in enumerate(axes)])
    a = a.select("*", *cells([f"_a{i}" for i in range(len(axes))], radius), F.explode(around(len(axes), 1)).alias("_o"))
    a = a.select("_lk", *[f"_a{i}" for i in range(len(axes))], *[(F.col(c) + F.col(f"_o.o{i}")).alias(c) for i, c in enumerate(names)])
    b = b.select("*", *cells([f"_b{i}" for i in range(len(axes))], radius))
    near = a.join(b, names).withColumn("_d", square_distance(axes)).where(F.col("_d") <= radius * radius)
    near = near.where("_lk <> _rk") if exclude_equal else near
    best = near.groupBy("_lk").agg(F.min(F.struct("_d", "_rk")).alias("_m"))
    return best.select(F.col("_lk").alias(key), F.col("_m._rk").alias("nearest"), F.sqrt("_m._d").alias("distance"))


def thin(df: DataFrame, axes: list[str], distance: float, key: str = "seq", most_rounds: int = 100) -> DataFrame:
    """Keeps points at least ``distance`` apart: what going through them in order of ``key`` and dropping all too near a kept one gives.

    In each round the undecided points that come first among their undecided neighbours are
    kept, and their neighbours dropped, so all places of the cloud advance at once. Cells are so small that all points of one are
    closer than the distance: only the first of each can be kept, so it alone is compared with the cells around, and a
    crowd of any size costs a round some comparisons for each of its points. Null coordinates lie nowhere and are kept.
    """
    from arborlens.operators.records import saved

    n = len(axes)
    names, side = [f"_c{i}" for i in range(n)], distance / sqrt(n) * (1 - 1e-9)
    placed = df.select(F.col(key).alias("_k"), *[F.col(x).cast("double").alias(f"_a{i}") for i, x in enumerate(axes)]).dropna()
    open_ = saved(placed.select("*", *cells([f"_a{i}" for i in range(n)], side)))
    gone = open_.select("_k").limit(0)

    def beside(some: DataFrame, others: DataFrame, order: Column) -> DataFrame:
        """Pairs of some points with others nearer than the distance for which the order holds."""
        probes = some.withColumn("_o", F.explode(around(n, 2 if n < 4 else int(sqrt(n)) + 1))).select("_k", *[f"_a{i}" for i in range(n)], *[(F.col(c) + F.col(f"_o.o{i}")).alias(c) for i, c in enumerate(names)])
        b = others.select(F.col("_k").alias("_bk"), *[F.col(f"_a{i}").alias(f"_b{i}") for i in range(n)], *names)
        return probes.join(b, names).where((square_distance(axes) < distance * distance) & order)

    for _ in range(most_rounds):
        if open_.isEmpty():
            break
        first = open_.groupBy(*names).agg(F.min(F.struct("_k", *[f"_a{i}" for i in range(n)])).alias("_m")).select(F.col("_m._k").alias("_k"), *[F.col(f"_m._a{i}").alias(f"_a{i}") for i in range(n)], *names)
        later = beside(first, open_, F.col("_bk") < F.col("_k")).select("_k").distinct()
        kept = saved(first.join(later, "_k", "left_anti"))
        dropped = saved(beside(kept, open_, F.col("_bk") != F.col("_k")).select(F.col("_bk").alias("_k")).distinct())
        gone = gone.unionByName(dropped)
        open_ = saved(open_.join(kept.select("_k").unionByName(dropped), "_k", "left_anti"))
    else:
        raise RuntimeError("points still undecided")
    return df.join(gone.withColumnRenamed("_k", key), key, "left_anti")


def without_outliers(df: DataFrame, axes: list[str], radius: float, sigmas: float = 2.0, key: str = "seq", k: int = 1) -> DataFrame:
    """Drops points whose mean distance to their k nearest neighbours (a neighbour beyond the radius counts as at the radius) is over mean + sigmas standard deviations of all."""
    if k == 1:
        found = nearest(df, df, axes, radius, key, key, exclude_equal=True).select(key, F.col("distance").alias("_sum"), F.lit(1).alias("_n"))
    else:
        found = k_nearest(df, df, axes, radius, k, key, key, exclude_equal=True).groupBy(key).agg(F.sum("distance").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    mean = (F.coalesce("_sum", F.lit(0.0)) + (k - F.coalesce("_n", F.lit(0))) * F.lit(float(radius))) / k
    far = df.join(found, key, "left").withColumn("_d", mean)
    limit = far.agg((F.avg("_d") + F.lit(sigmas) * F.stddev_pop("_d")).alias("_limit"))
    return far.join(F.broadcast(limit)).where("_d <= _limit").select(df.columns)  # beside one row


def smooth(df: DataFrame, axes: list[str], cell: float, key: str = "seq") -> DataFrame:
    """Moves each point to the mean of the points of its cell and the cells around, weighted by count: cell sums first, so no pairs of points are made."""
    names = [f"_c{i}" for i in range(len(axes))]
    at = df.select("*", *cells(axes, cell))
    sums = at.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(x).cast("double")).alias(f"_s{i}") for i, x in enumerate(axes)])
    spread = sums.withColumn("_o", F.explode(around(len(axes), 1))).select("_n", *[f"_s{i}" for i in range(len(axes))], *[(F.col(c) + F.col(f"_o.o{i}")).alias(c) for i, c in enumerate(names)])
    means = spread.groupBy(*names).agg(*[(F.sum(f"_s{i}") / F.sum("_n")).alias(f"_m{i}") for i in range(len(axes))])
    joined = at.join(means, names)
    return joined.select(*[F.col(f"_m{axes.index(c)}").alias(c) if c in axes else F.col(c) for c in df.columns])

