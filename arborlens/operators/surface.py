"""Surfaces: smoothing onto local planes, and terrain from the lowest points, over sums of cells instead of pairs of points."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from arborlens.operators.points import XYZ, ground
from arborlens.operators.records import saved
from arborlens.operators.spatial import around, cells
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIRS = [(i, j) for i in range(3) for j in range(i, 3)]


def local_planes(df: DataFrame, cell: float) -> DataFrame:
    """Per occupied cell the plane through the points of it and the cells around: _c0 ..., their number n, mean m0 ..., unit normal n0 ..., and flatness, the smallest variance by the middle one (0: flat, 1: as thick as wide).

    Moments are summed by cell, and a cell's sums go to its 27 neighbours; places count from the cell's corner, so that far-off coordinates
    cost no digits.
    """
    names = [f"_c{i}" for i in range(3)]
    at = df.select(*[F.col(a).cast("double").alias(a) for a in XYZ], *cells(list(XYZ), cell)).dropna()
    off = [F.col(a) / F.lit(float(cell)) - F.col(c) for a, c in zip(XYZ, names, strict=True)]
    sums = at.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), *[F.sum(o).alias(f"s{i}") for i, o in enumerate(off)], *[F.sum(off[i] * off[j]).alias(f"q{i}{j}") for i, j in PAIRS])
    spread = sums.withColumn("_o", F.explode(around(3, 1)))
    # a neighbour's places count from its own corner, which lies back by the offset
    back = [-F.col(f"_o.o{i}").cast("double") for i in range(3)]
    first = {f"s{i}": F.col(f"s{i}") + F.col("n") * back[i] for i in range(3)}
    second = {f"q{i}{j}": F.col(f"q{i}{j}") + back[i] * F.col(f"s{j}") + back[j] * F.col(f"s{i}") + F.col("n") * back[i] * back[j] for i, j in PAIRS}
    moved = spread.select(*[(F.col(c) + F.col(f"_o.o{i}")).alias(c) for i, c in enumerate(names)], "n", *[v.alias(k) for k, v in (first | second).items()])
    total = moved.groupBy(*names).agg(*[F.sum(c).alias(c) for c in ("n", *first, *second)]).join(sums.select(*names), names, "left_semi")
    schema = ", ".join([f"{c} long" for c in names] + ["n long"] + [f"{k}{i} double" for k in "mn" for i in range(3)] + ["flatness double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = {name: b.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(b.schema.names)}
            n = v["n"].astype(float)
            mean = np.stack([v[f"s{i}"] / n for i in range(3)], 1)
            spread_ = np.empty((len(n), 3, 3))
            for i, j in PAIRS:
                spread_[:, i, j] = spread_[:, j, i] = v[f"q{i}{j}"] / n - mean[:, i] * mean[:, j]
            values, vectors = np.linalg.eigh(spread_)
            flat = np.where(values[:, 1] > 1e-12, np.maximum(values[:, 0], 0) / np.maximum(values[:, 1], 1e-12), 1.0)
            corner = np.stack([v[c] for c in names], 1)
            place = (mean + corner) * cell
            columns = [*(v[c] for c in names), v["n"], *place.T, *vectors[:, :, 0].T, flat]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=[*names, "n", *(f"{k}{i}" for k in "mn" for i in range(3)), "flatness"])

    return total.select(*names, "n", *first, *second).mapInArrow(run, schema)


def smooth_on_planes(df: DataFrame, cell: float, flat: float = 0.02, least_points: int = 6) -> DataFrame:
    """Moves each point along the normal onto the plane of its surroundings, if these are flat: edges, twigs and lone points, where no plane fits, stay.

    Nulls and rows of cells without enough points are returned as they are.
    """
    names = [f"_c{i}" for i in range(3)]
    planes = local_planes(df, cell).where((F.col("flatness") <= flat) & (F.col("n") >= least_points)).drop("n", "flatness")
    at = df.select("*", *cells(list(XYZ), cell)).join(planes, names, "left")
    height = reduce(lambda x, y: x + y, [(F.col(a) - F.col(f"m{i}")) * F.col(f"n{i}") for i, a in enumerate(XYZ)])
    moved = {a: F.coalesce(F.col(a) - height * F.col(f"n{i}"), F.col(a)) for i, a in enumerate(XYZ)}
    return at.select(*[moved[c].alias(c) if c in moved else F.col(c) for c in df.columns])


def _windowed(raster: DataFrame, reach: int, how: object) -> DataFrame:
    """Per cell of the raster the least or greatest z of the cells within reach: first along rows, then along columns, so a window of w cells a side costs 2 w rows, not w squared."""
    wide = lambda c: F.explode(F.sequence(F.col(c) - reach, F.col(c) + reach)).alias(c)
    keys = raster.select("cell_x", "cell_y")
    rows = raster.select(wide("cell_x"), "cell_y", "z").groupBy("cell_x", "cell_y").agg(how("z").alias("z"))
    columns = rows.select("cell_x", wide("cell_y"), "z").groupBy("cell_x", "cell_y").agg(how("z").alias("z"))
    return columns.join(keys, ["cell_x", "cell_y"])


def opening(raster: DataFrame, reach: int) -> DataFrame:
    """cell_x, cell_y, z of a raster after an opening by a square window of 2 reach + 1 cells: the greatest of the least. Cells without points take no part."""
    return _windowed(_windowed(raster, reach, F.min), reach, F.max)


def terrain(df: DataFrame, cell: float, reaches: tuple[int, ...] = (1, 2, 4, 8), slope: float = 0.3, step: float = 0.2, fill_rounds: int = 16) -> DataFrame:
    """A terrain raster: cell_x, cell_y, z and filled.

    The lowest point of each cell is opened with windows that grow; a cell that an opening lowers by more than step + slope times the window's reach is
    no ground (crowns, trunks, walls) and is left out from then on. Cells left out are then filled with the mean of their filled
    neighbours, ring by ring, until all are or fill_rounds are over; a patch of no ground so wide that rounds end before stays out.
    """
    lowest = saved(ground(df.where(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()), cell))
    bare = lowest
    for reach in reaches:
        opened = opening(bare, reach).withColumnRenamed("z", "_open")
        bare = saved(bare.join(opened, ["cell_x", "cell_y"]).where(F.col("z") - F.col("_open") <= step + slope * reach * cell).select("cell_x", "cell_y", "z"))
    done = bare.withColumn("filled", F.lit(False))
    holes = lowest.select("cell_x", "cell_y").join(bare, ["cell_x", "cell_y"], "left_anti")
    for _ in range(fill_rounds):
        done, holes = saved(done), saved(holes)
        if holes.isEmpty():
            break
        near = done.withColumn("_o", F.explode(around(2, 1, own=False))).select((F.col("cell_x") + F.col("_o.o0")).alias("cell_x"), (F.col("cell_y") + F.col("_o.o1")).alias("cell_y"), "z")
        filled = saved(near.join(holes, ["cell_x", "cell_y"]).groupBy("cell_x", "cell_y").agg(F.avg("z").alias("z")))
        if filled.isEmpty():
            break
        done = done.unionByName(filled.withColumn("filled", F.lit(True)))
        holes = holes.join(filled, ["cell_x", "cell_y"], "left_anti")
    return done


def above_ground(df: DataFrame, raster: DataFrame, cell: float) -> DataFrame:
    """df with height, the height over the terrain of its cell; null where there is none."""
    at = df.select("*", *[c.alias(n) for c, n in zip(cells(["x", "y"], cell), ("cell_x", "cell_y"), strict=True)])
    return at.join(raster.select("cell_x", "cell_y", F.col("z").alias("_ground")), ["cell_x", "cell_y"], "left").select(*df.columns, (F.col("z") - F.col("_ground")).alias("height"))
