"""Alignment of clouds that lie far apart: votes of coarse rasters over turns and shifts, before closest points decide the rest."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from arborlens.operators.points import XYZ, affine, cell_of, icp
from arborlens.operators.records import saved
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# a raster has at most so many cells along a side, so its size doesn't grow with the cloud
GRID = 256


def _frame(df: DataFrame) -> tuple[np.ndarray, float] | None:
    """The middle of a cloud's box and the half diagonal of its plan; None if it has no points."""
    row = df.agg(*[f(a).alias(f"{f.__name__}_{a}") for f in (F.min, F.max) for a in XYZ]).first()
    if any(v is None for v in row):
        return None
    low, high = (np.array([row[f"{f}_{a}"] for a in XYZ]) for f in ("min", "max"))
    return (low + high) / 2, float(np.hypot(*(high - low)[:2]) / 2)


def _columns(df: DataFrame, middle: np.ndarray, cell: float) -> DataFrame:
    """Per cell of the plan, around the middle: its place, its lowest point, and how many levels of its height are filled.

    Levels, not points, are the weight, so that a scanner's distance to a tree doesn't matter.
    """
    at = df.select(*[(F.col(a) - float(m)).alias(a) for a, m in zip(XYZ, middle, strict=True)])
    keys = [cell_of(a, cell).alias(f"_v{a}") for a in XYZ]
    voxels = at.groupBy(*keys).agg(F.min("z").alias("z"), F.avg("x").alias("x"), F.avg("y").alias("y"))
    return voxels.groupBy("_vx", "_vy").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.min("z").alias("z"), F.count(F.lit(1)).alias("weight"))


def _turned(df: DataFrame, radians: Column) -> DataFrame:
    c, s = F.cos(radians), F.sin(radians)
    return df.withColumns({"x": c * F.col("x") - s * F.col("y"), "y": s * F.col("x") + c * F.col("y")})


def _vote(key: tuple, moving: pd.DataFrame, fixed: pd.DataFrame) -> Iterable[pd.DataFrame]:
    """The shift at which the rasters of one turn agree most, by their correlation over all shifts."""
    size = 1
    span = max(int(max(d["i"].abs().max(), d["j"].abs().max())) for d in (moving, fixed)) + 1
    while size < 4 * span:
        size *= 2
    planes = []
    for d in (moving, fixed):
        plane = np.zeros((size, size))
        np.add.at(plane, (d["i"].to_numpy() % size, d["j"].to_numpy() % size), d["weight"].to_numpy(float))
        planes.append(plane)
    votes = np.fft.irfft2(np.conj(np.fft.rfft2(planes[0])) * np.fft.rfft2(planes[1]), s=(size, size))
    i, j = np.unravel_index(int(np.argmax(votes)), votes.shape)
    scale = float(np.sqrt((planes[0] ** 2).sum() * (planes[1] ** 2).sum()))
    back = lambda v: float(v - size if v >= size // 2 else v)
    return pd.DataFrame([(key[0], back(i), back(j), float(votes[i, j]) / scale)], columns=["turn", "i", "j", "score"])


def votes(moving: DataFrame, fixed: DataFrame, cell: float, turns: list[float]) -> DataFrame:
    """Per turn (degrees) the best shift in cells and its score, 0 to 1. Both are rasters of ``_columns``; each turn is a task of its own."""
    angle = F.explode(F.array(*[F.lit(float(t)) for t in turns])).alias("turn")
    raster = lambda df: df.groupBy("turn", cell_of("x", cell).alias("i"), cell_of("y", cell).alias("j")).agg(F.sum("weight").alias("weight"))
    ours = raster(_turned(moving.select("x", "y", "weight", angle), F.radians("turn")))
    theirs = raster(fixed.select("x", "y", "weight", angle))
    return ours.groupBy("turn").cogroup(theirs.groupBy("turn")).applyInPandas(lambda k, a, b: _vote(k, a, b), "turn double, i double, j double, score double")


def coarse(moving: DataFrame, fixed: DataFrame, cell: float, turns: int = 72, keep: int = 4) -> tuple[np.ndarray, float]:
    """The 4 x 4 matrix (a turn about the upright axis and a shift) that puts a cloud roughly onto another, and its score.

    All turns of the circle vote on rasters of the plan whose cells are as wide as half a step of turning
    moves the cloud's rim; then the ``keep`` best turns and those half a step beside them vote on finer
    ones, until cells are ``cell`` wide. The height comes from the median difference of the lowest points
    of common cells. ``cell`` grows where the clouds are wider than GRID cells, so that a raster is bounded
    whatever the clouds hold: the points are only passed for their boxes and for the rasters. Of equal
    scores the smallest turn counts. Rows without coordinates count nowhere; without points in either cloud
    nothing moves.
    """
    if cell <= 0 or turns < 1 or keep < 1:
        raise ValueError("cell must be over 0, turns and keep at least 1")
    moving, fixed = (df.select(*[F.col(a).cast("double").alias(a) for a in XYZ]).dropna() for df in (moving, fixed))
    ours, theirs = _frame(moving), _frame(fixed)
    if ours is None or theirs is None:
        return np.eye(4), 0.0
    reach = max(ours[1], theirs[1])
    cell = max(cell, 2 * reach / GRID)
    # half cells, so that turning a raster's cells moves little between them
    a, b = saved(_columns(moving, ours[0], cell / 2).coalesce(8)), saved(_columns(fixed, theirs[0], cell / 2).coalesce(8))
    step, tried = 360.0 / turns, [k * 360.0 / turns for k in range(turns)]
    while True:
        wide = max(cell, reach * np.radians(step) / 2)
        ranked = sorted(votes(a, b, wide, tried).collect(), key=lambda r: (-r["score"], r["turn"] % 360))  # a row for each turn
        if wide <= cell:
            break
        step /= 2
        tried = sorted({(r["turn"] + k * step) % 360 for r in ranked[:keep] for k in (-1, 0, 1)})
    best = ranked[0]
    at = _turned(a, F.radians(F.lit(best["turn"])))
    lowest = lambda df, x, y, name: df.groupBy(cell_of(x, cell).alias("i"), cell_of(y, cell).alias("j")).agg(F.min("z").alias(name))
    moved = lowest(at, F.col("x") + best["i"] * cell, F.col("y") + best["j"] * cell, "za")
    lift = moved.join(lowest(b, "x", "y", "zb"), ["i", "j"]).agg(F.median(F.col("zb") - F.col("za"))).first()[0] or 0.0
    matrix, c, s = np.eye(4), np.cos(np.radians(best["turn"])), np.sin(np.radians(best["turn"]))
    matrix[:2, :2] = [[c, -s], [s, c]]
    matrix[:3, 3] = theirs[0] + [best["i"] * cell, best["j"] * cell, lift] - matrix[:3, :3] @ ours[0]
    return matrix, best["score"]


def register(moving: DataFrame, fixed: DataFrame, cell: float, radius: float, turns: int = 72, rounds: int = 20) -> tuple[DataFrame, np.ndarray]:
    """A cloud put onto another from any turn about the upright axis and any shift, and the matrix that does it: ``coarse``, then ``icp``."""
    first, _ = coarse(moving, fixed, cell, turns)
    _, then = icp(affine(moving, first.tolist()), fixed, radius, rounds)
    total = then @ first
    return affine(moving, total.tolist()), total
