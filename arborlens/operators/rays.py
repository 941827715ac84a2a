"""Rays of a cloud (starts sx, sy, sz; ends x, y, z; gps_time) in voxels anchored at 0."""

from __future__ import annotations

from arborlens.operators.points import XYZ, cell_of
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def passed(cell: float) -> Column:
    """The voxels that a ray passes before the one that it ends in, an array of (vx, vy, vz).

    A ray crosses the planes between voxels at parameters from 0 to 1; in order, these cut it into stretches of one
    voxel each, told by the stretch's middle. A stretch of no length is no passage. A ray along a plane between
    voxels passes those above it. Null where a coordinate is null.
    """

    def crossings(a: str) -> Column:
        d = F.col(a) - F.col(f"s{a}")
        low, high = F.least(F.col(a), F.col(f"s{a}")), F.greatest(F.col(a), F.col(f"s{a}"))
        first, last = F.floor(low / F.lit(float(cell))).cast("bigint") + 1, F.ceil(high / F.lit(float(cell))).cast("bigint") - 1
        return F.when(d.isNull(), None).when((d == 0) | (first > last), F.array().cast("array<double>")).otherwise(F.transform(F.sequence(first, last), lambda k: (k * F.lit(float(cell)) - F.col(f"s{a}")) / d))

    at = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), *[crossings(a) for a in XYZ])))
    middles = lambda t: F.transform(F.sequence(F.lit(0), F.size(t) - 2), lambda i: (F.get(t, i) + F.get(t, i + 1)) / 2)
    voxel = lambda m: F.struct(*[F.floor((F.col(f"s{a}") + m * (F.col(a) - F.col(f"s{a}"))) / F.lit(float(cell))).cast("bigint").alias(f"v{a}") for a in XYZ])
    own = F.struct(*[cell_of(a, cell).alias(f"v{a}") for a in XYZ])
    return F.filter(F.array_distinct(F.transform(middles(at), voxel)), lambda v: v != own)


def passages(df: DataFrame, cell: float) -> DataFrame:
    """Per voxel that any ray passed: vx, vy, vz, the number of rays and the time of the last. Tasks add up before the shuffle, so a voxel beside the scanner, which all rays pass, is a few rows."""
    return df.select("gps_time", F.explode(passed(cell)).alias("v")).groupBy("v.vx", "v.vy", "v.vz").agg(F.count(F.lit(1)).alias("n_rays"), F.max("gps_time").alias("last_time"))


def without_passed(df: DataFrame, cell: float, least_rays: int = 1) -> DataFrame:
    """Points but those whose voxel a later ray passed, through which there was nothing any more: moving things, seen once.

    least_rays: so many rays must have passed the voxel in all. Points without time or place stay.
    """
    seen = passages(df, cell).where(F.col("n_rays") >= least_rays)
    at = df.select("*", *[cell_of(a, cell).alias(f"v{a}") for a in XYZ])
    joined = at.join(seen, [f"v{a}" for a in XYZ], "left")
    return joined.where(~F.coalesce(F.col("last_time") > F.col("gps_time"), F.lit(False))).select(df.columns)
