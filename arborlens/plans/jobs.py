"""Point-cloud jobs: named steps from a cloud to a cloud."""

from __future__ import annotations

from arborlens.functions.geometry import Ring
from arborlens.operators import points, registration
from pyspark.sql import DataFrame


def voxelize(cloud: DataFrame, voxel: float = 0.005, mode: str = "center") -> DataFrame:
    return points.voxel_downsample(cloud, voxel, mode)


def tiled_voxelize(cloud: DataFrame, voxel: float = 0.02, tile: float = 10, buffer: float = 0) -> DataFrame:
    """Voxels with their tile. Tiling bounds no memory here, as a shuffle does that; it only clusters the result."""
    return points.tiles(points.voxel_downsample(cloud, voxel), tile, buffer)


def clip(cloud: DataFrame, rings: list[Ring]) -> DataFrame:
    return points.crop(cloud, rings)


def center(cloud: DataFrame) -> DataFrame:
    return points.center_cloud(cloud)


def align(fixed: DataFrame, moving: DataFrame, radius: float = 0.5, every: int = 1, coarse: float | None = None) -> DataFrame:
    """The moving cloud aligned with the fixed one; one point in ``every`` decides the matrix. With a cell for ``coarse``, clouds may lie anywhere and be turned about the upright axis."""
    sample = points.decimate(moving, every) if every > 1 else moving
    _, matrix = registration.register(sample, fixed, coarse, radius) if coarse else points.icp(sample, fixed, radius)
    return points.affine(moving, matrix.tolist())


def segmentation_input(cloud: DataFrame, voxel: float | None = 0.02, add_time: bool = False, ray: tuple[float, float, float] = (0.0, 0.0, -10.0)) -> DataFrame:
    """What tree segmentation starts from: voxels if asked for, a time column if there is none, ray starts."""
    out = points.voxel_downsample(cloud, voxel) if voxel else cloud
    out = points.ferry(out) if add_time else out
    return points.with_ray(out, ray)


def tree_report(segments: DataFrame, cell: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Per tree its numbers, and the density raster of the plot."""
    return points.segment_info(segments), points.density(segments, cell)
