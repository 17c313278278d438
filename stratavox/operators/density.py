"""Density images: spots, Gaussian density by separable sums on bricks, colour ramp."""

from __future__ import annotations

from math import exp

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import to_bricks
from .kernels import cell_rows, halo_at, line_sums, with_halo
from .voxels import KEY, mask_to, overlay

SCALE = 10_000


def rasterize_spots(spots: DataFrame, height: int, width: int, radius: int = 3, by: list[str] | None = None) -> DataFrame:
    """(y, x, value 255): cells whose squared distance to a spot's truncated centre is below radius squared.

    by: columns that name the image of a spot, each an image of its own.
    """
    by = by or []
    c = spots.select(*by, F.col("y").cast("int").alias("cy"), F.col("x").cast("int").alias("cx"))
    reach = F.sequence(F.lit(-radius), F.lit(radius))
    cells = c.withColumn("dy", F.explode(reach)).withColumn("dx", F.explode(reach)).filter(F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx") < radius * radius)
    at = cells.select(*by, (F.col("cy") + F.col("dy")).alias("y"), (F.col("cx") + F.col("dx")).alias("x"))
    return at.filter(F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1)).distinct().withColumn("value", F.lit(255))


def kernel(sigma: float, reach: int = 5) -> list[tuple[int, int]]:
    """(offset, weight): exp(-d^2 / 2 sigma^2), not normalised, in units of 1 / SCALE."""
    return [(d, int(exp(-d * d / (2 * sigma * sigma)) * SCALE + 0.5)) for d in range(-reach, reach + 1)]


#: Bricks that kernels run on.
CHUNK = (64, 128, 128)


def heat_bricks(signal: DataFrame, shape: tuple[int, int, int], sigma: float = 1.5, alpha: float = 1.0, chunk: tuple[int, int, int] = CHUNK) -> DataFrame:
    """Bricks (doubles) of alpha times the Gaussian sum over the cells of signal bricks within 5, inside the volume."""
    return with_halo(signal, shape, chunk, *_heat(sigma, alpha))


def _heat(sigma: float, alpha: float):
    """The reach of the Gaussian sum, and the sum."""
    weights = [w for _, w in kernel(sigma)]
    return (len(weights) // 2,) * 3, lambda cells: line_sums(cells, weights) / float(SCALE) ** 3 * alpha


def heat_at(signal: DataFrame, where: DataFrame, shape: tuple[int, int, int], sigma: float = 1.5, alpha: float = 1.0, chunk: tuple[int, int, int] = CHUNK) -> DataFrame:
    """(z, y, x, value) of heat_bricks where the bricks of where, cut by ``chunk``, are not 0 and the heat is not."""
    return halo_at(signal, where, shape, chunk, *_heat(sigma, alpha))


def heat_density(signal: DataFrame, atlas: DataFrame, shape: tuple[int, int, int], sigma: float = 1.5, alpha: float = 1.0, chunk: tuple[int, int, int] = CHUNK) -> DataFrame:
    """(z, y, x, value): alpha times the Gaussian sum over signal voxels of the atlas within 5 cells, inside the volume."""
    return cell_rows(heat_bricks(to_bricks(mask_to(signal, atlas), shape, chunk, "<i4"), shape, sigma, alpha, chunk), "double")


def colour_ramp(heat: DataFrame) -> DataFrame:
    """r, g, b of each value: blue up to 255, then red joins, then blue fades; clipped and truncated."""
    v = F.col("value")
    red = F.when(v > 255, v - 255).otherwise(0.0)
    blue = F.when(v <= 255, v).when(v <= 510, 255.0).otherwise(255 - (v - 510))
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(255.0)).cast("int")
    return heat.select(*KEY, clip(red).alias("r"), F.lit(0).alias("g"), clip(blue).alias("b"))


def heat_rgb(heat: DataFrame, edge: DataFrame, atlas: DataFrame) -> DataFrame:
    """Colour ramp, then the edge drawn over it, then masked to the atlas."""
    return mask_to(overlay(colour_ramp(heat), edge), atlas)


def mean_heat(heats: DataFrame, samples: int) -> DataFrame:
    """Mean over samples; an absent voxel counts as 0."""
    return heats.groupBy(*KEY).agg((F.sum("value") / samples).alias("value"))


def gaussian_bricks(bricks: DataFrame, shape: tuple[int, int, int], sigma: float = 1.0, slab: int | None = None, whole: bool = False, chunk: tuple[int, int, int] = CHUNK) -> DataFrame:
    """Bricks of the normalised Gaussian of radius int(4 sigma + 1/2) with mirrored borders, planes mirrored in each slab.

    whole: values stay whole numbers, cut off after each axis, as those of an integer image do.
    """
    reach = int(4 * sigma + 0.5)
    w = [exp(-d * d / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    weights = [int(x / sum(w) * SCALE + 0.5) for x in w]
    chunk = (slab, *chunk[1:]) if slab else chunk
    smooth = lambda cells: line_sums(cells, weights, SCALE) if whole else line_sums(cells, weights) / float(SCALE) ** 3
    return with_halo(bricks, shape, chunk, (reach,) * 3, smooth, "symmetric", bool(slab))


def gaussian_smooth(vox: DataFrame, shape: tuple[int, int, int], sigma: float = 1.0, slab: int | None = None, whole: bool = False, chunk: tuple[int, int, int] = CHUNK) -> DataFrame:
    """(z, y, x, value) of gaussian_bricks over the voxels, which are whole numbers; voxels of 0 are left out."""
    cut = (slab, *chunk[1:]) if slab else chunk
    out = cell_rows(gaussian_bricks(to_bricks(vox, shape, cut, "<i4"), shape, sigma, slab, whole, chunk), "long" if whole else "double")
    return out.withColumn("value", F.col("value").cast("int")) if whole else out
