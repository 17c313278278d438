"""Contrast-limited equalisation of volumes in three dimensions, in whole numbers and DataFrame functions only.

The volume is cut into tiles; each has a histogram (an implicit 0 is counted by arithmetic), clipped and summed up to
a look-up table. A voxel is blended from the tables of the eight tiles whose centres surround it. Tables are made only
where a voxel's value asks for them, and the eight of a cell between centres stand in one row, so that a voxel finds
them by one equi-join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .transforms import CORNERS
from .voxels import KEY

T = ["tz", "ty", "tx"]
C = ["cz", "cy", "cx"]


def tile_size(shape: tuple[int, int, int], grid: tuple[int, int, int]) -> tuple[int, int, int]:
    return tuple(-(-n // g) for n, g in zip(shape, grid, strict=True))


def look_up(asked: DataFrame, vox: DataFrame, shape: tuple[int, int, int], size: tuple[int, int, int], clip: float, bins: int) -> DataFrame:
    """(tz, ty, tx, value, lut) for the tiles and values asked for.

    Counts beyond the limit (clip times the mean count, 1 at least) go evenly to all bins, and what is left to one bin
    in every so many.
    """
    area = reduce(lambda a, b: a * b, [F.least(F.lit(t), F.lit(n) - F.col(c) * t) for c, t, n in zip(T, size, shape, strict=True)]).cast("long")
    hist = vox.groupBy(*[F.floor(F.col(c) / t).cast("int").alias(k) for c, t, k in zip(KEY, size, T, strict=True)], "value").agg(F.count("*").alias("n"))
    stored = hist.groupBy(*T).agg(F.sum("n").alias("n"))
    tiles = asked.select(*T).distinct().join(stored, T, "left").select(*T, area.alias("area"), F.coalesce("n", F.lit(0)).alias("n"))
    zeros = tiles.select(*T, F.lit(0).alias("value"), (F.col("area") - F.col("n")).alias("n"))
    limit = F.greatest(F.floor(F.col("area") * clip / bins), F.lit(1).cast("long"))
    counts = hist.unionByName(zeros).groupBy(*T, "value").agg(F.sum("n").alias("n"))
    counts = counts.join(tiles.select(*T, "area", limit.alias("limit")), T)
    over = counts.groupBy(*T).agg(F.sum(F.greatest(F.col("n") - F.col("limit"), F.lit(0))).alias("over"), F.max("area").alias("area"))
    cut = counts.select(*T, "value", F.least("n", "limit").alias("n"), F.lit(False).alias("asked"))
    both = cut.unionByName(asked.select(*T, "value", F.lit(0).cast("long").alias("n"), F.lit(True).alias("asked")))
    upto = Window.partitionBy(*T).orderBy("value").rangeBetween(Window.unboundedPreceding, 0)  # at most two rows a bin
    met = both.withColumn("sum", F.sum("n").over(upto)).filter("asked").join(over, T)
    rest, v = F.col("over") % bins, F.col("value")
    every = F.greatest(F.floor(F.lit(bins) / F.greatest(rest, F.lit(1))), F.lit(1))
    total = F.col("sum") + (v + 1) * F.floor(F.col("over") / bins) + F.when(rest > 0, F.least(rest, F.floor(v / every) + 1)).otherwise(0)
    lut = F.floor((2 * total * (bins - 1) + F.col("area")) / (2 * F.col("area")))
    return met.select(*T, "value", F.least(lut, F.lit(bins - 1)).cast("long").alias("lut"))


def clahe_3d(vox: DataFrame, shape: tuple[int, int, int], clip: float = 2.0, grid: tuple[int, int, int] = (4, 8, 8), bins: int = 65536) -> DataFrame:
    """(z, y, x, value): vox (whole numbers of 0 to bins - 1) equalised; cells without a row stay so, and weigh as 0.

    grid: tiles by axis; where they do not divide it, the last tile of an axis is smaller and counts its own cells only.
    """
    size = tile_size(shape, grid)
    count = [-(-n // t) for n, t in zip(shape, size, strict=True)]
    away = [2 * F.col(c) + (1 - t) for c, t in zip(KEY, size, strict=True)]  # from the first tile's centre, in half cells
    low = [F.floor(a / (2 * t)).cast("int") for a, t in zip(away, size, strict=True)]
    placed = vox.select(*KEY, "value", *[x.alias(c) for c, x in zip(C, low, strict=True)], *[(a - 2 * t * x).cast("long").alias(f"f{c}") for c, a, t, x in zip(KEY, away, size, low, strict=True)])
    cells = placed.select(*C, "value").distinct()
    corner = lambda k, o: F.struct(F.lit(k).alias("k"), *[F.least(F.greatest(F.col(c) + s, F.lit(0)), F.lit(n - 1)).alias(t) for c, s, n, t in zip(C, o, count, T, strict=True)])
    wanted = cells.select(*C, "value", F.inline(F.array(*[corner(k, o) for k, o in enumerate(CORNERS)])))
    tables = look_up(wanted.select(*T, "value").distinct(), vox.select(*KEY, "value"), shape, size, clip, bins)
    of = wanted.join(tables, [*T, "value"]).groupBy(*C, "value").agg(*[F.max(F.when(F.col("k") == k, F.col("lut"))).alias(f"l{k}") for k in range(8)])
    whole = 8 * size[0] * size[1] * size[2]

    def share(corner: tuple[int, int, int]) -> Column:
        return reduce(lambda a, b: a * b, [F.col(f"f{c}") if o else 2 * t - F.col(f"f{c}") for c, t, o in zip(KEY, size, corner, strict=True)])

    blend = reduce(lambda a, b: a + b, [share(o) * F.col(f"l{k}") for k, o in enumerate(CORNERS)])
    met = placed.join(of, [*C, "value"])
    return met.select(*KEY, F.floor((2 * blend + whole) / (2 * whole)).cast("int").alias("value"))
