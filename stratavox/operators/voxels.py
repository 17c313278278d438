"""Voxel algebra on sparse tables (z, y, x, value); an absent voxel is zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["z", "y", "x"]


def zero_roi(vox: DataFrame, roi: tuple[int, int, int, int], ny: int, nx: int) -> DataFrame:
    """vox with value 0 in the rectangle x_min, x_max, y_min, y_max (inclusive).

    Each bound is clamped into the image, so a rectangle outside clears the edge line; an empty rectangle
    gives no rows at all, as the slices are skipped.
    """
    x0, x1, y0, y1 = (min(max(v, 0), n - 1) for v, n in zip(roi, (nx, nx, ny, ny), strict=True))
    if x0 > x1 or y0 > y1:
        return vox.limit(0)
    inside = F.col("x").between(x0, x1) & F.col("y").between(y0, y1)
    return vox.withColumn("value", F.when(inside, 0).otherwise(F.col("value")))


def threshold(vox: DataFrame, t: float) -> DataFrame:
    """Voxels above t, which is 0 or more (below 0 the implicit zeros count too: see densify)."""
    if t < 0:
        raise ValueError("densify first: implicit zeros are above a negative threshold")
    return vox.filter(F.col("value") > t)


def threshold_volume(vox: DataFrame, t: float, pixel: tuple[float, float, float] = (1.8, 1.8, 2.0), by: list[str] | None = None) -> DataFrame:
    """Voxels above t, and their volume in cubic micrometres and millimetres."""
    cell = pixel[0] * pixel[1] * pixel[2]
    n = F.count_if(F.col("value") > t)
    return vox.groupBy(*(by or [])).agg(n.alias("voxels"), (n * cell).alias("volume_um3"), (n * cell / 1e9).alias("volume_mm3"))


def mask_sum(mask: DataFrame, by_slice: bool = True) -> DataFrame:
    """Sum of the values (not their count): by slice, or one number for a flat mask."""
    total = F.sum(F.col("value").cast("long")).alias("total")
    return mask.groupBy("z").agg(total) if by_slice else mask.agg(total)


def float_scaled(vox: DataFrame) -> DataFrame:
    """value scaled to 16 bits where its slice's maximum is 1 or less, then truncated; and the flag."""
    top = vox.groupBy("z").agg((F.max("value") <= 1.0).alias("scaled"))
    return vox.join(top, "z").withColumn("value", F.when(F.col("scaled"), F.col("value") * 65535).otherwise(F.col("value")).cast("int"))


def saturate(v: Column, high: int = 65535) -> Column:
    """Clipped to 0..high, then truncated."""
    return F.least(F.greatest(v, F.lit(0)), F.lit(high)).cast("int")


def wrap_uint16(v: Column) -> Column:
    return F.pmod(v.cast("long"), F.lit(65536)).cast("int")


def binarise(v: Column) -> Column:
    return F.when(v > 0, 255).otherwise(0)


def densify(vox: DataFrame, shape: tuple[int, int, int], by: str | None = None) -> DataFrame:
    """Every cell of the shape, absent ones with value 0; by: a column whose values each get a grid.

    The grid is dealt out by (by, z) before it unfolds, so that a plane is the most that a task makes at once.
    """
    nz, ny, nx = shape
    axis = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = [by, *KEY] if by else KEY
    grids = vox.select(by).distinct() if by else vox.sparkSession.range(1).select()
    planes = grids.select("*", axis(nz).alias("z")).repartition(*key[:-2])
    cells = planes.select("*", axis(ny).alias("y")).select("*", axis(nx).alias("x"))
    return cells.join(vox.select(*key, "value"), key, "left").select(*key, F.coalesce("value", F.lit(0)).alias("value"))


def subtract_channel(vox: DataFrame, inventory: DataFrame, reference: int, high: int = 65535) -> DataFrame:
    """Each other channel minus the reference, clipped to 0..high, on slices that the reference has.

    inventory: (channel, z, name, height, width), also of all-zero slices. Of several reference slices of one z
    the greatest name counts; slices of another shape than the reference's are left out (see mismatched).
    """
    ref = _reference(inventory, reference)
    usable = inventory.filter(F.col("channel") != reference).join(ref, "z").filter("height = ref_height AND width = ref_width").select("channel", "z").distinct()
    signal = vox.filter(F.col("channel") != reference).join(usable, ["channel", "z"], "left_semi")
    base = vox.filter(F.col("channel") == reference).select(*KEY, F.col("value").alias("ref"))
    out = signal.join(base, KEY, "left").withColumn("value", saturate(F.col("value") - F.coalesce("ref", F.lit(0)), high))
    return out.filter("value > 0").select("channel", *KEY, "value")


def _reference(inventory: DataFrame, reference: int) -> DataFrame:
    newest = F.max_by(F.struct("height", "width"), "name").alias("r")
    return inventory.filter(F.col("channel") == reference).groupBy("z").agg(newest).select("z", F.col("r.height").alias("ref_height"), F.col("r.width").alias("ref_width"))


def mismatched(inventory: DataFrame, reference: int) -> DataFrame:
    """Slices that subtract_channel leaves out because of their shape."""
    return inventory.filter(F.col("channel") != reference).join(_reference(inventory, reference), "z").filter("height <> ref_height OR width <> ref_width")


def mask_to(vox: DataFrame, atlas: DataFrame) -> DataFrame:
    """Voxels where the atlas mask (z, y, x, value) is not 0.

    Sort-merged: Spark's guess of a mask's size can be far too low, and a broadcast mask would have to fit into the driver.
    """
    return vox.join(atlas.filter("value <> 0").hint("merge"), KEY, "left_semi")


def overlay(heat: DataFrame, edge: DataFrame, channels: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    """heat with the edge's value in all channels wherever the edge is not 0, also where heat has no voxel."""
    e = edge.filter("value <> 0").select(*KEY, F.col("value").alias("_e"))
    return heat.join(e, KEY, "full").select(*KEY, *[F.coalesce("_e", c, F.lit(0)).alias(c) for c in channels])


def slab_of(z: Column, depth: int) -> Column:
    return F.floor(z / depth).cast("int")


def slab_histogram(vox: DataFrame, depth: int, shape: tuple[int, int, int]) -> DataFrame:
    """(slab, value, n) with the implicit zeros of every slab of the volume counted, never stored."""
    nz, ny, nx = shape
    counts = vox.groupBy(slab_of(F.col("z"), depth).alias("slab"), "value").agg(F.count("*").alias("n"))
    slabs = vox.sparkSession.range(-(-nz // depth)).select(F.col("id").cast("int").alias("slab"), (F.least(F.lit(depth), nz - F.col("id") * depth) * ny * nx).alias("cells"))
    stored = counts.groupBy("slab").agg(F.sum("n").alias("rows"))
    zeros = slabs.join(stored, "slab", "left").select("slab", F.lit(0).alias("value"), (F.col("cells") - F.coalesce("rows", F.lit(0))).alias("n"))
    return counts.unionByName(zeros).groupBy("slab", "value").agg(F.sum("n").alias("n")).filter("n > 0")


def otsu(histogram: DataFrame) -> DataFrame:
    """(slab, threshold): the least value of greatest between-class variance; of one value only, that value."""
    upto = Window.partitionBy("slab").orderBy("value")
    whole = Window.partitionBy("slab")
    d = lambda c: F.col(c).cast("double")
    h = histogram.withColumn("s", F.col("n") * F.col("value")).select("slab", "value", F.sum("n").over(upto).alias("w1"), F.sum("s").over(upto).alias("s1"), F.sum("n").over(whole).alias("nn"), F.sum("s").over(whole).alias("ss"))
    diff = d("ss") * d("w1") - d("nn") * d("s1")
    scored = h.withColumn("score", F.when(F.col("w1") < F.col("nn"), diff * diff / (d("w1") * (d("nn") - d("w1")))).otherwise(F.lit(-1.0)))
    return scored.groupBy("slab").agg(F.min_by("value", F.struct(-F.col("score"), F.col("value"))).alias("threshold"))
