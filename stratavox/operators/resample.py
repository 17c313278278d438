"""Resampling and warping: the source index of a target cell is computed, then met by equi-joins.

Each axis has a small map (target index, source index): as many rows as the axis is long, never as many as the
volume has cells. Three nearest rules exist and are named: corner, linspace and floor.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .voxels import KEY, binarise


def _half_even(value: float) -> int:
    return int(round(value))


def target_size(n: int, factor: float) -> int:
    return _half_even(n * factor)


def corner(k: Column, n: int, m: int) -> Column:
    """floor(k (n-1) / (m-1) + 1/2) in integers; 0 where m is 1."""
    return F.floor((2 * k * (n - 1) + (m - 1)) / (2 * (m - 1))).cast("int") if m > 1 else F.lit(0)


def linspace(k: Column, n: int, m: int) -> Column:
    """k (n-1) / (m-1) rounded half to even."""
    return F.rint(k * (n - 1) / F.lit(float(m - 1))).cast("int") if m > 1 else F.lit(0)


def floored(k: Column, n: int, m: int) -> Column:
    return F.floor(k * n / m).cast("int")


def axis_map(spark: SparkSession, n: int, m: int, rule, name: str) -> DataFrame:
    """(name, t_name): source and target index of an axis of n cells resampled to m."""
    k = F.col("id").cast("int")
    return spark.range(m).select(rule(F.col("id"), n, m).alias(name), k.alias(f"t_{name}"))


def slabs(nz: int, depth: int | None, factor: float) -> list[tuple[int, int, int, int, int]]:
    """(slabs, planes, target planes, first plane, first target plane) of all whole slabs, and of a last thinner one."""
    depth = min(depth or nz, nz)
    whole, rest = divmod(nz, depth)
    m = target_size(depth, factor)
    return [(whole, depth, m, 0, 0)] + ([(1, rest, target_size(rest, factor), whole * depth, whole * m)] if rest else [])


def _plane_rows(spark: SparkSession, part: tuple[int, int, int, int, int]) -> DataFrame:
    """(k, t_z, first): target plane within its slab and in the volume, and the slab's first plane."""
    count, n, m, z0, t0 = part
    slab = F.floor(F.col("id") / m).cast("int")
    return spark.range(count * m).select((F.col("id") % m).alias("k"), (F.col("id") + t0).cast("int").alias("t_z"), (slab * n + z0).alias("first"))


def _z_map(spark: SparkSession, nz: int, depth: int | None, factor: float) -> DataFrame:
    parts = [_plane_rows(spark, x).select((F.col("first") + corner(F.col("k"), x[1], x[2])).alias("z"), "t_z") for x in slabs(nz, depth, factor) if x[2]]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "z int, t_z int")


def gather(vox: DataFrame, maps: list[DataFrame], value: str = "value") -> DataFrame:
    """Target voxels (z, y, x, value) by the maps of the three axes; absent sources stay absent."""
    out = vox
    for m in maps:
        out = out.join(F.broadcast(m), [c for c in m.columns if not c.startswith("t_")])  # a row for each index of an axis
    return out.select(*[F.col(f"t_{c}").alias(c) for c in KEY], value)


def downsample_nearest(vox: DataFrame, shape: tuple[int, int, int], factors: tuple[float, float, float], depth: int | None = 100) -> DataFrame:
    """Nearest cells by the corner rule, in slabs of ``depth`` planes (None: the whole volume at once)."""
    spark, (nz, ny, nx), (fz, fy, fx) = vox.sparkSession, shape, factors
    maps = [_z_map(spark, nz, depth, fz), axis_map(spark, ny, target_size(ny, fy), corner, "y"), axis_map(spark, nx, target_size(nx, fx), corner, "x")]
    return gather(vox, maps)


def _linear_rows(rows: DataFrame, n: int, m: int, name: str) -> DataFrame:
    """(name, t_name, w_name): the one or two sources of each target (k, t_name, first), weights in units of 1 / (m - 1)."""
    d, k = max(m - 1, 1), F.col("k")
    low, part = (F.floor(k * (n - 1) / F.lit(d)).cast("int"), F.pmod(k * (n - 1), F.lit(d))) if m > 1 else (F.lit(0), F.lit(0).cast("long"))
    both = F.array(F.struct(low.alias("s"), (d - part).alias("w")), F.struct(F.least(low + 1, F.lit(n - 1)).alias("s"), part.alias("w")))
    rows = rows.select("first", f"t_{name}", F.explode(both).alias("b"))
    return rows.select((F.col("first") + F.col("b.s")).alias(name), f"t_{name}", F.col("b.w").alias(f"w_{name}")).filter(f"w_{name} > 0")


def _linear_map(spark: SparkSession, n: int, m: int, name: str) -> DataFrame:
    return _linear_rows(spark.range(m).select(F.col("id").alias("k"), F.col("id").cast("int").alias(f"t_{name}"), F.lit(0).alias("first")), n, m, name)


def downsample_linear(vox: DataFrame, shape: tuple[int, int, int], factors: tuple[float, float, float], depth: int | None = 100) -> DataFrame:
    """Trilinear values (double) at the corner positions k (n-1) / (m-1), in slabs of ``depth`` planes.

    Weights are integers and divided once at the end, so sums do not depend on their order.
    """
    spark, (nz, ny, nx), (fz, fy, fx) = vox.sparkSession, shape, factors
    my, mx = target_size(ny, fy), target_size(nx, fx)
    parts = [_linear_rows(_plane_rows(spark, x), x[1], x[2], "z").withColumn("d_z", F.lit(max(x[2] - 1, 1))) for x in slabs(nz, depth, fz) if x[2]]
    planes = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "z int, t_z int, w_z long, d_z int")
    out = vox.select(*KEY, "value")
    for m in (planes, _linear_map(spark, ny, my, "y"), _linear_map(spark, nx, mx, "x")):
        out = out.join(F.broadcast(m), [c for c in m.columns if c in KEY])
    weighted = F.sum(F.col("value").cast("long") * F.col("w_z") * F.col("w_y") * F.col("w_x"))
    scale = F.max("d_z").cast("long") * (max(my - 1, 1) * max(mx - 1, 1))
    return out.groupBy("t_z", "t_y", "t_x").agg((weighted.cast("double") / scale.cast("double")).alias("value")).select(*[F.col(f"t_{c}").alias(c) for c in KEY], "value")


def upsample_labels(labels: DataFrame, shape: tuple[int, int, int], target: tuple[int, int, int]) -> DataFrame:
    """Labels on a larger grid: planes by the linspace rule, rows and columns by the floor rule."""
    spark = labels.sparkSession
    rules = (linspace, floored, floored)
    return gather(labels, [axis_map(spark, n, m, r, c) for c, n, m, r in zip(KEY, shape, target, rules, strict=True)], "label")


def mask_for_heatmap(mask: DataFrame, shape: tuple[int, int, int], factors: tuple[float, float, float]) -> DataFrame:
    """The whole mask downsampled by nearest cells, values 0 or 255."""
    out = downsample_nearest(mask, shape, factors, None)
    return out.withColumn("value", binarise(F.col("value")))


def warp_nearest(fixed: DataFrame, moving: DataFrame, affine: list[float], displacement: DataFrame | None = None, value: str = "value") -> DataFrame:
    """For each cell of fixed (z, y, x) the moving value at its transformed place; outside is 0.

    The point goes through the displacement (dz, dy, dx; 0 where absent) first, then through the affine of
    12 numbers, rows z, y, x of (z, y, x, 1); the nearest cell is floor(r + 1/2). Swapping fixed and moving, with
    the inverse transform, is the other direction.
    """
    p = fixed.select(*KEY)
    if displacement is not None:
        p = p.join(displacement, KEY, "left")
        q = [F.col(c) + F.coalesce(F.col(f"d{c}"), F.lit(0.0)) for c in KEY]
    else:
        q = [F.col(c).cast("double") for c in KEY]
    place = [F.floor(sum((F.lit(float(a)) * b for a, b in zip(affine[4 * r : 4 * r + 3], q, strict=True)), F.lit(float(affine[4 * r + 3]))) + 0.5).cast("int").alias(f"s_{c}") for r, c in enumerate(KEY)]
    source = moving.select(*[F.col(c).alias(f"s_{c}") for c in KEY], value)
    found = p.select(*KEY, *place).join(source, [f"s_{c}" for c in KEY], "left")
    return found.select(*KEY, F.coalesce(value, F.lit(0)).alias(value))


def warp_between(atlas: DataFrame, sample: DataFrame, affine: list[float], mode: str = "atlas2image", value: str = "value") -> DataFrame:
    """One volume on the other's grid; affine leads from the sample's cells to the atlas's.

    ``atlas2image``: the atlas's values at the sample's cells; ``image2atlas``: the sample's values at the atlas's
    cells, by the inverse.
    """
    if mode == "atlas2image":
        return warp_nearest(sample, atlas, affine, value=value)
    if mode != "image2atlas":
        raise ValueError(f"no direction {mode}")
    import numpy as np

    back = np.linalg.inv(np.vstack([np.reshape(affine, (3, 4)), [0, 0, 0, 1]]))
    return warp_nearest(atlas, sample, back[:3].ravel().tolist(), value=value)


def world_coordinates(vox: DataFrame, spacing_xyz: tuple, origin_xyz: tuple, direction: tuple | None = None) -> DataFrame:
    """vox with wx, wy, wz = origin + direction * (index * spacing); direction: nine numbers by rows, or none turned."""
    step = [F.col(c) * F.lit(float(s)) for c, s in zip("xyz", spacing_xyz, strict=True)]
    if direction:
        step = [sum((F.lit(float(d)) * s for d, s in zip(direction[3 * k + 1 : 3 * k + 3], step[1:], strict=True)), F.lit(float(direction[3 * k])) * step[0]) for k in range(3)]
    return vox.select("*", *[(F.lit(float(o)) + s).alias(f"w{c}") for c, s, o in zip("xyz", step, origin_xyz, strict=True)])


def permute_axes(vox: DataFrame, order: str) -> DataFrame:
    """vox whose z, y and x are the axes named by order: ``"xyz"`` turns a volume kept as (x, y, z) to (z, y, x)."""
    if sorted(order) != sorted(KEY):
        raise ValueError(f"{order} does not name the three axes")
    rest = [c for c in vox.columns if c not in KEY]
    return vox.select(*[F.col(old).alias(new) for new, old in zip(KEY, order, strict=True)], *rest)


def pyramid(vox: DataFrame, shape: tuple[int, int, int], levels: int, factor: float = 0.5) -> DataFrame:
    """(level, z, y, x, value): the volume and its nearest downsamples, each made from the one before."""
    out, now = vox.select(F.lit(0).alias("level"), *KEY, "value"), vox
    for level in range(1, levels):
        now = downsample_nearest(now, shape, (factor,) * 3, None)
        shape = tuple(target_size(n, factor) for n in shape)
        out = out.unionByName(now.select(F.lit(level).alias("level"), *KEY, "value"))
    return out


def occupied_blocks(vox: DataFrame, low: DataFrame, ratio: tuple[int, int, int]) -> DataFrame:
    """Voxels whose cell of a low-resolution mask (one cell for each ``ratio`` voxels) is above 0."""
    cell = [F.floor(F.col(c) / r).cast("int").alias(f"l_{c}") for c, r in zip(KEY, ratio, strict=True)]
    wanted = low.filter("value > 0").select(*[F.col(c).alias(f"l_{c}") for c in KEY]).distinct()
    return vox.select("*", *cell).join(wanted, [f"l_{c}" for c in KEY], "left_semi").drop(*[f"l_{c}" for c in KEY])
