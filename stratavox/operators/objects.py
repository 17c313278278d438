"""Objects: components of foreground voxels, sizes, filters, stitching of slices, blockwise segmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import spill
from .components import connected_components
from .density import gaussian_smooth
from .slices import global_rank
from .voxels import KEY, otsu, slab_histogram, slab_of


def linear_index(shape: tuple[int, int, int]):
    _, ny, nx = shape
    return (F.col("z").cast("long") * ny + F.col("y")) * nx + F.col("x")


def neighbour_edges(nodes: DataFrame, shape: tuple[int, int, int], same: list[str]) -> DataFrame:
    """(a, b): linear indices of face neighbours that agree in the columns ``same``; nodes has lin and KEY."""
    step = F.explode(F.array(*[F.struct(*[F.lit(d).cast("int").alias(f"d{c}") for c, d in zip(KEY, s, strict=True)]) for s in ((1, 0, 0), (0, 1, 0), (0, 0, 1))])).alias("s")
    moved = nodes.select(F.col("lin").alias("a"), *same, *KEY, step).select("a", *same, *[(F.col(c) + F.col(f"s.d{c}")).alias(c) for c in KEY])
    return moved.join(nodes.select(F.col("lin").alias("b"), *same, *KEY), [*same, *KEY]).select("a", "b")


def components(vox: DataFrame, shape: tuple[int, int, int], depth: int | None = None) -> DataFrame:
    """(slab, z, y, x, lin, root): face-connected components within slabs; root is the least linear index."""
    slab = slab_of(F.col("z"), depth) if depth else F.lit(0)
    nodes = vox.select(*KEY, linear_index(shape).alias("lin"), slab.alias("slab"))
    roots = connected_components(neighbour_edges(nodes, shape, ["slab"]))
    return nodes.join(roots, F.col("lin") == F.col("node"), "left").select("slab", *KEY, "lin", F.coalesce("root", "lin").alias("root"))


def numbered(found: DataFrame) -> DataFrame:
    """found with obj_id: 1.. in raster order of the roots, restarting in each slab."""
    ranked = spill(global_rank(found.select("slab", "root").distinct(), ["slab", "root"]))
    first = ranked.groupBy("slab").agg(F.min("rank").alias("low"))
    ids = ranked.join(first, "slab").select("slab", "root", (F.col("rank") - F.col("low") + 1).cast("int").alias("obj_id"))
    return found.join(ids, ["slab", "root"])


def sizes(objects: DataFrame) -> DataFrame:
    return objects.groupBy("slab", "obj_id").agg(F.count("*").alias("size"))


def drop_small(objects: DataFrame, min_size: int) -> DataFrame:
    """Objects of min_size voxels or more, ids not renumbered and wrapped to 16 bits."""
    big = sizes(objects).filter(F.col("size") >= min_size).select("slab", "obj_id")
    return objects.join(big, ["slab", "obj_id"]).withColumn("obj_id", F.pmod(F.col("obj_id"), F.lit(65536)))


def object_count(objects: DataFrame) -> DataFrame:
    """Greatest id and number of different ids in each slab."""
    return objects.groupBy("slab").agg(F.max("obj_id").alias("max_id"), F.countDistinct("obj_id").alias("n_objects"))


def segment_threshold(vox: DataFrame, shape: tuple[int, int, int], threshold: float | str = "otsu", min_size: int = 10, depth: int = 128, sigma: float = 1.0) -> DataFrame:
    """Objects above a threshold (a number, or Otsu's of each slab) of min_size voxels or more.

    The volume is smoothed first, slab by slab, in whole numbers; sigma 0 leaves that out.
    """
    if sigma > 0:
        vox = spill(gaussian_smooth(vox, shape, sigma, depth, whole=True))
    if threshold == "otsu":
        t = otsu(slab_histogram(vox, depth, shape))
        above = vox.withColumn("slab", slab_of(F.col("z"), depth)).join(t, "slab").filter("value > threshold").drop("slab", "threshold")
    else:
        above = vox.filter(F.col("value") > float(threshold))
    return drop_small(numbered(components(above, shape, depth)), min_size)


def stitch(objects: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(z, obj_id, stitched): objects of consecutive slices that are each other's best match at the given overlap
    ratio or more become one; stitched is the least z * 2^32 + obj_id of the chain."""
    size = objects.groupBy("z", "obj_id").agg(F.count("*").alias("size"))
    up = objects.select((F.col("z") - 1).alias("z"), "y", "x", F.col("obj_id").alias("b"))
    inter = objects.withColumnRenamed("obj_id", "a").join(up, KEY).groupBy("z", "a", "b").agg(F.count("*").alias("n"))
    s = inter.join(size.select("z", F.col("obj_id").alias("a"), F.col("size").alias("sa")), ["z", "a"])
    s = s.join(size.select((F.col("z") - 1).alias("z"), F.col("obj_id").alias("b"), F.col("size").alias("sb")), ["z", "b"])
    iou = F.col("n") / (F.col("sa") + F.col("sb") - F.col("n"))
    rank = lambda by, other: F.row_number().over(Window.partitionBy("z", by).orderBy(F.desc("iou"), other))
    best = s.withColumn("iou", iou).filter(F.col("iou") >= threshold).withColumn("ra", rank("a", "b")).withColumn("rb", rank("b", "a")).filter("ra = 1 AND rb = 1")
    key = lambda z, i: F.shiftleft(z.cast("long"), 32) + i
    roots = connected_components(best.select(key(F.col("z"), F.col("a")).alias("a"), key(F.col("z") + 1, F.col("b")).alias("b")))
    nodes = size.select("z", "obj_id", key(F.col("z"), F.col("obj_id")).alias("k"))
    return nodes.join(roots, F.col("k") == F.col("node"), "left").select("z", "obj_id", F.coalesce("root", "k").alias("stitched"))


def boxes(objects: DataFrame, by: str = "obj_id") -> DataFrame:
    """Bounding box and size of each object."""
    ends = [f(c).alias(f"{n}_{c}") for c in KEY for n, f in (("min", F.min), ("max", F.max))]
    return objects.groupBy(by).agg(*ends, F.count("*").alias("size"))


def segment_blocks(vox: DataFrame, shape: tuple[int, int, int], fn, block: tuple[int, int, int] = (128, 256, 256), halo: int = 1) -> DataFrame:
    """(z, y, x, obj_id) from a segmenter run on blocks and merged across block faces.

    fn(dense array) -> integer labels of the same shape, 0 for background. Each block sees ``halo`` planes of its
    neighbours; labels of the halo are dropped. Labels of face-adjacent foreground voxels of two blocks are one
    object. obj_id is the least linear index of the object.
    """
    from .blocks import map_blocks

    ny, nx = shape[1:]

    def local(z0: int, y0: int, x0: int, cells):
        import numpy as np

        labels = fn(cells)
        at = np.nonzero(labels)
        return (*[a + o for a, o in zip(at, (z0, y0, x0), strict=True)], labels[at])

    found = map_blocks(vox, shape, block, halo, local)
    named = found.withColumn("lin", (F.col("z").cast("long") * ny + F.col("y")) * nx + F.col("x"))
    least = named.groupBy("bz", "by", "bx", "value").agg(F.min("lin").alias("own"))
    named = named.join(least, ["bz", "by", "bx", "value"])
    first, last = [(F.col(c) % b == 0) for c, b in zip(KEY, block, strict=True)], [(F.col(c) % b == b - 1) for c, b in zip(KEY, block, strict=True)]
    faces = None
    for k, c in enumerate(KEY):  # only the two planes that touch meet
        a = named.filter(last[k]).select(*[(F.col(x) + (1 if x == c else 0)).alias(x) for x in KEY], F.col("own").alias("a"))
        pair = a.join(named.filter(first[k]).select(*KEY, F.col("own").alias("b")), KEY).select("a", "b")
        faces = pair if faces is None else faces.unionByName(pair)
    roots = connected_components(faces.distinct())
    return named.join(roots, F.col("own") == F.col("node"), "left").select(*KEY, F.coalesce("root", "own").alias("obj_id"))


def label_faces(foreground):
    """Face-connected labels of a dense boolean array, by label propagation along the axes."""
    import numpy as np

    fg = foreground.astype(bool)
    label = np.where(fg, np.arange(1, fg.size + 1).reshape(fg.shape), 0)
    while True:
        new = label.copy()
        for ax in range(fg.ndim):
            lo, hi = [slice(None)] * fg.ndim, [slice(None)] * fg.ndim
            lo[ax], hi[ax] = slice(None, -1), slice(1, None)
            lo, hi = tuple(lo), tuple(hi)
            both = fg[lo] & fg[hi]
            m = np.minimum(new[lo], new[hi])
            new[lo] = np.where(both, m, new[lo])
            new[hi] = np.where(both, np.minimum(m, new[hi]), new[hi])
        if (new == label).all():
            return label
        label = new
