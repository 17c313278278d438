"""Region statistics: join a signal mask with labels, count, roll up the hierarchy, report by level."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import in_frames, spill
from .voxels import KEY


def region_voxels(labels: DataFrame) -> DataFrame:
    """(label, total_vox) of every label but 0."""
    return labels.filter("label <> 0").groupBy("label").agg(F.count("*").alias("total_vox"))


def region_signal(mask: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, signal_vox): mask voxels above 0 by the label at their place, 0 left out."""
    met = labels.filter("label <> 0").join(mask.filter("value > 0"), KEY)
    return met.groupBy("label").agg(F.count("*").alias("signal_vox"))


def region_density(mask: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, total_vox, signal_vox) in one pass over both; mask holds a voxel once."""
    both = labels.filter("label <> 0").join(mask.select(*KEY, "value"), KEY, "left")
    return both.groupBy("label").agg(F.count("*").alias("total_vox"), F.count_if(F.col("value") > 0).alias("signal_vox"))


def common_planes(mask: DataFrame, labels: DataFrame, nz_mask: int, nz_labels: int) -> tuple[DataFrame, DataFrame]:
    """Both cut to the planes that both volumes have."""
    n = min(nz_mask, nz_labels)
    return mask.filter(F.col("z") < n), labels.filter(F.col("z") < n)


def closure(regions: DataFrame) -> DataFrame:
    """(region_id, ancestor) for each region and itself and all above it, to any depth; a cycle raises.

    A round doubles how far each region looks up: its list grows by the list of the region that it ends at. So the
    rounds grow with the logarithm of the depth; each is a small written table, as the ontology is one.
    """
    unknown = F.col("up").isNotNull() & F.col("next").isNull()  # a parent that is no region ends the list
    now = regions.select("region_id", F.array("region_id").alias("line"), F.col("parent_id").alias("up"))
    left, known = None, None
    while left is None or left:
        above = now.select(F.col("region_id").alias("next"), F.col("line").alias("more"), F.col("up").alias("further"))
        met = now.join(above, F.col("up") == F.col("next"), "left")
        now = spill(met.select("region_id", F.concat("line", F.coalesce("more", F.when(unknown, F.array("up")), F.array())).alias("line"), F.when(unknown, None).otherwise(F.col("further")).alias("up")))
        size = now.agg(F.count_if(F.col("up").isNotNull()).alias("left"), F.coalesce(F.max(F.size("line")), F.lit(0)).alias("longest"), F.count("*").alias("n")).first()
        left = size["left"]
        if size["longest"] > size["n"] + 1:
            raise ValueError("the regions' parents form a cycle")
    return now.select("region_id", F.explode("line").alias("ancestor"))


def rollup(counts: DataFrame, regions: DataFrame) -> DataFrame:
    """Every region with the totals of itself and all below it; regions without voxels have 0.

    counts (label, total_vox, signal_vox) has at most a row for each region, as the ontology does.
    """
    own = closure(regions).join(counts, F.col("region_id") == F.col("label"), "left")
    sums = own.groupBy("ancestor").agg(F.coalesce(F.sum("total_vox"), F.lit(0)).alias("total_vox"), F.coalesce(F.sum("signal_vox"), F.lit(0)).alias("signal_vox"))
    return regions.join(sums, F.col("region_id") == F.col("ancestor")).select("region_id", "name", "parent_id", "level", "total_vox", "signal_vox")


def level_report(rolled: DataFrame, pixel: tuple[float, float, float] = (1.8, 1.8, 2.0)) -> DataFrame:
    """Rows by level with a 1-based index in order of region_id, density and volume in cubic millimetres."""
    index = F.row_number().over(Window.partitionBy("level").orderBy("region_id"))
    density = F.when(F.col("total_vox") > 0, F.col("signal_vox") / F.col("total_vox"))
    cell = pixel[0] * pixel[1] * pixel[2]
    return rolled.select("level", index.alias("index"), "region_id", "name", "total_vox", "signal_vox", density.alias("density"), (F.col("total_vox") * F.lit(cell) / F.lit(1e9)).alias("volume_mm3"))


def objects_by_region(objects: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, n_objects): each object goes to the label it overlaps most, the least one on a tie."""
    overlap = objects.join(labels.filter("label <> 0"), KEY).groupBy("obj_id", "label").agg(F.count("*").alias("n"))
    best = overlap.groupBy("obj_id").agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("label"))
    return best.groupBy("label").agg(F.count("*").alias("n_objects"))


def brick_totals(bricks: DataFrame) -> DataFrame:
    """(label, total_vox) from dense label bricks (dtype, data): bincounts by brick, then summed."""

    def count(parts):
        import numpy as np
        import pandas as pd

        for pdf in parts:
            for dtype, data in zip(pdf["dtype"], pdf["data"], strict=True):
                label, n = np.unique(np.frombuffer(data, dtype), return_counts=True)
                yield pd.DataFrame({"label": label.astype("int32"), "n": n.astype("int64")})

    return bricks.select("dtype", "data").transform(in_frames, count, "label int, n long").filter("label <> 0").groupBy("label").agg(F.sum("n").alias("total_vox"))
