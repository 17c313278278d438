"""Slice inventories: order, shape, samples, pairing, resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import spill


def global_rank(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """df with its rank from 1 in the given order, numbered in ranges: no task sees more than its range."""
    parts = spill(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    local = parts.withColumn("_row", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = parts.groupBy("_part").count()  # a row for each range
    starts = sizes.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_start"))
    return local.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_row")).drop("_part", "_row", "_start")


def inventory(files: DataFrame, key: str = "channel", name: str = "name") -> DataFrame:
    """files with z: the rank of the name within its channel, from 0; numbered in ranges, so that no channel is one task's."""
    ranked = global_rank(files, [key, name], "_rank")
    first = ranked.groupBy(key).agg(F.min("_rank").alias("_low"))
    return ranked.join(first, key).withColumn("z", (F.col("_rank") - F.col("_low")).cast("int")).select(*files.columns, "z")


def volume_shape(slices: DataFrame) -> DataFrame:
    """A row for each channel: number of slices, and height, width and type of its first slice."""
    first = lambda c: F.min_by(c, "z").alias(c)
    return slices.groupBy("channel").agg(F.count("*").alias("nz"), first("height"), first("width"), first("dtype"))


def shape_of(signal: DataFrame, register: DataFrame) -> DataFrame:
    """The signal channel's shape row, or the register channel's where the signal has no slices."""
    named = signal.withColumn("rank", F.lit(0)).unionByName(register.withColumn("rank", F.lit(1)))
    best = named.agg(F.min_by(F.struct(*signal.columns), "rank").alias("s"))
    return best.filter("s IS NOT NULL").select("s.*")


def pages_to_slices(files: DataFrame) -> DataFrame:
    """(file, z, data) for files (file, pages): each page becomes a slice."""
    return files.select("file", F.posexplode("pages").alias("z", "data"))


def first_slice(slices: DataFrame, *columns: str) -> DataFrame:
    """The given columns of the first slice of each channel."""
    return slices.groupBy("channel").agg(F.min_by(F.struct("z", *columns), "z").alias("s")).select("channel", "s.*")


def middle_slice(slices: DataFrame) -> DataFrame:
    """The slice z = n // 2 of each channel."""
    n = slices.groupBy("channel").agg(F.floor(F.count("*") / 2).cast("int").alias("z"))
    return slices.join(n, ["channel", "z"], "left_semi")


def even_sample(slices: DataFrame, rate: float) -> DataFrame:
    """max(1, int(n * rate)) slices of each channel, evenly spaced from first to last; one alone is the first."""
    n = slices.groupBy("channel").agg(F.count("*").alias("n"))
    k = n.withColumn("k", F.greatest(F.lit(1), F.floor(F.col("n") * rate)).cast("long"))
    at = k.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    step = F.when(F.col("k") == 1, F.lit(0)).otherwise(F.floor(F.col("i") * (F.col("n") - 1) / (F.col("k") - 1)))
    return slices.join(at.select("channel", step.cast("int").alias("z")).distinct(), ["channel", "z"], "left_semi")


def pair_up(a: DataFrame, b: DataFrame, order: str) -> DataFrame:
    """(rank, a_<order>, b_<order>): lists zipped by rank and cut to the shorter."""
    number = lambda df, side: global_rank(df.select(F.col(order).alias(f"{side}_{order}")), [f"{side}_{order}"])
    return number(a, "a").join(number(b, "b"), "rank").select(F.col("rank").cast("int").alias("rank"), f"a_{order}", f"b_{order}")


def checked_pairs(pairs: DataFrame, same: Column) -> DataFrame:
    """pairs; fails where the two shapes differ."""
    return pairs.withColumn("_", F.assert_true(same, F.lit("slice shapes differ"))).filter(F.col("_").isNull()).drop("_")


def reference_folder(folders: DataFrame) -> DataFrame:
    """The reference folder: ``ch0`` or ``ch0_*`` before any other that holds ``ch0``; the least name of its kind."""
    low = F.lower("name")
    rank = F.when((low == "ch0") | low.startswith("ch0_"), 0).when(low.contains("ch0"), 1)
    return folders.select("name", rank.alias("rank")).filter("rank IS NOT NULL").orderBy("rank", "name").limit(1).select("name")


def pending(todo: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """What is not done yet."""
    return todo.join(done, key, "left_anti")


def whole_batches(todo: DataFrame, done: DataFrame, key: str, batch: str) -> DataFrame:
    """(batch, complete): a batch is complete if each of its rows is done."""
    seen = done.select(key).distinct().withColumn("_d", F.lit(True))
    return todo.join(seen, key, "left").groupBy(batch).agg(F.bool_and(F.coalesce("_d", F.lit(False))).alias("complete"))


def drop_blank(images: DataFrame) -> DataFrame:
    """Slice images (with data) that have a pixel other than 0; compared as bytes, whatever the type."""
    return images.filter("data <> CAST(rpad('', length(data), '\\0') AS BINARY)")


def status_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("n"))
