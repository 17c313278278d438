"""Stored volumes that a scan of a part does not open the rest of.

Slices lie in a folder for each channel and batch of planes, so a range of planes reads only its batches' files.
Bricks lie in the order of a space-filling key, with the least, the greatest and the number of non-zero cells beside
the data: boxes, thresholds and "skip the background" are filters that the Parquet scan gets, and row groups outside
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import B_KEY, BRICK

SLICE = "z int, name string, height int, width int, dtype string, data binary, channel int, batch int"
STORED = BRICK + ", key long, low double, high double, nonzero long"


def write_volume(slices: DataFrame, path: str, depth: int = 64) -> None:
    """Slice images (channel, z, name, height, width, dtype, data), zstd, ``depth`` planes a batch."""
    rows = slices.withColumn("batch", F.floor(F.col("z") / depth).cast("int"))
    dealt = rows.repartition("channel", "batch").sortWithinPartitions("channel", "batch", "z")
    dealt.write.mode("overwrite").option("compression", "zstd").partitionBy("channel", "batch").parquet(path)


def scan_volume(spark: SparkSession, path: str, channels: list[int] | None = None, planes: tuple[int, int] | None = None, depth: int = 64) -> DataFrame:
    """The slices of the given channels (None: all) and planes (first, last; None: all); other batches' files stay closed."""
    rows = spark.read.schema(SLICE).parquet(path)
    if channels is not None:
        rows = rows.filter(F.col("channel").isin([int(c) for c in channels]))
    if planes is not None:
        rows = rows.filter(F.col("batch").between(planes[0] // depth, planes[1] // depth) & F.col("z").between(*planes))
    return rows.drop("batch")


def interleaved(columns: list[str], bits: int = 16) -> Column:
    """The bits of several numbers taken in turn, so that near cells mostly have near keys."""
    key = F.lit(0).cast("long")
    for k in range(bits):
        for j, c in enumerate(reversed(columns)):
            bit = F.shiftright(F.col(c).cast("long"), k).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(bit, len(columns) * k + j))
    return key


def with_statistics(bricks: DataFrame) -> DataFrame:
    """bricks with key, low, high and nonzero; low and high are 0 for a brick without cells."""

    def count(parts):
        import numpy as np

        for pdf in parts:
            cells = [np.frombuffer(x, t) for x, t in zip(pdf["data"], pdf["dtype"], strict=True)]
            ends = {"low": [float(c.min(initial=c[0])) if len(c) else 0.0 for c in cells], "high": [float(c.max(initial=c[0])) if len(c) else 0.0 for c in cells]}
            yield pdf.assign(**ends, nonzero=[int(np.count_nonzero(c)) for c in cells])

    columns = [f.split()[0] for f in STORED.split(", ")]
    rest = [c for c in bricks.columns if c not in columns]
    kept = bricks.select(*rest, *[f.split()[0] for f in BRICK.split(", ")], interleaved(B_KEY).alias("key"))
    extra = "".join(f", {f.name} {f.dataType.simpleString()}" for f in bricks.schema if f.name in rest)
    return kept.mapInPandas(lambda parts: (p[[*columns, *rest]] for p in count(parts)), STORED + extra)


def write_bricks(bricks: DataFrame, path: str, by: list[str] | None = None, group_bytes: int = 64 << 20) -> None:
    """bricks with their statistics in order of the key; by: columns that get a folder for each value."""
    by = by or []
    rows = with_statistics(bricks).repartitionByRange(*by, "key").sortWithinPartitions(*by, "key")
    out = rows.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", group_bytes)
    (out.partitionBy(*by) if by else out).parquet(path)


def scan_bricks(spark: SparkSession, path: str, box: tuple[tuple[int, int], ...] | None = None, above: float | None = None, skip_empty: bool = True) -> DataFrame:
    """The bricks that may hold cells of a box ((first, last) of z, y and x, both included) and, of these, those with a
    cell above a threshold or other than 0. Row groups without one are not read."""
    rows = spark.read.parquet(path)
    for (first, last), low, size in zip(box or (), ("z0", "y0", "x0"), ("dz", "dy", "dx"), strict=bool(box)):
        rows = rows.filter((F.col(low) <= last) & (F.col(low) + F.col(size) > first))
    if box:  # a plain lower end of each corner, for the scan: no brick of the store is larger than its largest
        most = spark.read.parquet(path).agg(*[F.max(c) for c in ("dz", "dy", "dx")]).first()
        for (first, _), low, n in zip(box, ("z0", "y0", "x0"), most, strict=True):
            rows = rows.filter(F.col(low) > first - (n or 0))
    if above is not None:
        rows = rows.filter(F.col("high") > float(above))
    return rows.filter("nonzero > 0") if skip_empty else rows
