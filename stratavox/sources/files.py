"""Reading and writing: slice folders, containers, spots, settings, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..operators.regions import closure
from ..operators.slices import inventory
from ..operators.voxels import wrap_uint16
from ..storage import spill


def scan_slices(spark: SparkSession, folder: str, decode: Callable[[bytes], object], glob: str = "*.tif*", channel: int = 0) -> DataFrame:
    """Slices (channel, z, name, height, width, dtype, data) of a folder's image files, z by name.

    decode turns a file's bytes into an array. An empty folder raises.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no {glob} in {folder}")
    named = files.select(F.lit(channel).alias("channel"), F.element_at(F.split("path", "/"), -1).alias("name"), "path")
    ranked = inventory(named)

    def read(parts):
        import numpy as np
        import pandas as pd

        for pdf in parts:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                a = decode(content)
                a = a.astype(a.dtype.newbyteorder("<"))
                yield pd.DataFrame([(path, *a.shape, a.dtype.str, np.ascontiguousarray(a).tobytes())], columns=["path", "height", "width", "dtype", "data"])

    images = files.select("path", "content").mapInPandas(read, "path string, height int, width int, dtype string, data binary")
    return ranked.join(images, "path").drop("path")


def scan_pages(spark: SparkSession, folder: str, decode: Callable[[bytes], list], glob: str = "*.tif*") -> DataFrame:
    """(name, z, height, width, dtype, data): each page of each file a slice; a flat image is one page."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")

    def read(parts):
        import numpy as np
        import pandas as pd

        for pdf in parts:
            for name, content in zip(pdf["name"], pdf["content"], strict=True):
                pages = np.asarray(decode(content))
                pages = pages[None] if pages.ndim == 2 else pages
                yield pd.DataFrame([(name, z, *p.shape, p.dtype.newbyteorder("<").str, np.ascontiguousarray(p, p.dtype.newbyteorder("<")).tobytes()) for z, p in enumerate(pages)], columns=["name", "z", "height", "width", "dtype", "data"])

    return files.mapInPandas(read, "name string, z int, height int, width int, dtype string, data binary")


def extract_channels(volume: DataFrame, channels: str | list[int], base: str, batch: int = 64) -> DataFrame:
    """The listed channels (``all``, ``"0,2"`` or numbers) with slice names and the z batch they belong to."""
    out = volume
    if channels != "all":
        wanted = [int(c) for c in channels.split(",")] if isinstance(channels, str) else list(channels)
        out = volume.filter(F.col("channel").isin(wanted))
    return out.withColumn("name", F.format_string(f"{base}_C%d_Z%04d.tif", "channel", "z")).withColumn("batch", F.floor(F.col("z") / batch).cast("int"))


def scan_spots(spark: SparkSession, path: str) -> DataFrame:
    """(y, x) of a CSV with a header; other columns are ignored, missing ones raise."""
    rows = spark.read.csv(path, header=True)
    if missing := {"y", "x"} - set(rows.columns):
        raise ValueError(f"no column {', '.join(sorted(missing))}")
    return rows.select(F.col("y").cast("double").alias("y"), F.col("x").cast("double").alias("x"))


def resolution(spark: SparkSession, path: str) -> DataFrame:
    """One row: source and target resolution (x, y, z) from a settings file, in the new or the older layout."""
    return with_resolution(spark.read.text(path, wholetext=True).select("value")).drop("value")


def with_resolution(raw: DataFrame) -> DataFrame:
    """Settings texts (value, any other columns) with source, target and factor; defaults where a text lacks them."""
    get = lambda p: F.from_json(F.get_json_object("value", p), "array<double>")
    default = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    source = F.coalesce(get("$.input.resolution_xyz"), get("$.source_resolution"), default(1.8, 1.8, 2.0))
    target = F.coalesce(get("$.preprocessing.downsample.target_resolution_xyz"), get("$.target_resolution_xyz"), get("$.target_resolution"), default(25, 25, 25))
    return raw.withColumns({"source": source, "target": target}).withColumn("factor", F.zip_with("source", "target", lambda a, b: a / b))


def scan_ontology(spark: SparkSession, path: str, region_id: str = "id", name: str = "name", children: str = "children", lines: bool = False) -> DataFrame:
    """(region_id, name, parent_id, level) of a JSON tree of nested children, one document or a list of them.

    lines: files hold a document a line, each a tree of its own or a part of one. In a part, nodes marked ``elsewhere``
    give the place of their children only; another document lists them.

    The schema that Spark reads from the file is as deep as the tree, so each level is one more explode. A region
    without children lacks the field or has an empty list.
    """
    nodes = spark.read.option("multiLine", not lines).json(path).withColumn("_parent", F.lit(None).cast("long"))
    out, level = None, 0
    while True:
        field = lambda c, kind: (F.col(c) if c in nodes.columns else F.lit(None)).cast(kind)  # noqa: B023, E731
        listed = nodes.filter(~F.coalesce(F.col("elsewhere").try_cast("boolean"), F.lit(False))) if lines and "elsewhere" in nodes.columns else nodes
        rows = listed.select(field(region_id, "long").alias("region_id"), field(name, "string").alias("name"), F.col("_parent").alias("parent_id"), F.lit(level).alias("level"))
        out = rows if out is None else out.unionByName(rows)
        kind = nodes.schema[children].dataType if children in nodes.columns else None
        if not isinstance(kind, ArrayType) or not isinstance(kind.elementType, StructType):
            return out.filter("region_id IS NOT NULL")
        nodes = nodes.select(field(region_id, "long").alias("_parent"), F.explode(children).alias("_c")).select("_c.*", "_parent")
        level += 1


def write_ontology(nodes: DataFrame, path: str, lot: int = 10_000) -> None:
    """Nodes (region_id, name, above: ids from the root down to the parent) as JSON trees of nested children, a document a line.

    Siblings with ids in one range of lot numbers share a document, nested under their path from the root, whose nodes
    are marked ``elsewhere``. Ids are unique, so no row holds more than lot nodes, whatever the tree's shape.
    """
    lots = nodes.groupBy("above", F.floor(F.col("region_id") / lot).alias("_lot")).agg(F.to_json(F.collect_list(F.struct(F.col("region_id").alias("id"), "name"))).alias("value"))
    under = lambda inner, above: F.concat(F.lit('[{"id":'), F.coalesce(above.cast("string"), F.lit("null")), F.lit(',"elsewhere":true,"children":'), inner, F.lit("}]"))
    lots.select(F.aggregate(F.reverse("above"), F.col("value"), under).alias("value")).write.text(path)


def scan_regions(spark: SparkSession, path: str, region_id: str = "id", name: str = "name", parent: str = "parent") -> DataFrame:
    """(region_id, name, parent_id, level) of a region sheet in CSV with a header; a region without a parent has level 0.

    Other columns are ignored. Missing columns, numbers that are none, repeated ids, parents that are no region and
    cycles raise. The depth comes from the closure of the tree, whose rounds grow with the logarithm of the depth.
    """
    rows = spark.read.csv(path, header=True)
    if missing := {region_id, name, parent} - set(rows.columns):
        raise ValueError(f"no column {', '.join(sorted(missing))}")
    number = lambda c: F.trim(c).try_cast("long")
    sheet = spill(rows.select(number(F.col(region_id)).alias("region_id"), F.trim(name).alias("name"), number(F.col(parent)).alias("parent_id"), (F.length(F.trim(parent)) > 0).alias("_given")))
    known = sheet.groupBy("region_id").agg(F.count("*").alias("_n"))
    checks = {
        "ids that are no numbers": sheet.filter("region_id IS NULL"),
        "parents that are no numbers": sheet.filter("_given AND parent_id IS NULL"),
        "repeated ids": known.filter("_n > 1"),
        "parents that are no region": sheet.filter("parent_id IS NOT NULL").join(known.select(F.col("region_id").alias("parent_id")), "parent_id", "left_anti"),
    }
    for what, bad in checks.items():
        if found := bad.limit(5).collect():
            raise ValueError(f"{what}: {', '.join(str(tuple(r)) for r in found)}")
    tree = sheet.drop("_given")
    depth = closure(tree).groupBy("region_id").agg((F.count("*") - 1).cast("int").alias("level"))
    return tree.join(depth, "region_id")


def write_level_sheets(regions: DataFrame, path: str) -> None:
    """The regions as CSV sheets with a header, a folder for each level, in order of their ids in each file."""
    regions.repartition("level").sortWithinPartitions("level", "region_id").write.mode("overwrite").partitionBy("level").option("header", True).csv(path)


def parse_triple(text, default: tuple[int, int, int]):
    """``"z,y,x"`` as integers, the default where a part is no number or parts are missing."""
    parts = F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("int"))
    good = (F.size(parts) == 3) & F.forall(parts, lambda x: x.isNotNull())
    return F.when(good, parts).otherwise(F.array(*[F.lit(x) for x in default]))


def write_report(report: DataFrame, path: str) -> None:
    """One folder of Parquet for each level that has rows."""
    report.write.mode("overwrite").partitionBy("level").parquet(path)


def append_record(record: DataFrame, path: str) -> None:
    """Adds rows of parameters and results to a table."""
    record.write.mode("append").parquet(path)


def write_channels(volume: DataFrame, path: str) -> None:
    """Slices or bricks as zstd Parquet, a folder for each channel, in order of z."""
    order = "z" if "z" in volume.columns else "bz"
    volume.repartition("channel", order).sortWithinPartitions("channel", order).write.mode("overwrite").option("compression", "zstd").partitionBy("channel").parquet(path)


def uint16_slices(vox: DataFrame, prefix: str) -> DataFrame:
    """vox narrowed to 16 bits, with the name of the slice that each voxel belongs to."""
    return vox.withColumn("value", wrap_uint16(F.col("value"))).withColumn("name", F.format_string(f"{prefix}_%04d", "z"))
