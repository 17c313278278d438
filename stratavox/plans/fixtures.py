"""Volumes derived from the driver's tables; the SQL text beside each says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Planes, rows and columns of a stack. A volume is as many stacks, one on the other, as the order keys need.
STACK, NY, NX = 32, 256, 256
ORDERS = 8192
SEG_NY, SEG_NX = 64, 64


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def planes(spark: SparkSession, d: str) -> int:
    """Planes of the volume; they grow with the table."""
    top = table(spark, d, "lineitem").agg(F.max("l_orderkey")).first()[0]
    return STACK * (1 + (top or 0) // ORDERS)


def shape(spark: SparkSession, d: str) -> tuple[int, int, int]:
    return planes(spark, d), NY, NX


def seg_shape(spark: SparkSession, d: str) -> tuple[int, int, int]:
    return planes(spark, d), SEG_NY, SEG_NX


def _places() -> list:
    """z, y and x of a row of lineitem."""
    z = (F.col("l_suppkey") % STACK + STACK * F.floor(F.col("l_orderkey") / ORDERS)).cast("int").alias("z")
    return [z, *[(F.col(c) % n).cast("int").alias(k) for c, n, k in (("l_orderkey", NY, "y"), ("l_partkey", NX, "x"))]]


def vox(spark: SparkSession, d: str) -> DataFrame:
    """(channel, z, y, x, value): two channels, value 40 to 2000."""
    channel = (F.col("l_linenumber") % 2).cast("int").alias("channel")
    return table(spark, d, "lineitem").groupBy(channel, *_places()).agg((F.max("l_quantity") * 40).cast("int").alias("value"))


def flat(spark: SparkSession, d: str) -> DataFrame:
    """(z, y, x, value): both channels in one volume, the brighter voxel of each place."""
    return table(spark, d, "lineitem").groupBy(*_places()).agg((F.max("l_quantity") * 40).cast("int").alias("value"))


def mask(spark: SparkSession, d: str) -> DataFrame:
    return flat(spark, d).filter("value > 1000")


def seg_in(spark: SparkSession, d: str) -> DataFrame:
    """Bright voxels on a grid a quarter as fine (SEG_NY x SEG_NX), so that they touch."""
    cells = flat(spark, d).filter("value > 1700")
    return cells.groupBy("z", F.floor(F.col("y") / 4).cast("int").alias("y"), F.floor(F.col("x") / 4).cast("int").alias("x")).agg(F.max("value").alias("value"))


def bright(spark: SparkSession, d: str) -> DataFrame:
    return flat(spark, d).filter("value > 1960").select("z", "y", "x", F.lit(255).alias("value"))


def labels(spark: SparkSession, d: str) -> DataFrame:
    """(z, y, x, label) of all occupied cells; the first and last plane of a stack are background."""
    label = F.when((F.col("z") % STACK).isin(0, STACK - 1), 0).otherwise(1 + F.floor(F.col("x") / 52) * 5 + F.floor(F.col("y") / 52)).cast("int")
    return table(spark, d, "lineitem").select(*_places()).distinct().withColumn("label", label)


def regions(spark: SparkSession, d: str) -> DataFrame:
    root = spark.sql("SELECT 1000 AS region_id, 'root' AS name, CAST(NULL AS INT) AS parent_id, 0 AS level")
    r = table(spark, d, "region").select((F.col("r_regionkey") + 100).cast("int").alias("region_id"), F.col("r_name").alias("name"), F.lit(1000).alias("parent_id"), F.lit(1).alias("level"))
    n = table(spark, d, "nation").select((F.col("n_nationkey") + 1).cast("int").alias("region_id"), F.col("n_name").alias("name"), (F.col("n_regionkey") + 100).cast("int").alias("parent_id"), F.lit(2).alias("level"))
    return root.unionByName(r).unionByName(n)


def atlas(spark: SparkSession, d: str, cells: DataFrame | None = None) -> DataFrame:
    """cells: the labels, where they are at hand already."""
    return (labels(spark, d) if cells is None else cells).select("z", "y", "x", F.when(F.col("label") != 0, 1).otherwise(0).alias("value"))


def edge(spark: SparkSession, d: str, cells: DataFrame | None = None) -> DataFrame:
    on = (F.col("x") % 52 == 0) | (F.col("y") % 52 == 0)
    return (labels(spark, d) if cells is None else cells).select("z", "y", "x", F.when(on, 200).otherwise(0).alias("value"))


def spots(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_id").alias("spot_id"), F.floor(F.col("user_id") / 2048).cast("int").alias("image"), F.col("value").cast("double").alias("y"), (F.col("user_id") % 2048 * 2.0).alias("x"))


def files(spark: SparkSession, d: str) -> DataFrame:
    """(name): file names of all kinds, some that name no channel."""
    s = lambda c: F.col(c).cast("string")
    k = F.col("l_linenumber") % 4
    name = (
        F.when(k == 0, F.concat(F.lit("scan_s"), s("l_suppkey"), F.lit("_C"), s("l_linenumber"), F.lit("_Z"), F.lpad((F.col("l_partkey") % 10000).cast("string"), 4, "0"), F.lit(".tif")))
        .when(k == 1, F.concat(F.lit("old_"), s("l_orderkey"), F.lit("_Ch"), s("l_linenumber"), F.lit(".tif")))
        .when(k == 2, F.concat(F.lit("scan_c"), s("l_linenumber"), F.lit("_z"), s("l_partkey"), F.lit(".TIFF")))
        .otherwise(F.concat(F.lit("readme_"), s("l_orderkey"), F.lit(".txt")))
    )
    return table(spark, d, "lineitem").select(name.alias("name")).distinct()


def slice_files(spark: SparkSession, d: str) -> DataFrame:
    """(channel, name, height, width, dtype): an inventory of slices, one for each order."""
    o = table(spark, d, "orders")
    return o.select(
        (F.col("o_orderkey") % 5).cast("int").alias("channel"),
        F.format_string("s_%08d.tif", F.col("o_orderkey").cast("long")).alias("name"),
        (100 + F.col("o_custkey") % 3).cast("int").alias("height"),
        F.lit(64).alias("width"),
        F.when(F.col("o_orderkey") % 2 == 0, "<u2").otherwise("|u1").alias("dtype"),
    ).distinct()


#: The same tables in SQL.
SQL = {
    "dims": f"SELECT CAST({STACK} * (1 + max(l_orderkey) // {ORDERS}) AS BIGINT) AS nz FROM lineitem",
    "vox": f"SELECT CAST(l_linenumber % 2 AS INT) AS channel, CAST(l_suppkey % {STACK} + {STACK} * (l_orderkey // {ORDERS}) AS INT) AS z, CAST(l_orderkey % {NY} AS INT) AS y, CAST(l_partkey % {NX} AS INT) AS x, CAST(MAX(l_quantity) * 40 AS INT) AS value FROM lineitem GROUP BY 1, 2, 3, 4",
    "flat": "SELECT z, y, x, max(value) AS value FROM vox GROUP BY 1, 2, 3",
    "mask": "SELECT z, y, x, value FROM flat WHERE value > 1000",
    "seg_in": "SELECT z, y // 4 AS y, x // 4 AS x, max(value) AS value FROM flat WHERE value > 1700 GROUP BY 1, 2, 3",
    "bright": "SELECT z, y, x, 255 AS value FROM flat WHERE value > 1960",
    "labels_vox": f"SELECT DISTINCT z, y, x, CAST(CASE WHEN z % {STACK} IN (0, {STACK - 1}) THEN 0 ELSE 1 + (x // 52) * 5 + y // 52 END AS INT) AS label FROM vox",
    "regions": "SELECT 1000 AS region_id, 'root' AS name, CAST(NULL AS INT) AS parent_id, 0 AS level UNION ALL SELECT CAST(100 + r_regionkey AS INT), r_name, 1000, 1 FROM region UNION ALL SELECT CAST(1 + n_nationkey AS INT), n_name, CAST(100 + n_regionkey AS INT), 2 FROM nation",
    "atlas": "SELECT z, y, x, CASE WHEN label <> 0 THEN 1 ELSE 0 END AS value FROM labels_vox",
    "edge": "SELECT z, y, x, CASE WHEN x % 52 = 0 OR y % 52 = 0 THEN 200 ELSE 0 END AS value FROM labels_vox",
    "spots": "SELECT event_id AS spot_id, CAST(user_id // 2048 AS INT) AS image, CAST(value AS DOUBLE) AS y, user_id % 2048 * 2.0 AS x FROM events",
    "files": """SELECT DISTINCT CASE l_linenumber % 4
        WHEN 0 THEN 'scan_s' || l_suppkey || '_C' || l_linenumber || '_Z' || lpad(CAST(l_partkey % 10000 AS VARCHAR), 4, '0') || '.tif'
        WHEN 1 THEN 'old_' || l_orderkey || '_Ch' || l_linenumber || '.tif'
        WHEN 2 THEN 'scan_c' || l_linenumber || '_z' || l_partkey || '.TIFF'
        ELSE 'readme_' || l_orderkey || '.txt' END AS name FROM lineitem""",
    "slice_files": "SELECT DISTINCT CAST(o_orderkey % 5 AS INT) AS channel, 's_' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') || '.tif' AS name, CAST(100 + o_custkey % 3 AS INT) AS height, 64 AS width, CASE WHEN o_orderkey % 2 = 0 THEN '<u2' ELSE '|u1' END AS dtype FROM orders",
    "slices": "SELECT *, CAST(row_number() OVER (PARTITION BY channel ORDER BY name) - 1 AS INT) AS z FROM slice_files",
}
NEEDS = {"flat": ["vox"], "mask": ["flat"], "seg_in": ["flat"], "bright": ["flat"], "labels_vox": ["vox"], "atlas": ["labels_vox"], "edge": ["labels_vox"], "slices": ["slice_files"]}


def with_tables(names: str, body: str, more: str = "") -> str:
    """body with the named tables (and what they need) before it; more: further common table expressions."""
    order: list[str] = []

    def need(n: str) -> None:
        for x in NEEDS.get(n, []):
            need(x)
        if n not in order:
            order.append(n)

    for n in ["dims", *names.split()]:
        need(n)
    parts = [f"{n} AS ({SQL[n]})" for n in order] + ([more] if more else [])
    return f"WITH RECURSIVE {', '.join(parts)} {body}"
