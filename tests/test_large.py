"""What larger tables ask for: bounded batches, plane numbers of five digits, and the same results by cheaper ways."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavox.operators import blocks, density, filters, fourier, kernels, overlap, voxels
from stratavox.plans import catalog, fixtures
from stratavox.storage import in_frames, spill

from test_queries import rows

duckdb = pytest.importorskip("duckdb")


def lineitem(spark, path, orders, seed=1):
    """A table of a few lines of the given orders."""
    rng = np.random.default_rng(seed)
    lines = [(int(o), int(rng.integers(0, 2000)), int(rng.integers(0, 100)), k, float(rng.integers(1, 51))) for o in orders for k in range(4)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double").write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def same_as_sql(spark, d, name):
    con = duckdb.connect()
    con.sql(f"create view lineitem as select * from '{d}/lineitem.parquet/*.parquet'")
    got, want = catalog.QUERIES[name](spark, d), con.sql(catalog.ORACLE_SQL[name])
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_images_come_in_small_batches(spark):
    images = spark.range(48, numPartitions=1).select(F.expr("CAST(rpad('', 1000000, 'x') AS BINARY)").alias("data"))

    def count(parts):
        import pandas as pd

        for pdf in parts:
            yield pd.DataFrame({"n": [len(pdf)]})

    found = [r["n"] for r in in_frames(images, count, "n int").collect()]
    assert sum(found) == 48 and max(found) <= 10


def test_slice_of_one_brick_is_that_brick(spark):
    vox = spark.createDataFrame([(3, 1, 2, 7), (3, 4, 0, 9), (5, 0, 0, 1)], "z int, y int, x int, value int")
    for tile in (2, 8):
        got = blocks.to_slices(vox, (9, 5, 6), "<u2", "img", tile).orderBy("z").collect()
        assert [(r["z"], r["name"], r["height"], r["width"], r["dtype"]) for r in got] == [(3, "img_0003", 5, 6, "<u2"), (5, "img_0005", 5, 6, "<u2")]
        cells = np.frombuffer(got[0]["data"], "<u2").reshape(5, 6)
        assert cells[1, 2] == 7 and cells[4, 0] == 9 and cells.sum() == 16


def test_names_beyond_four_digits_as_in_sql_slice_export(spark, tmp_path):
    same_as_sql(spark, lineitem(spark, tmp_path, [5, 8192 * 400]), "slice_export")


@pytest.mark.parametrize("name", ["channel_extract", "registered_slices"])
def test_names_beyond_four_digits_as_in_sql(spark, tmp_path, name):
    same_as_sql(spark, lineitem(spark, tmp_path, [5, 8192 * 400]), name)


def test_objects_by_region_beyond_32_bits(spark, tmp_path):
    """Slab 2250 times a million leaves 32 bits, also in the SQL's own numbers, so the counts are written out here."""
    d = str(tmp_path)
    lines = [(8192 * 563 + 60, 8, 4, 0, 50.0), (8192 * 563 + 60, 12, 4, 0, 50.0), (8192 * 563 + 60, 80, 4, 0, 50.0), (8192 * 563 + 15, 2, 4, 0, 1.0), (8192 * 563 + 15, 3, 4, 0, 1.0), (8192 * 563 + 15, 20, 4, 0, 1.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double").write.parquet(f"{d}/lineitem.parquet")
    got = {r["label"]: r["n_objects"] for r in catalog.QUERIES["objects_by_region"](spark, d).collect()}
    cells = {(int(r["z"]), int(r["y"]), int(r["x"])): r["label"] for r in fixtures.labels(spark, d).collect()}
    touched = {}
    for r in catalog.QUERIES["components_slab"](spark, d).collect():
        at = (r["z"], r["y"], r["x"])
        if cells.get(at):
            touched.setdefault((r["slab"], r["obj_id"]), []).append(cells[at])
    want = {}
    for labels in touched.values():
        best = min(set(labels), key=lambda x: (-labels.count(x), x))
        want[best] = want.get(best, 0) + 1
    assert got == want and want


def test_near_distances_of_every_way(spark):
    """Dense surfaces, sparse ones, and voxels that meet nothing within any reach, against all pairs."""
    rng = np.random.default_rng(3)
    shape, steps = (70, 40, 40), (1, 2, 2)
    a = np.unique(np.r_[rng.integers(0, (12, 12, 12), (900, 3)), rng.integers(0, shape, (60, 3)), [[69, 39, 39]]], axis=0)
    for b in (np.unique(rng.integers(0, (14, 12, 12), (1200, 3)), axis=0), np.array([[0, 0, 0]]), np.zeros((0, 3), int)):
        frame = lambda p: spark.createDataFrame([tuple(map(int, r)) for r in p], "z int, y int, x int")
        got = {(r["z"], r["y"], r["x"]): r["dist2"] for r in overlap.surface_distance(frame(a), frame(b), shape, steps, 4).collect()}
        want = {tuple(map(int, p)): int((((p - b) * steps) ** 2).sum(axis=1).min()) for p in a} if len(b) else {}
        assert got == want


def test_no_transform_of_the_volume_where_surfaces_are_near(spark, monkeypatch):
    monkeypatch.setattr(overlap, "distance_bricks", lambda *a: pytest.fail("the whole volume was transformed"))
    a = spark.createDataFrame([(5, 5, 5), (40, 9, 9)], "z int, y int, x int")
    b = spark.createDataFrame([(6, 5, 5), (40, 9, 4)], "z int, y int, x int")
    assert sorted(r["dist2"] for r in overlap.surface_distance(a, b, (64, 16, 16)).collect()) == [1, 25]


def test_block_with_too_many_voxels_hands_them_on(spark, monkeypatch):
    monkeypatch.setattr(overlap, "HELD", 20)
    a = spark.range(64).selectExpr("CAST(id % 4 AS INT) AS z", "CAST(id / 16 AS INT) AS y", "CAST(id / 4 % 4 AS INT) AS x")
    b = a.filter("z = 3")
    assert sorted(r["dist2"] for r in overlap.surface_distance(a, b, (8, 8, 8)).collect()) == sorted([0, 1, 4, 9] * 16)


def test_surfaces_as_dense_as_they_come():
    rng = np.random.default_rng(5)
    p, q, scale = rng.integers(0, 9, (300, 3)), rng.integers(3, 12, (200, 3)), np.array((1, 2, 3))
    assert (overlap._transformed(p, q, scale) == overlap._nearest(p, q, scale)).all()


def test_stored_images_have_small_row_groups(spark):
    """64 rows at most, though all these empty images compress to less than one row group's bytes."""
    import glob

    import pyarrow.parquet as pq

    images = spark.range(300, numPartitions=1).select(F.expr("CAST(rpad('', 100000, '\\0') AS BINARY)").alias("data"))
    path = spill(images).inputFiles()[0].rpartition("/")[0].removeprefix("file://")
    found = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/*.parquet")]
    assert max(m.row_group(k).num_rows for m in found for k in range(m.num_row_groups)) <= 64


def test_masks_are_never_broadcast(spark):
    vox = spark.createDataFrame([(0, 0, 0, 5), (1, 2, 3, 7)], "z int, y int, x int, value int")
    out = voxels.mask_to(vox, vox.filter("value > 5"))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 1


def test_heat_at_cells_is_the_heat_there(spark):
    rng = np.random.default_rng(6)
    shape, chunk = (9, 20, 30), (4, 8, 16)
    frame = lambda n, seed: spark.createDataFrame([(*map(int, p), 255) for p in np.unique(np.random.default_rng(seed).integers(0, shape, (n, 3)), axis=0)], "z int, y int, x int, value int")
    signal, atlas = blocks.to_bricks(frame(6, 1), shape, chunk), blocks.to_bricks(frame(900, 2), shape, chunk, "|u1")
    want = kernels.cells_where(density.heat_bricks(signal, shape, 1.5, 2.0, chunk), atlas, "double").filter("value <> 0").collect()
    assert want and sorted(map(tuple, density.heat_at(signal, atlas, shape, 1.5, 2.0, chunk).collect())) == sorted(map(tuple, want))


def test_cutoffs_are_found_where_spectra_are_made(spark):
    img = np.random.default_rng(7).integers(0, 900, (40, 50)).astype("<u2")
    images = spark.createDataFrame([(z, 40, 50, "<u2", bytearray((img + z).tobytes())) for z in range(3)], "z int, height int, width int, dtype string, data binary")
    found = filters.adaptive_d0(images)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    spectra = spark.createDataFrame([(z, int(r), float(e)) for z in range(3) for r, e in zip(*filters.spectrum_rows(img + z), strict=True)], "z int, dist2 long, energy double")
    want = {r["z"]: r["dist2"] for r in filters.energy_cutoff(spectra).collect()}
    assert {r["z"]: filters.cutoff_of(*filters.spectrum_rows(img + r["z"])) for r in found.collect()} == want


def test_slices_whole_or_in_tiles_are_the_same(spark):
    img = np.random.default_rng(8).integers(0, 900, (21, 18)).astype("<u2")
    images = spark.createDataFrame([(z, 21, 18, "<u2", bytearray((img + z).tobytes())) for z in range(3)], "z int, height int, width int, dtype string, data binary")
    bundles = fourier.to_bundles(images, 8)
    read = lambda df: {(r["z"], r["r0"]): np.frombuffer(r["data"], "<f8") for r in df.collect()}
    small, tiled = (read(fourier.homomorphic_bundles(bundles, 5.0, columns=4, whole=w)) for w in (fourier.WHOLE, 0))
    assert set(small) == set(tiled) and len(small) == 9
    assert all(np.allclose(small[k], tiled[k], rtol=1e-9, atol=1e-9) for k in small)
    a, b = (sorted(map(tuple, fourier.adaptive_d0_bundles(bundles, whole=w).collect())) for w in (fourier.WHOLE, 0))
    assert a == b and len(a) == 3


def test_smoothing_with_rims_is_that_along_lines(spark):
    rng = np.random.default_rng(9)
    shape = (20, 18, 25)
    vox = spark.createDataFrame([(*map(int, p), int(rng.integers(1, 900))) for p in np.unique(rng.integers(0, shape, (60, 3)), axis=0)], "z int, y int, x int, value int")
    out = {}
    for tile in (8, 32):  # a reach of 6 cells is more than half of 8
        cubes = blocks.to_bricks(vox, shape, (tile,) * 3)
        out[tile] = {(r["z"], r["y"], r["x"]): r["value"] for r in kernels.cell_rows(filters.homomorphic_bricks(cubes, shape, 3.0, tile=tile), "double").collect()}
    assert set(out[8]) == set(out[32]) and all(abs(out[8][k] - v) < 1e-9 for k, v in out[32].items())


def test_results_of_slices_go_on_a_few_at_a_time(spark):
    """Doubles are four times as large as what came in; a frame that goes on holds some MB of them."""
    images = spark.range(40, numPartitions=1).select(F.col("id").cast("int").alias("z"), F.lit(256).alias("height"), F.lit(256).alias("width"), F.lit("<u2").alias("dtype"), F.expr("CAST(rpad('', 131072, '\\0') AS BINARY)").alias("data"))
    kept = {}
    frame = type("Frame", (), {"schema": images.schema, "transform": lambda self, how, fn, schema: kept.update(fn=fn)})()
    blocks.map_slices(frame, lambda a, z: a + z)
    parts = list(kept["fn"](iter([images.toPandas()])))
    assert [z for p in parts for z in p["z"]] == list(range(40)) and max(p["data"].map(len).sum() for p in parts) <= 5 << 20
    assert all(np.frombuffer(x, "<f8").sum() == 65536.0 * z for p in parts for z, x in zip(p["z"], p["data"], strict=True))
