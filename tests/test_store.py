"""Stored slices and bricks: what a scan of a part gives, and what it leaves closed."""

import numpy as np
from pyspark.sql import functions as F
from test_volumes import dense, sparse

from stratavox.operators import blocks
from stratavox.sources import store


def scanned(df):
    """(files, rows) that the Parquet scan of a frame reads."""
    df = df.select("*")
    df.collect()
    todo, files, rows = [df._jdf.queryExecution().executedPlan()], 0, 0
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        if p.getClass().getSimpleName() == "FileSourceScanExec":
            m = p.metrics()
            files, rows = files + m.apply("numFiles").value(), rows + m.apply("numOutputRows").value()
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(p.plan())
        kids = p.children()
        todo += [kids.apply(k) for k in range(kids.size())]
    return files, rows


def test_a_range_of_planes_opens_its_files_only(spark, tmp_path):
    rows = [(c, z, f"s{z}", 2, 3, "<u2", bytearray(np.full((2, 3), 10 * c + z, "<u2").tobytes())) for c in range(3) for z in range(40)]
    slices = spark.createDataFrame(rows, "channel int, z int, name string, height int, width int, dtype string, data binary").repartition(5)
    path = str(tmp_path / "v")
    store.write_volume(slices, path, 8)
    whole = store.scan_volume(spark, path, depth=8)
    assert sorted(map(tuple, whole.select(slices.columns).collect())) == sorted(map(tuple, slices.collect()))
    part = store.scan_volume(spark, path, [1], (9, 20), 8)
    assert sorted((r["channel"], r["z"]) for r in part.collect()) == [(1, z) for z in range(9, 21)]
    assert scanned(whole)[0] == 15 and scanned(part)[0] == 2  # one file for each channel and batch
    assert store.scan_volume(spark, path, [], None, 8).count() == 0 and store.scan_volume(spark, path, [7], (0, 9), 8).count() == 0


def test_boxes_and_thresholds_leave_row_groups_out(spark, tmp_path):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 100, (32, 48, 48))
    a[16:] = 0
    a[5, 5, 5], a[30, 40, 40] = 5000, 4000
    bricks = blocks.to_bricks(sparse(spark, a), a.shape, (4, 8, 8), "<u2")
    path = str(tmp_path / "b")
    store.write_bricks(bricks.coalesce(1), path, group_bytes=1)
    whole = store.scan_bricks(spark, path)
    assert (dense(blocks.from_bricks(whole), a.shape) == a).all()
    key = [(r["key"], r["low"], r["high"], r["nonzero"], r["z0"], r["y0"], r["x0"]) for r in whole.collect()]
    for _, low, high, n, z, y, x in key:
        cells = a[z : z + 4, y : y + 8, x : x + 8]
        assert (low, high, n) == (cells.min(), cells.max(), np.count_nonzero(cells))
    assert len({k[0] for k in key}) == len(key)
    box = ((6, 9), (10, 17), (0, 47))
    part = store.scan_bricks(spark, path, box)
    cut = dense(blocks.from_bricks(part), a.shape)
    assert (cut[6:10, 10:18] == a[6:10, 10:18]).all()
    assert part.count() == 2 * 2 * 6
    bright = store.scan_bricks(spark, path, above=1000)
    assert sorted((r["z0"], r["y0"], r["x0"]) for r in bright.collect()) == [(4, 0, 0), (28, 40, 40)]
    plan = bright._jdf.queryExecution().toString()
    assert "GreaterThan(high,1000.0)" in plan and "GreaterThan(nonzero,0)" in plan
    assert scanned(bright)[1] <= scanned(whole)[1]


def test_interleaved_keys_differ_and_follow_blocks(spark):
    df = spark.range(8 * 8 * 8).select(F.floor(F.col("id") / 64).alias("a"), (F.floor(F.col("id") / 8) % 8).alias("b"), (F.col("id") % 8).alias("c"))
    got = {tuple(r)[:3]: r["k"] for r in df.select("a", "b", "c", store.interleaved(["a", "b", "c"]).alias("k")).collect()}
    assert sorted(got.values()) == list(range(512))
    assert {k for p, k in got.items() if max(p) < 4} == set(range(64))
    assert got[0, 0, 1] == 1 and got[0, 1, 0] == 2 and got[1, 0, 0] == 4
