"""Sliding windows against plain loops over whole volumes."""

import numpy as np
import pandas as pd
import pytest

from stratavox.operators import blocks, kernels, windows


def bricks_of(spark, vol, chunk=(4, 5, 6)):
    z, y, x = np.nonzero(vol)
    pdf = pd.DataFrame({"z": z.astype("int32"), "y": y.astype("int32"), "x": x.astype("int32"), "value": vol[z, y, x].astype("int32")})
    return blocks.to_bricks(spark.createDataFrame(pdf, "z int, y int, x int, value int"), vol.shape, chunk, "<u2")


def dense(bricks, shape, dtype):
    out = np.zeros(shape, dtype)
    for r in bricks.collect():
        out[r.z0 : r.z0 + r.dz, r.y0 : r.y0 + r.dy, r.x0 : r.x0 + r.dx] = np.frombuffer(r.data, r.dtype).reshape(r.dz, r.dy, r.dx)
    return out


def axis(n, w, s):
    found = list(range(0, max(n - w, 0), s))
    return found + [max(n - w, 0)]


def plain(vol, window, step, model):
    total, weight = np.zeros(vol.shape), np.zeros(vol.shape)
    for at in [(a, b, c) for a in axis(vol.shape[0], window[0], step[0]) for b in axis(vol.shape[1], window[1], step[1]) for c in axis(vol.shape[2], window[2], step[2])]:
        cells = np.zeros(window, vol.dtype)
        seen = vol[tuple(slice(a, a + w) for a, w in zip(at, window, strict=True))]
        cells[tuple(slice(0, d) for d in seen.shape)] = seen
        got = model(cells[None])[0] if cells.any() else np.zeros(window)
        for z, y, x in np.ndindex(*seen.shape):
            w = 1
            for k, size in zip((z, y, x), window, strict=True):
                w *= min(k + 1, size - k)
            total[at[0] + z, at[1] + y, at[2] + x] += w * float(got[z, y, x])
            weight[at[0] + z, at[1] + y, at[2] + x] += w
    return total / weight


#: Each cell as a share of its window's sum, so that windows disagree about a cell; a lambda, so that it goes to tasks by value.
share = lambda cells: cells / cells.sum(axis=(1, 2, 3), keepdims=True)


@pytest.mark.parametrize("shape, window, step", [((9, 14, 13), (4, 6, 5), (3, 4, 5)), ((3, 20, 7), (5, 8, 8), (2, 3, 8)), ((6, 6, 6), (6, 6, 6), (6, 6, 6)), ((1, 1, 30), (2, 2, 7), (1, 2, 1))])
def test_like_plain_loops(spark, shape, window, step):
    vol = np.random.default_rng(3).integers(0, 60, shape) * (np.random.default_rng(4).random(shape) < 0.4)
    got = windows.predict_windows(bricks_of(spark, vol), shape, window, step, lambda: share, batch=3)
    assert np.allclose(dense(got, shape, float), plain(vol, window, step, share), rtol=1e-12, atol=0)


def test_whole_means_round_down_and_an_unchanged_volume_stays(spark):
    vol = np.random.default_rng(5).integers(0, 60000, (7, 11, 9))
    same = windows.predict_windows(bricks_of(spark, vol), vol.shape, (4, 4, 4), (2, 3, 4), lambda: lambda c: c, dtype="<u2")
    assert (dense(same, vol.shape, "<u2") == vol).all()
    bright = lambda c: 100 * (c * 4.0 > 3.0 * c.max(axis=(1, 2, 3), keepdims=True)).astype(np.uint8)
    got = windows.predict_windows(bricks_of(spark, vol), vol.shape, (4, 4, 4), (2, 3, 4), lambda: bright, dtype="|u1")
    assert (dense(got, vol.shape, "u1") == np.floor(plain(vol, (4, 4, 4), (2, 3, 4), bright) + 1e-9)).all()


def test_windows_come_in_batches_of_a_size_and_empty_ones_do_not_come(spark):
    vol = np.zeros((4, 4, 40), int)
    vol[:, :, :12] = 7

    def load():
        def model(cells):
            if len(cells) > 2 or not cells.any(axis=(1, 2, 3)).all():
                raise AssertionError("batch")
            return np.ones_like(cells)

        return model

    got = dense(windows.predict_windows(bricks_of(spark, vol), vol.shape, (4, 4, 8), (4, 4, 4), load, batch=2), vol.shape, float)
    assert (got[:, :, :12] == 1).all() and (got[:, :, 16:] == 0).all()
    assert (got[:, :, 12:16] < 1).all() and (got[:, :, 12:16] > 0).all()  # the next window is empty


def test_no_bricks_and_gaps(spark):
    none = bricks_of(spark, np.zeros((4, 4, 4), int))
    assert windows.predict_windows(none, (4, 4, 4), (2, 2, 2), (1, 1, 1), lambda: share).count() == 0
    with pytest.raises(ValueError):
        windows.predict_windows(none, (4, 4, 4), (2, 2, 2), (3, 2, 2), lambda: share)


def test_every_cell_is_weighed():
    for n in range(1, 40):
        assert windows.starts(n, 6, 4) == axis(n, 6, 4)
        assert (windows.weight_sums(n, 6, 4) > 0).all()


def test_bricks_of_many_batches(spark):
    """A brick's voxels may come in several batches, and a batch may hold many bricks."""
    vol = np.random.default_rng(6).integers(1, 60000, (12, 40, 50))
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "201")
    try:
        for chunk in ((12, 40, 50), (3, 7, 11), (2, 4, 5)):
            got = bricks_of(spark, vol, chunk)
            assert got.count() == np.prod([-(-n // c) for n, c in zip(vol.shape, chunk, strict=True)])
            assert (dense(got, vol.shape, "<u2") == vol).all()
            assert kernels.cell_rows(got).count() == vol.size
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
