"""Background removal on bricks with borrowed rims equals that of whole planes."""

import numpy as np
import pandas as pd
import pytest

from stratavox.operators import blocks, filters, kernels


def by_brick(spark, cells, chunk):
    vox = pd.DataFrame(dict(zip("zyx", (a.astype("int32") for a in np.nonzero(cells)), strict=True)) | {"value": cells[np.nonzero(cells)].astype("int32")})
    return blocks.to_bricks(spark.createDataFrame(vox, "z int, y int, x int, value int"), cells.shape, chunk)


@pytest.mark.parametrize("radius, n", [(0, 1), (0, 7), (1, 1), (2, 5), (3, 7), (4, 40), (30, 11)])
def test_running_best(radius, n):
    x = np.random.default_rng(radius + n).integers(0, 99, (3, n))
    for best, plain in ((np.minimum, np.min), (np.maximum, np.max)):
        lines = np.array([[plain(r[max(k - radius, 0) : k + radius + 1]) for k in range(n)] for r in x])
        want = np.array([[plain(c[max(k - radius, 0) : k + radius + 1]) for k in range(3)] for c in lines.T]).T
        assert (filters.sliding(x, radius, best) == want).all()


@pytest.mark.parametrize("chunk, radius, sigma", [((1, 16, 16), 3, 1.0), ((2, 7, 90), 5, 0.5), ((3, 64, 64), 2, 0.0), ((1, 9, 11), 40, 1.0)])
def test_bricks_equal_whole_planes(spark, chunk, radius, sigma):
    rng = np.random.default_rng(5)
    cells = (200 + 100 * np.sin(np.arange(50) / 9)[None, :, None] + rng.integers(0, 60, (3, 50, 61))).astype(np.uint16)
    cells[1, :20] = 0
    cells[2] = 0
    out = filters.remove_background_bricks(by_brick(spark, cells, (2, 20, 30)), cells.shape, chunk, radius, sigma)
    got = np.zeros_like(cells)
    for r in kernels.cell_rows(out, "int").collect():
        got[r["z"], r["y"], r["x"]] = r["value"]
    assert (got == np.stack([filters.remove_background(p, radius, sigma) for p in cells])).all()


def test_a_task_holds_a_rim_only(spark, tmp_path):
    """The cells that a task gets are a brick's and the rim's, not the plane's; an empty volume stays empty."""
    cells = np.ones((1, 400, 400), np.uint16)
    rim = 2 * 5 + 4
    slabs = kernels.halo_slabs(by_brick(spark, cells, (1, 50, 50)), cells.shape, (1, 50, 50), (0, rim, rim))
    most = max(r["n"] for r in slabs.selectExpr("bz", "by", "bx", "dy * dx AS n").groupBy("bz", "by", "bx").agg({"n": "sum"}).toDF("bz", "by", "bx", "n").collect())
    assert most == (50 + 2 * rim) ** 2
    assert filters.remove_background_bricks(by_brick(spark, 0 * cells, (1, 50, 50)), cells.shape, (1, 50, 50), 5, 1.0).count() == 0
