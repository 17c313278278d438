"""Distance transform and overlap against plain loops."""

import numpy as np
from pyspark.sql import functions as F
from test_volumes import dense, sparse

from stratavox.operators import kernels, overlap


def test_envelope_by_plain_loops():
    rng = np.random.default_rng(3)
    for n, step in ((1, 1), (2, 3), (17, 1), (40, 2)):
        v = rng.integers(0, 60, (200, n))
        v[rng.random(v.shape) < 0.7] = overlap.NONE
        got = overlap.envelope(v, step)
        x = np.arange(n)
        want = (v[:, None, :] + (step * (x[:, None] - x[None, :])) ** 2).min(axis=2)
        assert (got == np.where(want < overlap.NONE, want, overlap.NONE)).all()


def test_distances_of_every_cell(spark):
    rng = np.random.default_rng(4)
    a = (rng.random((9, 14, 20)) < 0.01).astype(int)
    at = np.argwhere(a)
    for steps, tile in (((1, 1, 1), 32), ((3, 1, 2), 5)):
        got = dense(kernels.cell_rows(overlap.distance_bricks(sparse(spark, a), a.shape, steps, tile)), a.shape)
        want = np.array([((np.array(steps) * (at - p)) ** 2).sum(axis=1).min() + 1 for p in np.ndindex(a.shape)]).reshape(a.shape)
        assert (got == want).all()
    assert overlap.distance_bricks(sparse(spark, a).limit(0), a.shape).count() == 0


def test_quality_of_regions_and_edges(spark):
    a, b = np.zeros((4, 10, 12), int), np.zeros((4, 10, 12), int)
    a[1:3, 2:6, 2:8], b[1:3, 3:7, 2:8] = 1, 1
    a[0], b[3] = 2, 3
    ea, eb = a * 0, b * 0
    ea[1:3, 2, 2:8], eb[1:3, 3, 2:8], ea[0, 0, 0] = 1, 1, 2
    of = lambda x: sparse(spark, x, "label")
    got = {r["label"]: tuple(r)[1:] for r in overlap.registration_quality(of(a), of(b), of(ea), of(eb), a.shape, tile=4).collect()}
    assert got[1] == (48, 48, 0.75, 1.0, 1.0, 1.0, 1.0)
    assert got[2][:3] == (120, 0, 0.0) and got[2][3] == np.sqrt(1 + 9 + 4) and got[2][5] is None
    assert got[3] == (0, 120, 0.0, None, None, None, None)
    none = overlap.registration_quality(of(a), of(b), of(ea), of(eb).limit(0), a.shape)
    assert none.filter(F.col("mean_ab").isNotNull()).count() == 0 and none.count() == 3
