"""Three-dimensional equalisation against plain loops."""

import numpy as np
import pytest
from test_volumes import dense, sparse

from stratavox.operators import equalise


def plain(a, clip, grid, bins):
    size = [-(-n // g) for n, g in zip(a.shape, grid)]
    count = [-(-n // t) for n, t in zip(a.shape, size)]
    luts = {}
    for t in np.ndindex(*count):
        tile = a[tuple(slice(k * s, (k + 1) * s) for k, s in zip(t, size))]
        hist = np.bincount(tile.ravel(), minlength=bins)
        limit = max(int(clip * tile.size / bins), 1)
        over = int(np.maximum(hist - limit, 0).sum())
        hist = np.minimum(hist, limit) + over // bins
        if rest := over % bins:
            hist[:: max(bins // rest, 1)][:rest] += 1
        luts[t] = np.minimum((2 * np.cumsum(hist) * (bins - 1) + tile.size) // (2 * tile.size), bins - 1)
    out = np.zeros(a.shape, int)
    for p in np.argwhere(a):
        sides = []
        for c, s, n in zip(p, size, count):
            away = 2 * int(c) + 1 - s
            low, f = divmod(away, 2 * s)
            sides.append([(min(max(low + o, 0), n - 1), f if o else 2 * s - f) for o in (0, 1)])
        total = sum(w0 * w1 * w2 * int(luts[i, j, k][a[tuple(p)]]) for i, w0 in sides[0] for j, w1 in sides[1] for k, w2 in sides[2])
        whole = 8 * size[0] * size[1] * size[2]
        out[tuple(p)] = (2 * total + whole) // (2 * whole)
    return out


@pytest.mark.parametrize(("grid", "bins", "clip"), [((2, 2, 2), 256, 2.0), ((3, 4, 5), 64, 1.0), ((1, 1, 1), 256, 40.0), ((2, 3, 1), 4096, 2.0)])
def test_equals_plain_loops(spark, grid, bins, clip):
    rng = np.random.default_rng(2)
    a = rng.integers(0, min(bins, 200), (7, 13, 16))
    a[rng.random(a.shape) < 0.4] = 0
    a[:3, :5, :5] = 0  # a tile of background
    got = dense(equalise.clahe_3d(sparse(spark, a), a.shape, clip, grid, bins), a.shape)
    assert (got == plain(a, clip, grid, bins)).all()


def test_of_no_voxels(spark):
    assert equalise.clahe_3d(sparse(spark, np.ones((2, 2, 2), int)).limit(0), (2, 2, 2), grid=(1, 1, 1)).count() == 0
