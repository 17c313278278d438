"""Lists of transforms against plain loops."""

import numpy as np
import pytest
from test_volumes import dense, sparse

from stratavox.operators import transforms as T
from pyspark.sql import functions as F


def smooth_field(grid, step, size=3.0):
    """A field without folds: a few waves over the grid, 0 at its border."""
    at = np.stack(np.meshgrid(*[np.arange(n) for n in grid], indexing="ij"))
    wave = np.prod([np.sin(np.pi * a / (n - 1)) for a, n in zip(at, grid)], axis=0)
    return np.stack([size * wave * s / max(step) for s in step], axis=-1)


def node_rows(spark, u):
    return spark.createDataFrame([(*map(int, p), *map(float, u[p])) for p in np.ndindex(u.shape[:3])], "z int, y int, x int, dz double, dy double, dx double")


def at_point(u, step, p):
    """Trilinear displacement by loops; nodes beyond the grid do not move."""
    q = np.asarray(p, float) / step
    low = np.floor(q).astype(int)
    out = np.zeros(3)
    for o in np.ndindex(2, 2, 2):
        node = low + o
        if (node >= 0).all() and (node < u.shape[:3]).all():
            out += np.prod([f if k else 1 - f for f, k in zip(q - low, o)]) * u[tuple(node)]
    return out


def point_rows(spark, points):
    return spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(points)], "k int, pz double, py double, px double")


def moved(df):
    return np.array([r[1:] for r in sorted(map(tuple, df.select("k", "pz", "py", "px").collect()))])


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(8)
    return [*rng.uniform(-6, 40, (150, 3)), (0, 0, 0), (8, 8, 8), (28, 24, 20), (1000, -1000, 5)]


def test_points_go_through_all_steps_in_order(spark, points):
    grid, step = (8, 7, 6), (4.0, 4.0, 4.0)
    u = np.random.default_rng(1).normal(size=(*grid, 3))
    a = (1.0, 0.5, 0, 3.0, 0, 0.75, 0.25, -2.0, 0.1, 0, 2.0, 1.0)
    steps = [T.Affine(a), T.Field(node_rows(spark, u), step), T.Affine(a, True), T.Field(node_rows(spark, u).filter("z > 3"), step), T.Affine(a)]
    m = np.vstack([np.reshape(a, (3, 4)), [0, 0, 0, 1]])
    half = u.copy()
    half[:4] = 0
    want = []
    for p in points:
        p = (m @ [*p, 1])[:3]
        p = p + at_point(u, step, p)
        p = (np.linalg.inv(m) @ [*p, 1])[:3]
        p = p + at_point(half, step, p)
        want.append((m @ [*p, 1])[:3])
    assert np.allclose(moved(T.moved_points(point_rows(spark, points), steps)), want)
    assert np.allclose(moved(T.moved_points(point_rows(spark, points), [])), points)


def test_inverse_of_a_field_brings_points_back(spark, points):
    grid, step = (8, 9, 10), (4.0, 4.0, 4.0)
    field = node_rows(spark, smooth_field(grid, step))
    both = [T.Field(field, step), T.Field(field, step, True, grid)]
    for steps in (both, both[::-1]):
        off = np.abs(moved(T.moved_points(point_rows(spark, points), steps)) - points)
        assert off.max() < 0.5 and off.mean() < 0.05
    there = np.abs(moved(T.moved_points(point_rows(spark, points), both[:1])) - points)
    assert there.max() > 2  # the field does move points
    with pytest.raises(ValueError, match="grid"):
        T.inverse_field(T.Field(field, step, True))


def test_inverse_field_at_nodes_by_plain_rounds(spark):
    grid, step = (5, 6, 4), (2.0, 3.0, 4.0)
    u = smooth_field(grid, step, 1.5)
    v = np.zeros_like(u)
    for _ in range(60):
        v = np.array([-at_point(u, step, np.array(p) * step + v[p]) for p in np.ndindex(grid)]).reshape(u.shape)
    got = T.inverse_field(T.Field(node_rows(spark, u), step, True, grid), 60, 1e-9)
    assert np.allclose(np.stack([dense(got, grid, m) for m in T.MOVE], axis=-1), v, atol=1e-7)


def test_warp_of_a_volume_and_back(spark):
    rng = np.random.default_rng(2)
    a = np.zeros((12, 16, 20), int)
    a[3:9, 4:12, 5:15] = rng.integers(1, 5, (6, 8, 10))
    cells = sparse(spark, np.ones_like(a))
    grid, step = (4, 5, 6), (4.0, 4.0, 4.0)
    u = smooth_field(grid, step, 2.0)
    field, shift = node_rows(spark, u), (1, 0, 0, 1, 0, 1, 0, -2, 0, 0, 1, 3)
    got = dense(T.warp_list(cells, sparse(spark, a), [T.Field(field, step), T.Affine(shift)]), a.shape)
    for p in np.ndindex(a.shape):
        q = np.floor(np.array(p) + at_point(u, step, p) + (1, -2, 3) + 0.5).astype(int)
        inside = (q >= 0).all() and (q < a.shape).all()
        assert got[p] == (a[tuple(q)] if inside else 0)
    assert (dense(T.warp_list(cells, sparse(spark, a), []), a.shape) == a).all()
    assert T.warp_list(cells.limit(0), sparse(spark, a), [T.Affine(shift)]).count() == 0
    lost = T.warp_list(cells, sparse(spark, a), [T.Affine((1, 0, 0, 900, 0, 1, 0, 0, 0, 0, 1, 0))])
    assert lost.filter(F.col("value") != 0).count() == 0 and lost.count() == a.size
