"""Row-column transforms over bundles against whole transforms."""

import numpy as np
import pytest

from stratavox.operators import filters, fourier


def table(spark, images):
    return spark.createDataFrame([(z, *a.shape, a.dtype.str, bytearray(a.tobytes())) for z, a in enumerate(images)], "z int, height int, width int, dtype string, data binary").repartition(2)


def arrays(df):
    return {r["z"]: np.frombuffer(r["data"], r["dtype"]).reshape(r["height"], r["width"]) for r in df.collect()}


@pytest.fixture(scope="module")
def images():
    rng = np.random.default_rng(9)
    smooth = np.add.outer(np.arange(512), np.arange(384)) * 40
    return [(smooth + rng.integers(0, 500, smooth.shape)).astype("<u2"), rng.integers(0, 255, (35, 51)).astype("u1"), np.zeros((40, 30), "<u2"), rng.integers(0, 60_000, (1, 77)).astype("<u2"), rng.random((70, 1)), rng.integers(1, 9, (64, 64)).astype("<u2")]


def test_bundles_are_the_slices(spark, images):
    for rows in (1, 64, 1000):
        cut = fourier.to_bundles(table(spark, images), rows)
        assert cut.count() == sum(-(-len(a) // rows) for a in images)
        got = arrays(fourier.from_bundles(cut))
        assert all((got[z] == a).all() for z, a in enumerate(images))


@pytest.mark.parametrize(("rows", "columns"), [(64, 64), (7, 5)])
def test_equals_the_whole_transform(spark, images, rows, columns):
    got = arrays(fourier.from_bundles(fourier.homomorphic_bundles(fourier.to_bundles(table(spark, images), rows), 30.0, columns=columns)))
    for z, a in enumerate(images):
        want = filters.homomorphic(a, 30.0)
        assert np.abs(got[z] - want).max() <= 1e-9 * max(1, np.abs(want).max())


def test_cutoff_equals_that_of_whole_slices(spark, images):
    for side in (16, 256):
        want = {r["z"]: r["d0"] for r in filters.adaptive_d0(table(spark, images), 0.98, side).collect()}
        got = {r["z"]: r["d0"] for r in fourier.adaptive_d0_bundles(fourier.to_bundles(table(spark, images), 20), 0.98, side).collect()}
        assert set(got) == set(want) and all(abs(got[z] - want[z]) < 1e-9 for z in want)


def test_no_slices(spark, images):
    none = fourier.to_bundles(table(spark, images).limit(0))
    assert fourier.homomorphic_bundles(none, 30.0).count() == 0 and fourier.adaptive_d0_bundles(none).count() == 0
