"""Operators against NumPy on small arrays, and properties that hold between them."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavox.operators import blocks, components, density, filters, kernels, names, objects, regions, resample, slices, voxels
from stratavox.sources import files as io
from stratavox.streaming import slices as streaming


def sparse(spark, a, name="value"):
    at = np.nonzero(a)
    return spark.createDataFrame([(*map(int, p), int(v)) for p, v in zip(zip(*at), a[at])], f"z int, y int, x int, {name} int")


def dense(df, shape, name="value"):
    out = np.zeros(shape)
    for r in df.collect():
        out[r["z"], r["y"], r["x"]] = r[name]
    return out


@pytest.fixture(scope="module")
def volume():
    rng = np.random.default_rng(42)
    a = rng.integers(0, 200, (8, 16, 16))
    a[a < 150] = 0
    z, y, x = np.ogrid[:8, :16, :16]
    for c, r in (((2, 4, 4), 3), ((5, 10, 11), 2), ((4, 12, 3), 2)):
        a[(z - c[0]) ** 2 + (y - c[1]) ** 2 + (x - c[2]) ** 2 <= r * r] = 1000
    return a


def test_bricks_round_trip(spark, volume):
    b = blocks.to_bricks(sparse(spark, volume), volume.shape, (3, 7, 16))
    assert (dense(blocks.from_bricks(b), volume.shape) == volume).all()
    assert b.count() == 3 * 3


def test_components_and_blocks_agree_with_propagation(spark, volume):
    fg = volume >= 150
    want = objects.label_faces(fg)
    v = sparse(spark, np.where(fg, volume, 0))
    whole = dense(objects.components(v, volume.shape).withColumn("value", F.col("root") + 1), volume.shape)
    assert (whole == want).all()
    blocked = objects.segment_blocks(v, volume.shape, lambda c: objects.label_faces(c >= 150), (3, 5, 7))
    assert (dense(blocked.withColumn("value", F.col("obj_id") + 1), volume.shape) == want).all()
    slabbed = objects.components(v, volume.shape, 4)
    assert slabbed.groupBy("root").agg(F.countDistinct("slab").alias("n")).filter("n > 1").count() == 0


def test_components_do_not_depend_on_partitions(spark, volume):
    v = sparse(spark, volume)
    key = lambda d: sorted(map(tuple, objects.components(d, volume.shape).select("lin", "root").collect()))
    assert key(v.repartition(1)) == key(v.repartition(7, F.rand(1)))


def test_otsu(spark):
    a = np.zeros((3, 4, 4), int)
    a[0] = 7
    a[1, :2], a[1, 2:] = 10, 90
    got = {r["slab"]: r["threshold"] for r in voxels.otsu(voxels.slab_histogram(sparse(spark, a), 1, a.shape)).collect()}
    assert got == {0: 7, 1: 10, 2: 0}


def test_smoothing_equals_numpy_and_block_path(spark, volume):
    w = filters.gaussian_1d(1.0)
    want = volume.astype(float)
    for k in range(3):
        want = filters.convolve(want, w, k, (True, True))
    got = dense(density.gaussian_smooth(sparse(spark, volume), volume.shape, 1.0), volume.shape)
    assert np.abs(got - want).max() < 0.5  # weights in units of 1/10000


def test_homomorphic_3d_has_no_seams(spark, volume):
    v = sparse(spark, volume)
    one = dense(filters.homomorphic_3d(v, volume.shape, 4.0), volume.shape)
    cut = dense(filters.homomorphic_3d(v, volume.shape, 4.0, tile=5), volume.shape)
    assert np.allclose(one, cut)
    s = 16 / (2 * np.pi * 4.0)
    log = low = np.log1p(volume)
    for k, x in enumerate((s / 1.111, s, s)):
        low = filters.convolve(low, filters.gaussian_1d(x), k, (True, True))
    assert np.allclose(one[volume > 0], np.expm1(1.5 * (log - low) + 0.5 * low)[volume > 0])


def test_homomorphic_3d_is_dense_around_signal(spark):
    a = np.zeros((8, 20, 24), int)
    a[3, 7, 8], a[4, 8, 11], a[0, 0, 0], a[7, 19, 23] = 900, 40, 7, 2000
    low = log = np.log1p(a)
    s = 24 / (2 * np.pi * 4.0)
    for k, x in enumerate((s / 1.111, s, s)):
        low = filters.convolve(low, filters.gaussian_1d(x), k, (True, True))
    want = np.expm1(1.5 * (log - low) + 0.5 * low)
    assert (want[a == 0] != 0).any()
    for tile in (32, 6):
        assert np.allclose(dense(filters.homomorphic_3d(sparse(spark, a), a.shape, 4.0, tile=tile), a.shape), want)


def slice_table(spark, images):
    return spark.createDataFrame([(z, *a.shape, a.dtype.str, bytearray(a.tobytes())) for z, a in enumerate(images)], "z int, height int, width int, dtype string, data binary")


def test_cutoff_by_plain_loops(spark):
    """Radius that holds 98 % of the power of the resized log image, pixel by pixel."""
    rng = np.random.default_rng(3)
    images = [rng.integers(0, 2000, (40, 52)).astype("<u2"), np.add.outer(np.arange(40), np.arange(52)).astype("<u2") * 30]
    side = 16
    for img, got in zip(images, filters.adaptive_d0(slice_table(spark, images), 0.98, side).orderBy("z").collect(), strict=True):
        h, w = img.shape
        small = np.zeros((side, side))
        for i in range(side):
            for j in range(side):
                y, x = min(max((i + 0.5) * h / side - 0.5, 0), h - 1), min(max((j + 0.5) * w / side - 0.5, 0), w - 1)
                a, b = int(y), int(x)
                c, e = min(a + 1, h - 1), min(b + 1, w - 1)
                small[i, j] = (float(img[a, b]) * (1 - x + b) + float(img[a, e]) * (x - b)) * (1 - y + a) + (float(img[c, b]) * (1 - x + b) + float(img[c, e]) * (x - b)) * (y - a)
        power = np.abs(np.fft.fft2(np.log1p(small))) ** 2
        cells = sorted((min(u, side - u) ** 2 + min(v, side - v) ** 2, power[u, v]) for u in range(side) for v in range(side))
        total, reached = sum(p for _, p in cells), 0.0
        for d in sorted({d for d, _ in cells}):
            reached += sum(p for c, p in cells if c == d)
            if reached >= 0.98 * total:
                break
        assert got["d0"] == pytest.approx(min(max(np.sqrt(d) * h / side, max(30.0, min(h, w) * 0.005)), min(h, w) * 0.2))


def test_homomorphic_2d_by_direct_transform():
    """The filter as a double sum over frequencies, on a small image."""
    img = np.random.default_rng(6).integers(0, 900, (8, 6))
    h, w = img.shape
    log = np.log(img + 1.0)
    u, v = np.arange(h), np.arange(w)
    eh, ew = np.exp(-2j * np.pi * np.outer(u, u) / h), np.exp(-2j * np.pi * np.outer(v, v) / w)
    spectrum = eh @ log @ ew
    du, dv = (u + h // 2) % h - h // 2, (v + w // 2) % w - w // 2
    gain = 1.5 * (1 - np.exp(-(du[:, None] ** 2 + dv[None, :] ** 2) / 2.5**2)) + 0.5
    want = np.exp((eh.conj() @ (spectrum * gain) @ ew.conj() / (h * w)).real) - 1
    assert np.allclose(filters.homomorphic(img, 2.5), want)


def plain_clahe(img, clip, grid):
    """Pixel by pixel, with the whole table of each tile."""
    bins = 256 if img.dtype == np.uint8 else 65536
    h, w = img.shape
    ph, pw = (grid - h % grid, grid - w % grid) if h % grid or w % grid else (0, 0)
    padded = np.pad(img, ((0, ph), (0, pw)), "reflect") if ph or pw else img
    th, tw = padded.shape[0] // grid, padded.shape[1] // grid
    table = {}
    for i in range(grid):
        for j in range(grid):
            hist = [0] * bins
            for v in padded[i * th : (i + 1) * th, j * tw : (j + 1) * tw].ravel().tolist():
                hist[v] += 1
            limit = max(int(clip * th * tw / bins), 1)
            excess = sum(max(n - limit, 0) for n in hist)
            hist = [min(n, limit) + excess // bins for n in hist]
            left, step = excess % bins, max(bins // max(excess % bins, 1), 1)
            for k in range(left):
                hist[k * step] += 1
            total, lut = 0, []
            for n in hist:
                total += n
                lut.append(min(max(int(np.rint(total * ((bins - 1) / (th * tw)))), 0), bins - 1))
            table[i, j] = lut
    out = np.zeros_like(img)
    inside = lambda k: min(max(k, 0), grid - 1)
    for y in range(h):
        for x in range(w):
            py, px = y / th - 0.5, x / tw - 0.5
            i, j = int(np.floor(py)), int(np.floor(px))
            at = lambda a, b: table[inside(a), inside(b)][img[y, x]]
            fy, fx = py - i, px - j
            top = at(i, j) * (1 - fx) + at(i, j + 1) * fx
            low = at(i + 1, j) * (1 - fx) + at(i + 1, j + 1) * fx
            out[y, x] = np.rint(top * (1 - fy) + low * fy)
    return out


def test_clahe_and_the_chain_by_plain_loops():
    rng = np.random.default_rng(5)
    for kind, top, shape, grid, clip in ((np.uint8, 256, (23, 31), 3, 2.0), (np.uint8, 256, (16, 16), 4, 40.0), (np.uint16, 3000, (18, 21), 2, 2.0)):
        img = rng.integers(0, top, shape).astype(kind)
        assert (filters.clahe(img, clip, grid) == plain_clahe(img, clip, grid)).all()
    img = rng.integers(0, 900, (20, 24)).astype(np.uint16)
    lifted = np.clip(filters.homomorphic(img, 6.0), 0, 65535).astype(np.uint16)
    assert (filters.enhance(img, 6.0, grid=2) == plain_clahe(lifted, 2.0, 2)).all()


def test_clahe_pads_both_sides_if_one_does_not_divide():
    """18 x 21 in 2 x 2 tiles: both sides grow, the even one by two rows, so tiles are 10 x 11; written out by hand."""
    img = np.random.default_rng(7).integers(0, 256, (18, 21)).astype(np.uint8)
    rows, cols = [*range(18), 16, 15], [*range(21), 19]
    by_hand = img[rows][:, cols]
    assert by_hand.shape == (20, 22)
    assert (filters.clahe(img, 2.0, 2) == filters.clahe(by_hand, 2.0, 2)[:18, :21]).all()
    even = img[:, :20]
    assert (filters.clahe(even, 2.0, 2) == plain_clahe(even, 2.0, 2)).all()  # nothing is padded here


def test_histogram_match_of_floats_is_within_the_rank_error(spark):
    rng = np.random.default_rng(1)
    x, y = rng.gamma(2.0, size=20_000), rng.normal(size=20_000)
    df = lambda v: spark.createDataFrame([(k, float(t)) for k, t in enumerate(v)], "k int, value double").repartition(7)
    for ranks in (10_000, 200):
        for values in (x, np.repeat(0.5, 5000)):
            got = filters.quantiles(df(values), [i / 65 for i in range(66)], ranks)
            order = np.sort(values)
            for i, q in enumerate(got):
                want = i / 65 * len(values)
                assert np.searchsorted(order, q, "left") - len(values) / ranks - 2 <= want <= np.searchsorted(order, q, "right") + len(values) / ranks + 2
    moved = {r["k"]: r["value"] for r in filters.match_histogram(df(x), df(y)).collect()}
    got = np.sort(list(moved.values()))
    assert np.abs(got[1000:-1000] - np.sort(y)[1000:-1000]).max() < 0.1
    plan = filters.match_histogram(df(x), df(y))._jdf.queryExecution().toString()
    assert "Join" not in plan.split("== Physical Plan ==")[1]


def test_background_by_plain_windows():
    rng = np.random.default_rng(8)
    img = rng.integers(0, 500, (20, 17)).astype(np.uint16)
    w = filters.gaussian_1d(1.0)
    r = len(w) // 2
    fold = lambda k, n: k if 0 <= k < n else (-1 - k if k < 0 else 2 * n - 1 - k)
    one = np.array([[sum(w[d + r] * img[fold(y + d, 20), x] for d in range(-r, r + 1)) for x in range(17)] for y in range(20)])
    smooth = np.array([[sum(w[d + r] * one[y, fold(x + d, 17)] for d in range(-r, r + 1)) for x in range(17)] for y in range(20)])
    window = lambda a, best: np.array([[best(a[max(y - 3, 0) : y + 4, max(x - 3, 0) : x + 4]) for x in range(17)] for y in range(20)])
    want = np.maximum(img - window(window(smooth, np.min), np.max), 0).astype(np.uint16)
    assert (filters.remove_background(img, 3, 1.0) == want).all()


def test_models_load_once_and_take_batches(spark, volume, tmp_path):
    cut = blocks.to_bricks(sparse(spark, volume), volume.shape, (4, 8, 8)).repartition(1)
    marks = str(tmp_path)

    def load():
        import uuid

        open(f"{marks}/{uuid.uuid4().hex}", "w").close()
        return lambda cells: np.where(cells > 500, len(cells), 0)

    got = blocks.predict_bricks(cut, load, batch=3).collect()
    assert len(list(tmp_path.iterdir())) == 1
    for r in got:
        a = volume[r["z0"] : r["z0"] + r["dz"], r["y0"] : r["y0"] + r["dy"], r["x0"] : r["x0"] + r["dx"]]
        found = np.frombuffer(r["data"], "<u2").reshape(a.shape)
        assert ((found > 0) == (a > 500)).all() and found.max() <= 3


def test_smoothing_in_whole_numbers_then_segmentation(spark, volume):
    w = [int(x * density.SCALE + 0.5) for x in filters.gaussian_1d(1.0)]
    want = volume.astype(np.int64)
    for k in range(3):
        for lo in range(0, 8, 4) if k == 0 else (0,):
            part = (slice(lo, lo + 4),) if k == 0 else (slice(None),)
            want[part] = (filters.convolve(want[part], np.array(w, float), k, (True, True)) + 1e-6).astype(np.int64) // density.SCALE
    v = sparse(spark, volume)
    assert (dense(density.gaussian_smooth(v, volume.shape, 1.0, 4, whole=True), volume.shape) == want).all()
    got = objects.segment_threshold(v, volume.shape, 200, 5, 4, 1.0)
    labels = [objects.label_faces(want[k : k + 4] > 200) for k in (0, 4)]
    sizes = sorted(n for x in labels for n in np.unique(x[x > 0], return_counts=True)[1] if n >= 5)
    assert sorted(r["size"] for r in objects.sizes(got).collect()) == sizes


def test_blank_slices_axes_and_directions(spark, volume):
    images = slice_table(spark, [np.zeros((3, 4), "<u2"), np.eye(3, 4, dtype="<u2"), np.zeros((3, 4), "<f8"), np.full((1, 1), 256, "<u2")])
    assert sorted(r["z"] for r in slices.drop_blank(images).collect()) == [1, 3]
    turned = dense(resample.permute_axes(sparse(spark, volume), "xzy"), (16, 8, 16))
    assert (turned == volume.transpose(2, 0, 1)).all()
    with pytest.raises(ValueError):
        resample.permute_axes(sparse(spark, volume), "xyy")
    one = spark.createDataFrame([(1, 2, 3)], "z int, y int, x int")
    r = resample.world_coordinates(one, (2, 3, 4), (10, 20, 30), (0, 1, 0, 1, 0, 0, 0, 0, -1)).first()
    assert (r["wx"], r["wy"], r["wz"]) == (10 + 6, 20 + 6, 30 - 4)
    cells = voxels.densify(sparse(spark, volume), volume.shape).select("z", "y", "x", "value")
    shift = [1, 0, 0, 1, 0, 1, 0, 0, 0, 0, 1, -2]
    ahead = dense(resample.warp_between(sparse(spark, volume), cells, shift), volume.shape)
    assert (ahead[:-1, :, 2:] == volume[1:, :, :-2]).all()
    back = dense(resample.warp_between(cells, sparse(spark, volume), shift, "image2atlas"), volume.shape)
    assert (back[1:, :, :-2] == volume[:-1, :, 2:]).all()
    with pytest.raises(ValueError):
        resample.warp_between(cells, cells, shift, "sideways")


def test_large_slices_are_pasted_from_tiles(spark, volume):
    rows = blocks.to_slices(sparse(spark, volume), volume.shape, tile=5).collect()
    assert len(rows) == 8 and all((np.frombuffer(r["data"], "<u2").reshape(16, 16) == volume[r["z"]]).all() for r in rows)


def test_densify_by_group(spark):
    v = spark.createDataFrame([("a", 0, 1, 1, 5), ("b", 1, 0, 2, 7)], "g string, z int, y int, x int, value int")
    got = {tuple(r)[:4]: r["value"] for r in voxels.densify(v, (2, 2, 3), "g").collect()}
    assert len(got) == 24 and got["a", 0, 1, 1] == 5 and got["b", 1, 0, 2] == 7 and sum(got.values()) == 12


def test_homomorphic_2d_gains():
    img = np.random.default_rng(1).integers(0, 500, (32, 48)).astype(float)
    assert np.allclose(filters.homomorphic(img, 10, 1.0, 1.0), img)
    flat = np.full((16, 16), 99.0)
    assert np.allclose(filters.homomorphic(flat, 5, 0.5, 2.0), 10 - 1)


def test_clahe():
    img = np.tile(np.arange(64, dtype=np.uint8), (64, 1))
    out = filters.clahe(img, 40.0, 1)
    assert out.dtype == np.uint8 and (np.diff(out[0].astype(int)) >= 0).all() and out.max() == 255
    assert filters.clahe(np.zeros((10, 11), np.uint16), 2.0, 4).shape == (10, 11)
    with pytest.raises(TypeError):
        filters.clahe(np.zeros((4, 4), np.int64))


def test_background_removal():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 99, (9, 14))
    for best, f in ((np.minimum, np.min), (np.maximum, np.max)):
        want = [[f(x[max(i - 2, 0) : i + 3, max(j - 2, 0) : j + 3]) for j in range(14)] for i in range(9)]
        assert (filters.sliding(x, 2, best) == want).all()
    img = np.full((60, 60), 500, np.uint16)
    img[30, 30] = 9000
    out = filters.remove_background(img, 8, 1.0)
    assert out.dtype == np.uint16 and out[30, 30] > 8000 and out[5, 5] == 0


def test_histogram_match_to_itself_is_identity(spark, volume):
    v = sparse(spark, volume)
    assert (dense(filters.match_histogram(v, v), volume.shape) == volume).all()


def test_heat_equals_direct_sum(spark):
    a = np.zeros((4, 12, 12), int)
    a[1, 2, 3], a[2, 9, 9], a[0, 0, 0] = 255, 255, 255
    atlas = np.ones_like(a)
    atlas[0] = 0
    got = dense(density.heat_density(sparse(spark, a), sparse(spark, atlas), a.shape, 1.5, 2.0), a.shape)
    want = np.zeros(a.shape)
    for p in ((1, 2, 3), (2, 9, 9)):
        for q in np.ndindex(*a.shape):
            d = np.abs(np.subtract(p, q))
            if d.max() <= 5:
                want[q] += 2 * 255 * np.exp(-(d**2).sum() / 4.5)
    assert np.abs(got - want).max() < 0.2


def test_resampling(spark, volume):
    v = sparse(spark, volume)
    for f in (resample.downsample_nearest, resample.downsample_linear):
        assert (dense(f(v, volume.shape, (1, 1, 1), 3), volume.shape) == volume).all()
    assert resample.slabs(7, 4, 0.1) == [(1, 4, 0, 0, 0), (1, 3, 0, 4, 0)] and resample.slabs(32, 10, 0.4) == [(3, 10, 4, 0, 0), (1, 2, 1, 30, 12)]
    assert resample.downsample_nearest(v, volume.shape, (0.05, 1, 1), 4).count() == 0 and resample.downsample_linear(v, volume.shape, (0.05, 1, 1), 4).count() == 0
    half = dense(resample.downsample_nearest(v, volume.shape, (0.5, 0.5, 0.5), None), (4, 8, 8))
    at = lambda m, n: [(2 * k * (n - 1) + m - 1) // (2 * (m - 1)) for k in range(m)]
    assert (half == volume[np.ix_(at(4, 8), at(8, 16), at(8, 16))]).all()
    lin = dense(resample.downsample_linear(v, volume.shape, (1, 0.5, 1), None), (8, 8, 16))
    p = np.arange(8) * 15 / 7
    lo = np.floor(p).astype(int)
    want = volume[:, lo] * (1 - p + lo)[None, :, None] + volume[:, np.minimum(lo + 1, 15)] * (p - lo)[None, :, None]
    assert np.allclose(lin, want)


def test_warp_and_back(spark, volume):
    v = sparse(spark, volume)
    cells = voxels.densify(v, volume.shape).select("z", "y", "x")
    shift = resample.warp_nearest(cells, v, [1, 0, 0, 1, 0, 1, 0, 0, 0, 0, 1, -2])
    got = dense(shift, volume.shape)
    assert (got[:-1, :, 2:] == volume[1:, :, :-2]).all() and not got[-1].any() and not got[:, :, :2].any()
    back = dense(resample.warp_nearest(cells, shift, [1, 0, 0, -1, 0, 1, 0, 0, 0, 0, 1, 2]), volume.shape)
    assert (back[1:, :, :-2] == volume[1:, :, :-2]).all()


def test_upsample_of_downsample_keeps_a_constant(spark):
    a = np.full((6, 8, 8), 3)
    down = resample.downsample_nearest(sparse(spark, a), a.shape, (0.5, 0.5, 0.5), None).withColumnRenamed("value", "label")
    assert (dense(resample.upsample_labels(down, (3, 4, 4), a.shape), a.shape, "label") == 3).all()


def test_region_properties(spark, volume):
    lab = np.zeros_like(volume)
    lab[1:, :, :8], lab[1:, :, 8:] = 1, 2
    tree = spark.createDataFrame([(9, "root", None, 0), (1, "a", 9, 1), (2, "b", 9, 1), (5, "empty", 1, 2), (7, "lost", 77, 1)], "region_id int, name string, parent_id int, level int")
    mask, labels = sparse(spark, volume), sparse(spark, lab, "label")
    with pytest.raises(ValueError, match="cycle"):
        regions.closure(tree.unionByName(spark.createDataFrame([(20, "loop", 21, 1), (21, "pool", 20, 1)], tree.schema)))
    with pytest.raises(ValueError, match="cycle"):
        regions.closure(spark.createDataFrame([(1, "self", 1, 0)], tree.schema))
    both = regions.region_density(mask, labels)
    rolled = {r["region_id"]: (r["total_vox"], r["signal_vox"]) for r in regions.rollup(both, tree).collect()}
    assert rolled[9] == ((lab > 0).sum(), ((lab > 0) & (volume > 0)).sum()) and rolled[5] == (0, 0) and rolled[7] == (0, 0)
    assert both.filter("signal_vox > total_vox").count() == 0
    report = regions.level_report(regions.rollup(both, tree)).filter("region_id = 5").first()
    assert report["density"] is None and report["index"] == 1
    m, k = regions.common_planes(mask, labels, 3, 8)
    assert max(r["z"] for r in k.collect()) == 2 and max(r["z"] for r in m.collect()) == 2


def test_rollup_of_a_deep_tree(spark):
    """A chain of 300 regions, voxels in the deepest alone."""
    chain = [(k, f"r{k}", k - 1 if k else None, k) for k in range(300)]
    tree = spark.createDataFrame(chain, "region_id int, name string, parent_id int, level int")
    counts = spark.createDataFrame([(299, 7, 3)], "label int, total_vox long, signal_vox long")
    assert {(r["total_vox"], r["signal_vox"]) for r in regions.rollup(counts, tree).collect()} == {(7, 3)}
    pairs = {tuple(r) for r in regions.closure(tree).collect()}
    assert pairs == {(a, b) for a in range(300) for b in range(a + 1)}
    assert regions.closure(tree.limit(0)).count() == 0


def test_ontology_from_a_file(spark, tmp_path):
    tree = {"id": 1, "name": "root", "children": [{"id": 2, "name": "a", "children": [{"id": 5, "name": "deep", "children": [{"id": 6, "name": "deeper"}]}]}, {"id": 3, "name": "b"}, {"id": 4, "name": "c", "children": []}]}
    (tmp_path / "o.json").write_text(json.dumps(tree, indent=1))
    got = sorted(map(tuple, io.scan_ontology(spark, str(tmp_path / "o.json")).collect()))
    assert got == [(1, "root", None, 0), (2, "a", 1, 1), (3, "b", 1, 1), (4, "c", 1, 1), (5, "deep", 2, 2), (6, "deeper", 5, 3)]
    (tmp_path / "one.json").write_text('{"id": 9, "name": "alone"}')
    assert [tuple(r) for r in io.scan_ontology(spark, str(tmp_path / "one.json")).collect()] == [(9, "alone", None, 0)]


def test_components_of_stars_chains_and_hubs(spark):
    """By rounds alone, and as usual: a star around its greatest and one around its least node, a chain, loops."""
    n = 3000
    star = [(10_000, k) for k in range(n)] + [(20_000, 20_001 + k) for k in range(n)]
    chain = [(40_000 + k, 40_001 + k) for k in range(700)]
    edges = spark.createDataFrame([*star, *chain, (5, 5), (60_001, 60_000), (60_000, 60_001)], "a long, b long").repartition(7)
    want = {k: 0 for k in [*range(1, n), 10_000]} | {20_001 + k: 20_000 for k in range(n)} | {40_001 + k: 40_000 for k in range(700)} | {60_001: 60_000}
    for few in (0, components.FEW):
        assert {r["node"]: r["root"] for r in components.connected_components(edges, few=few).collect()} == want
    assert components.connected_components(edges.limit(0)).count() == 0
    million = spark.range(1, 1_000_001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    found = components.connected_components(million, few=0)
    assert found.count() == 1_000_000 and found.filter("root <> 0").count() == 0


def test_roi_and_threshold_edges(spark, volume):
    v = sparse(spark, volume)
    assert voxels.zero_roi(v, (5, 2, 0, 3), 16, 16).count() == 0
    outside = dense(voxels.zero_roi(v, (90, 99, 0, 15), 16, 16), volume.shape)
    assert not outside[:, :, 15].any() and (outside[:, :, :15] == volume[:, :, :15]).all()
    with pytest.raises(ValueError):
        voxels.threshold(v, -1)
    assert voxels.mask_sum(v, False).first()["total"] == volume.sum()


def test_subtraction_reports_other_shapes(spark):
    inv = spark.createDataFrame([(0, 0, "a", 4, 4), (0, 0, "b", 5, 4), (1, 0, "c", 4, 4), (2, 0, "d", 5, 4)], "channel int, z int, name string, height int, width int")
    vox = spark.createDataFrame([(0, 0, 1, 1, 5), (1, 0, 1, 1, 9), (2, 0, 1, 1, 9), (2, 0, 2, 2, 3), (2, 3, 2, 2, 3)], "channel int, z int, y int, x int, value int")
    assert sorted(map(tuple, voxels.subtract_channel(vox, inv, 0).collect())) == [(2, 0, 1, 1, 4), (2, 0, 2, 2, 3)]
    assert [r["name"] for r in voxels.mismatched(inv, 0).collect()] == ["c"]


def test_names(spark):
    given = ["a_C3_Z0042.tif", "x_C1_C02_Z1.TIF", "old_7_Ch4.tif", "note.txt", "old_Ch4_x.tif", "c9_C5.tif"]
    df = spark.createDataFrame([(k, g) for k, g in enumerate(given)], "k int, name string")
    (c1, z1), (c2, z2) = names.parse_strict(F.col("name")), names.parse_loose(F.col("name"))
    got = df.select(c1.alias("a"), z1.alias("b"), c2.alias("c"), z2.alias("d"), names.route_channel(F.col("name")).alias("e"), "k").orderBy("k").collect()
    assert tuple(got[0])[:5] == ("C3", "0042", 3, 42, "ch3")
    assert tuple(got[1])[:5] == ("C02", "1", 1, 1, "ch2")
    assert got[2]["e"] == "ch4" and got[3]["e"] is None and got[4]["e"] is None
    assert names.select_files(df.select("k", c2.alias("c"), z2.alias("z")), channel=-1).count() == len(given)


def test_slice_lists(spark):
    s = spark.createDataFrame([(0, f"s{k:02d}", 4, 4, "<u2") for k in range(10)], "channel int, name string, height int, width int, dtype string")
    s = slices.inventory(s)
    assert [r["z"] for r in slices.even_sample(s, 0.35).orderBy("z").collect()] == [0, 4, 9]
    assert [r["z"] for r in slices.even_sample(s, 0.001).collect()] == [0]
    assert slices.middle_slice(s).first()["z"] == 5
    shape = slices.volume_shape(s)
    assert slices.shape_of(shape.filter("channel = 7"), shape).first()["nz"] == 10
    pair = spark.createDataFrame([(1, 2)], "a int, b int")
    assert slices.checked_pairs(pair, F.col("a") < F.col("b")).count() == 1
    with pytest.raises(Exception, match="shapes differ"):
        slices.checked_pairs(pair, F.col("a") == F.col("b")).collect()


def test_spots(spark):
    df = spark.createDataFrame([(5.9, 5.1), (0.0, 0.0), (5.2, 5.3)], "y double, x double")
    got = {(r["y"], r["x"]) for r in density.rasterize_spots(df, 8, 8, 2).collect()}
    assert got == {(a, b) for a in range(8) for b in range(8) for c in ((5, 5), (0, 0)) if (a - c[0]) ** 2 + (b - c[1]) ** 2 < 4}


def test_median_and_means(spark):
    d = spark.createDataFrame([(40.0,), (None,), (60.0,)], "d0 double")
    assert filters.median_d0(d).first()["d0"] == 50 and filters.median_d0(d.limit(0)).first()["d0"] == 30
    h = spark.createDataFrame([(0, 0, 0, 4.0), (0, 0, 0, 2.0), (0, 0, 1, 2.0)], "z int, y int, x int, value double")
    assert {r["x"]: r["value"] for r in density.mean_heat(h, 2).collect()} == {0: 3.0, 1: 1.0}


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in (2, 0, 1):
        (tmp_path / "in" / f"s{k}.tif").write_bytes(np.full((2, 3), k, "<u2").tobytes())
    got = io.scan_slices(spark, str(tmp_path / "in"), lambda b: np.frombuffer(b, "<u2").reshape(2, 3)).orderBy("z").collect()
    assert [(r["z"], r["name"], np.frombuffer(r["data"], "<u2")[0]) for r in got] == [(k, f"s{k}.tif", k) for k in range(3)]
    pages = io.scan_pages(spark, str(tmp_path / "in"), lambda b: np.frombuffer(b, "<u2").reshape(2, 1, 3))
    assert pages.count() == 6 and io.scan_pages(spark, str(tmp_path / "in"), lambda b: np.zeros((2, 3))).count() == 3
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        io.scan_slices(spark, str(tmp_path / "none"), lambda b: b)
    (tmp_path / "spots.csv").write_text("id,y,x\n1,2.5,3\n")
    assert tuple(io.scan_spots(spark, str(tmp_path / "spots.csv")).first()) == (2.5, 3.0)
    (tmp_path / "bad.csv").write_text("id,y\n1,2.5\n")
    with pytest.raises(ValueError, match="no column x"):
        io.scan_spots(spark, str(tmp_path / "bad.csv"))
    for text, source in (({"input": {"resolution_xyz": [1, 2, 4]}}, [1, 2, 4]), ({"source_resolution": [3, 3, 3]}, [3, 3, 3]), ({}, [1.8, 1.8, 2.0])):
        (tmp_path / "c.json").write_text(json.dumps(text))
        r = io.resolution(spark, str(tmp_path / "c.json")).first()
        assert r["source"] == source and r["target"] == [25, 25, 25]
    report = spark.createDataFrame([(0, 1, "a"), (2, 1, "b")], "level int, index int, name string")
    io.write_report(report, str(tmp_path / "report"))
    assert sorted(p.name for p in (tmp_path / "report").glob("level=*")) == ["level=0", "level=2"]
    for _ in range(2):
        io.append_record(report, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
    vox = spark.createDataFrame([(0, 0, 0, 65537)], "z int, y int, x int, value int")
    assert tuple(io.uint16_slices(vox, "reg").select("value", "name").first()) == (1, "reg_0000")
    parsed = spark.createDataFrame([("1,2,3",), ("1,b,3",), ("7",)], "t string").select(io.parse_triple(F.col("t"), (9, 9, 9)).alias("p")).collect()
    assert [r["p"] for r in parsed] == [[1, 2, 3], [9, 9, 9], [9, 9, 9]]


def test_streams(spark, tmp_path):
    image = spark.createDataFrame([(0, z, f"s{z}", 2, 2, "<u2", bytearray(np.full((2, 2), z, "<u2").tobytes())) for z in range(3)], streaming.IMAGE_SCHEMA)
    image.filter("z < 2").write.parquet(str(tmp_path / "in"))
    run = lambda: streaming.enhance_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), lambda a, z: a + 1)
    run()
    image.filter("z = 2").write.mode("append").parquet(str(tmp_path / "in"))
    run()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["z"], np.frombuffer(r["data"], "<f8")[0]) for r in got) == [(0, 1), (1, 2), (2, 3)]


def test_region_totals_of_bricks_sent_again(spark, tmp_path):
    """Bricks that come twice, in a newer or an older version or changed under one version, in any order."""
    rng = np.random.default_rng(6)
    label = rng.integers(0, 4, (4, 6, 6))
    cut = lambda a, t: blocks.to_bricks(sparse(spark, a), a.shape, (2, 3, 3), t)
    labels = cut(label, "<i4")
    brick = lambda z, y, x, v, cells: (z, y, x, 2 * z, 3 * y, 3 * x, 2, 3, 3, "<u2", bytearray(np.asarray(cells, "<u2").tobytes()), v)
    cells = {k: rng.integers(0, 2, (2, 3, 3)) for k in ((z, y, x, v) for z in range(2) for y in range(2) for x in range(2) for v in range(3))}
    sent = [brick(*k, c) for k, c in cells.items()] * 2 + [brick(0, 0, 0, 5, np.ones((2, 3, 3))), brick(1, 1, 1, 2, np.zeros((2, 3, 3)))]
    sent.append((0, 1, 1, 0, 3, 3, 0, 0, 0, "<u2", bytearray(), 9))
    totals = []
    for k, order in enumerate((sent, sent[::-1])):
        for n, part in enumerate((order[:17], order[17:])):  # the second call goes on where the first one stopped
            spark.createDataFrame(part, streaming.SENT).repartition(5).write.mode("append").parquet(str(tmp_path / f"in{k}"))
            got = streaming.drain_region_totals(spark, str(tmp_path / f"in{k}"), labels, str(tmp_path / f"out{k}"), str(tmp_path / f"ck{k}"), 3)
        totals.append(sorted(map(tuple, got.collect())))
    assert totals[0] == totals[1]
    got = {x: (t, s) for x, t, s in totals[0]}
    lit = np.zeros(label.shape, bool)
    for (z, y, x, v), c in cells.items():
        if v == 2:
            lit[2 * z : 2 * z + 2, 3 * y : 3 * y + 3, 3 * x : 3 * x + 3] = c > 0
    lit[:2, :3, :3], lit[:2, 3:, 3:] = True, False
    unsure = np.zeros(label.shape, bool)
    unsure[2:, 3:, 3:] = True  # of two sendings of one version either counts, but always the same one
    for x in range(1, 4):
        t, s = got[x]
        sure = (lit & ~unsure & (label == x)).sum()
        assert t == (label == x).sum() and s in (sure, sure + (lit & unsure & (label == x)).sum())


def test_kernels_do_not_depend_on_how_bricks_are_cut(spark, volume):
    v = sparse(spark, volume)
    w = [int(x * density.SCALE + 0.5) for x in filters.gaussian_1d(1.0)]
    for slab, whole in ((None, False), (4, False), (4, True), (3, True)):
        got = {c: dense(density.gaussian_smooth(v, volume.shape, 1.0, slab, whole, c), volume.shape) for c in ((8, 16, 16), (3, 5, 7), (2, 2, 3))}
        want = volume.astype(np.int64)
        for k in range(3):
            for lo in range(0, 8, slab) if k == 0 and slab else (0,):
                part = (slice(lo, lo + slab if k == 0 and slab else None),)
                x = (filters.convolve(want[part].astype(float), np.array(w, float), k, (True, True)) + 1e-6).astype(np.int64)
                want[part] = x // density.SCALE if whole else x
        for x in got.values():
            assert (x == (want if whole else want / float(density.SCALE) ** 3)).all()
    heat = [dense(density.heat_density(v, v, volume.shape, 1.5, 2.0, c), volume.shape) for c in ((8, 16, 16), (3, 5, 7), (2, 3, 2))]
    assert (heat[0] == heat[1]).all() and (heat[0] == heat[2]).all()


def test_halo_slabs_are_binary_and_bounded(spark):
    """Bytes sent: the bricks and their halos, no more; empty bricks are neither sent nor made."""
    a = np.zeros((64, 64, 64), int)
    a[:32] = np.random.default_rng(5).integers(1, 9, (32, 64, 64))
    bricks = blocks.to_bricks(sparse(spark, a), a.shape, (32, 32, 32), "<i4").cache()
    own = sum(len(r["data"]) for r in bricks.collect())
    sent = [(r["bz"], len(r["data"])) for r in kernels.halo_slabs(bricks, a.shape, (32, 32, 32), (2, 2, 2)).collect()]
    assert sum(n for b, n in sent if b == 0) == 4 * 32 * 34 * 34 * 4 and sum(n for _, n in sent) < 1.3 * own
    made = kernels.with_halo(bricks, a.shape, (32, 32, 32), (2, 2, 2), lambda c: c[2:-2, 2:-2, 2:-2].copy())
    assert {r["bz"] for r in made.collect()} == {0} and (dense(kernels.cell_rows(made), a.shape) == a).all()
    recut = kernels.with_halo(bricks, a.shape, (20, 64, 7), (0, 0, 0), lambda c: c)
    assert (dense(kernels.cell_rows(recut), a.shape) == a).all()
    assert kernels.with_halo(bricks.limit(0), a.shape, (32, 32, 32), (1, 1, 1), lambda c: c).count() == 0


def test_sums_that_leave_64_bits_raise():
    with pytest.raises(OverflowError):
        kernels.line_sums(np.full((3, 3, 3), 1 << 30), [10_000] * 3)
