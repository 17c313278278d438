"""The homomorphic filter on slices that no task could hold: a row-column transform over bundles.

A slice is a set of bundles of whole rows. Rows are transformed bundle by bundle; the half spectra are cut into tiles
of a few columns, and a shuffle brings the tiles of the same columns together; whole columns are transformed, weighed
by the gain and transformed back, and a second shuffle brings the rows together again. A task holds one bundle of
rows or of columns, never a slice. Slices of which a task can hold many (WHOLE) need none of that: their bundles meet in
one task once, as the numbers they are, and no spectrum travels.

bundle rows: z, height, width (of the slice), r0 (first row), dtype, data (whole rows).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import in_frames
from .filters import CUTOFF, cutoff_of, d0_of, homomorphic, spectrum_rows
from .kernels import _groups

BUNDLE = "z int, height int, width int, r0 int, dtype string, data binary"
NAMES = [f.split()[0] for f in BUNDLE.split(", ")]
#: A piece of a spectrum: rows from r0 and columns from c0, complex.
TILE = "z int, height int, width int, r0 int, c0 int, data binary"


#: Bytes of a slice's spectrum up to which a task takes the slice as a whole.
WHOLE = 1 << 24


def _by_size(bundles: DataFrame, whole: int) -> tuple[DataFrame, DataFrame]:
    """Bundles of the slices that a task takes as a whole, all of a slice together, and those of the others."""
    small = F.col("height").cast("long") * F.col("width") * 16 <= whole
    rows = bundles.select(NAMES)
    return rows.filter(small).repartition("z").sortWithinPartitions("z", "r0"), rows.filter(~small)


def _image(rows: list) -> np.ndarray:
    return np.concatenate([_cells(r) for r in rows])


def _frame(rows: list[tuple], schema: str):
    import pandas as pd

    return pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])


def _cells(r) -> np.ndarray:
    return np.frombuffer(r.data, r.dtype).reshape(-1, r.width)


def to_bundles(slices: DataFrame, rows: int = 64) -> DataFrame:
    """Slice images (z, height, width, dtype, data) cut into bundles of ``rows`` rows; the last one may have fewer."""
    size = F.when(F.col("height") > 0, F.length("data") / F.col("height")).otherwise(0).cast("long")
    r0 = F.explode(F.sequence(F.lit(0), F.greatest(F.col("height") - 1, F.lit(0)), F.lit(rows)))
    cut = slices.filter("height > 0").select("z", "height", "width", "dtype", "data", size.alias("_row"), r0.alias("r0"))
    part = F.expr(f"substring(data, cast(r0 * _row + 1 as int), cast({rows} * _row as int))")
    return cut.select("z", "height", "width", "r0", "dtype", part.alias("data"))


def from_bundles(bundles: DataFrame) -> DataFrame:
    """Slice images from their bundles, for slices that fit into one row."""
    parts = F.array_sort(F.collect_list(F.struct("r0", "data")))
    whole = bundles.groupBy("z", "height", "width", "dtype").agg(parts.alias("p"))

    def join(frames):
        for pdf in frames:
            yield pdf.drop(columns="p").assign(data=[b"".join(x["data"] for x in p) for p in pdf["p"]])

    return whole.transform(in_frames, join, "z int, height int, width int, dtype string, data binary")


def homomorphic_bundles(bundles: DataFrame, d0: float, rl: float = 0.5, rh: float = 2.0, c: float = 1.0, columns: int = 64, whole: int = WHOLE) -> DataFrame:
    """Bundles (doubles) of exp of the log slice filtered with gain rl at rest and rh far out, minus 1.

    The same numbers as the whole transform gives, to rounding, however rows are bundled.
    """

    def ahead(frames):
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                half = np.fft.rfft(np.log1p(_cells(r).astype(float)), axis=1)
                yield _frame([(r.z, r.height, r.width, r.r0, k, np.ascontiguousarray(half[:, k : k + columns]).tobytes()) for k in range(0, half.shape[1], columns)], TILE)

    def across(frames):
        for _, rows in _groups(frames, ["z", "c0"]):
            rows.sort(key=lambda r: r.r0)
            first = rows[0]
            n = min(columns, first.width // 2 + 1 - first.c0)
            cells = np.concatenate([np.frombuffer(r.data, complex).reshape(-1, n) for r in rows])
            y, x = np.arange(first.height), np.arange(first.c0, first.c0 + n)
            d2 = np.minimum(y, first.height - y)[:, None] ** 2 + x[None, :] ** 2
            gain = (rh - rl) * (1 - np.exp(-c * d2 / d0**2)) + rl
            back = np.fft.ifft(np.fft.fft(cells, axis=0) * gain, axis=0)
            ends = [r.r0 for r in rows[1:]] + [first.height]
            yield _frame([(r.z, r.height, r.width, r.r0, r.c0, np.ascontiguousarray(back[r.r0 : e]).tobytes()) for r, e in zip(rows, ends, strict=True)], TILE)

    def home(frames):
        for _, rows in _groups(frames, ["z", "r0"]):
            rows.sort(key=lambda r: r.c0)
            first = rows[0]
            ends = [r.c0 for r in rows[1:]] + [first.width // 2 + 1]
            half = np.concatenate([np.frombuffer(r.data, complex).reshape(-1, e - r.c0) for r, e in zip(rows, ends, strict=True)], axis=1)
            out = np.exp(np.fft.irfft(half, first.width, axis=1)) - 1
            yield _frame([(first.z, first.height, first.width, first.r0, "<f8", out.astype("<f8").tobytes())], BUNDLE)

    def at_once(frames):
        for _, rows in _groups(frames, ["z"]):
            out = homomorphic(_image(rows), d0, rl, rh, c).astype("<f8")
            ends = [r.r0 for r in rows[1:]] + [len(out)]
            yield _frame([(r.z, r.height, r.width, r.r0, "<f8", out[r.r0 : e].tobytes()) for r, e in zip(rows, ends, strict=True)], BUNDLE)

    small, large = _by_size(bundles, whole)
    met = large.transform(in_frames, ahead, TILE)
    for key, fn, schema in ((["z", "c0"], across, TILE), (["z", "r0"], home, BUNDLE)):
        met = met.repartition(*key).sortWithinPartitions(*key).transform(in_frames, fn, schema)
    return small.transform(in_frames, at_once, BUNDLE).unionByName(met)


def _resized(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sources and share of the later one of m targets on n cells, pixel centres aligned, borders clamped."""
    p = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
    low = np.floor(p).astype(int)
    return low, np.minimum(low + 1, n - 1), p - low


def adaptive_d0_bundles(bundles: DataFrame, share: float = 0.98, side: int = 256, whole: int = WHOLE) -> DataFrame:
    """(z, d0) of slices in bundles. A bundle of a slice that no task takes as a whole hands on its share of the side x side image that the spectrum is taken of."""
    part_schema = "z int, height int, width int, i int, data binary"

    def shrink(frames):
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                img = _cells(r).astype(float)
                y0, y1, fy = _resized(r.height, side)
                x0, x1, fx = _resized(r.width, side)
                rows: dict[int, np.ndarray] = {}
                for at, w in ((y0, 1 - fy), (y1, fy)):
                    for i in np.flatnonzero((at >= r.r0) & (at < r.r0 + len(img))):
                        line = img[at[i] - r.r0]
                        rows[i] = rows.get(i, 0) + w[i] * (line[x0] * (1 - fx) + line[x1] * fx)
                yield _frame([(r.z, r.height, r.width, int(i), v.tobytes()) for i, v in rows.items()], part_schema)

    def spectra(frames):
        for _, rows in _groups(frames, ["z"]):
            img = np.zeros((side, side))
            for r in rows:
                img[r.i] += np.frombuffer(r.data)
            power = np.abs(np.fft.fft2(np.log1p(img))) ** 2
            k = np.minimum(np.arange(side), side - np.arange(side))
            r2, at = np.unique((k[:, None] ** 2 + k[None, :] ** 2).ravel(), return_inverse=True)
            first = rows[0]
            yield _frame([(first.z, first.height, first.width, cutoff_of(r2, np.bincount(at, power.ravel()), share))], CUTOFF)

    def at_once(frames):
        for _, rows in _groups(frames, ["z"]):
            first = rows[0]
            yield _frame([(first.z, first.height, first.width, cutoff_of(*spectrum_rows(_image(rows), side), share))], CUTOFF)

    small, large = _by_size(bundles, whole)
    parts = large.transform(in_frames, shrink, part_schema).repartition("z").sortWithinPartitions("z")
    return d0_of(parts.transform(in_frames, spectra, CUTOFF).unionByName(small.transform(in_frames, at_once, CUTOFF)), side)
