"""Models over sliding windows: overlapping predictions of a volume of any size, blended by weight.

Windows of one size start every ``step`` cells; the last one of an axis ends with the volume, so every window is whole.
A brick sends each window the slab that the two share; a task holds one batch of windows. Predictions leave a window as
slabs on a grid of ``step`` cells, in the model's own type; weights are applied where they meet. Both shuffles are about
the product of window / step over the axes times the bytes of the bricks and of the predictions.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

import numpy as np
from pyspark.sql import DataFrame

from ..storage import in_frames
from .blocks import B_KEY, BRICK
from .kernels import FIELDS, Triple, _frame, _groups, brick_row, cells_of

_FROM = ["wz", "wy", "wx"]


def starts(n: int, window: int, step: int) -> list[int]:
    """Where the windows of an axis of n cells begin; the last one is moved back so that it ends with the axis."""
    if not 0 < step <= window:
        raise ValueError("windows must overlap or touch")
    last = max(n - window, 0)
    return [min(k * step, last) for k in range(-(-last // step) + 1)]


def ramp(window: int) -> np.ndarray:
    """Whole weights of a window's cells along an axis: 1 at both ends, greatest in the middle."""
    at = np.arange(window)
    return np.minimum(at + 1, window - at)


def weight_sums(n: int, window: int, step: int) -> np.ndarray:
    """The weights that all windows of an axis of n cells together give to each cell."""
    out, ends = np.zeros(n, np.int64), ramp(window)
    for s in starts(n, window, step):
        out[s : s + window] += ends[: n - s]
    return out


def predict_windows(bricks: DataFrame, shape: Triple, window: Triple, step: Triple, load: Callable, batch: int = 8, dtype: str = "<f8") -> DataFrame:
    """Bricks of ``step`` cells with the weighted mean of a model's predictions over all windows that hold a cell.

    load() gives the model once for a partition; model(array of [batch, z, y, x]) -> the same shape. Bricks may be cut in
    any way, but must have one type. Beyond a volume smaller than the window the cells are 0. A window whose cells are
    all 0 is not shown to the model and counts as a prediction of 0. Means of whole predictions are exact below 2^53;
    a whole ``dtype`` rounds down. Bricks that stay all 0 are not made; no bricks give none.
    """
    begin = [starts(n, w, s) for n, w, s in zip(shape, window, step, strict=True)]

    def send(parts):
        for pdf in parts:
            for r in pdf.itertuples(index=False):
                cells, low = cells_of(r), (r.z0, r.y0, r.x0)
                if not cells.any():
                    continue
                to = []
                for at, o, d, w in zip(begin, low, cells.shape, window, strict=True):
                    to.append(range(int(np.searchsorted(at, o - w, "right")), int(np.searchsorted(at, o + d))))
                rows = []
                for b in product(*to):
                    first = [at[k] for at, k in zip(begin, b, strict=True)]
                    from_ = [max(o, s) for o, s in zip(low, first, strict=True)]
                    part = cells[tuple(slice(f - o, s + w - o) for f, o, s, w in zip(from_, low, first, window, strict=True))]
                    if part.any():
                        rows.append(brick_row(b, from_, part))
                if rows:
                    yield _frame(rows)

    def predict(parts):
        import pandas as pd

        model, held = None, []

        def out():
            rows = []
            for first, cells in zip([h[0] for h in held], model(np.stack([h[1] for h in held])), strict=True):
                end = [min(s + w, n) for s, w, n in zip(first, window, shape, strict=True)]
                for b in product(*[range(s // t, (e - 1) // t + 1) for s, e, t in zip(first, end, step, strict=True)]):
                    low = [max(s, k * t) for s, k, t in zip(first, b, step, strict=True)]
                    part = cells[tuple(slice(o - s, min(e, k * t + t) - s) for o, s, e, k, t in zip(low, first, end, b, step, strict=True))]
                    if part.any():
                        rows.append((*brick_row(b, low, part), *first))
            return pd.DataFrame(rows, columns=FIELDS + _FROM)

        for b, rows in _groups(parts, B_KEY):
            model = load() if model is None else model
            first = [at[k] for at, k in zip(begin, b, strict=True)]
            cells = np.zeros(window, rows[0].dtype)
            for r in rows:
                cells[tuple(slice(o - s, o - s + d) for o, s, d in zip((r.z0, r.y0, r.x0), first, (r.dz, r.dy, r.dx), strict=True))] = cells_of(r)
            held.append((first, cells))
            if len(held) == batch:
                yield out()
                held = []
        if held:
            yield out()

    def blend(parts):
        ramps = [ramp(w) for w in window]
        sums = [weight_sums(n, w, s) for n, w, s in zip(shape, window, step, strict=True)]
        for b, rows in _groups(parts, B_KEY):
            own = [k * t for k, t in zip(b, step, strict=True)]
            end = [min(o + t, n) for o, t, n in zip(own, step, shape, strict=True)]
            total = np.zeros([e - o for o, e in zip(own, end, strict=True)])
            for r in rows:
                low, size = (r.z0, r.y0, r.x0), (r.dz, r.dy, r.dx)
                z, y, x = (w[o - s : o - s + d] for w, o, s, d in zip(ramps, low, (r.wz, r.wy, r.wx), size, strict=True))
                total[tuple(slice(o - a, o - a + d) for o, a, d in zip(low, own, size, strict=True))] += cells_of(r) * (z[:, None, None] * y[:, None] * x)
            z, y, x = (s[o:e] for s, o, e in zip(sums, own, end, strict=True))
            whole = z[:, None, None] * y[:, None] * x
            out = (np.floor_divide(total, whole) if np.dtype(dtype).kind in "iu" else total / whole).astype(dtype)
            if out.any():
                yield _frame([brick_row(b, own, out)])

    by_window = bricks.select(FIELDS).transform(in_frames, send, BRICK).repartition(*B_KEY).sortWithinPartitions(*B_KEY)
    slabs = by_window.transform(in_frames, predict, BRICK + "".join(f", {c} int" for c in _FROM))
    # in order of the windows, so that sums of fractions come out alike each time
    return slabs.repartition(*B_KEY).sortWithinPartitions(*B_KEY, *_FROM).transform(in_frames, blend, BRICK)
