"""Kernels on dense bricks: what a neighbour needs travels as binary slabs, whole lines of an axis as cubes.

No voxel is ever a row here. A brick sends each brick within reach of it the slab of its cells that lies in that
one's halo, and the kernel runs on a brick with its halo; slabs that are all 0 are not sent, and bricks that stay all
0 are not made. With a reach of r cells and bricks of n the shuffle is about the product of (1 + 2 r / n) over the
axes times the bricks' own bytes. Kernels that reach across many bricks go along whole lines instead, one axis at a
time, each cell sent once a pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import in_frames
from .blocks import B_KEY, BRICK
from .voxels import KEY

FIELDS = [f.split()[0] for f in BRICK.split(", ")]
Triple = tuple[int, int, int]


def cells_of(row) -> np.ndarray:
    """The cells of a brick's row."""
    return np.frombuffer(row.data, row.dtype).reshape(row.dz, row.dy, row.dx)


def brick_row(brick: Iterable[int], low: Iterable[int], cells: np.ndarray) -> tuple:
    return (*map(int, brick), *map(int, low), *cells.shape, cells.dtype.str, np.ascontiguousarray(cells).tobytes())


def _frame(rows: list[tuple]):
    import pandas as pd

    return pd.DataFrame(rows, columns=FIELDS)


def _groups(parts: Iterable, key: list[str]) -> Iterator[tuple[tuple, list]]:
    """(key, rows) of each group over frames that are sorted by key; one group's rows are held at a time."""
    now, held = None, []
    for pdf in parts:
        for r in pdf.itertuples(index=False):
            k = tuple(getattr(r, c) for c in key)
            if k != now and held:
                yield now, held
                held = []
            now = k
            held.append(r)
    if held:
        yield now, held


def halo_slabs(bricks: DataFrame, shape: Triple, chunk: Triple, reach: Triple) -> DataFrame:
    """The pieces of bricks, however they are cut, by the bricks of ``chunk`` whose cells or halo they lie in."""

    def send(parts):
        for pdf in parts:
            for r in pdf.itertuples(index=False):
                cells, low = cells_of(r), (r.z0, r.y0, r.x0)
                if not cells.any():
                    continue
                to = [range(max(0, (o - h) // c), min(n - 1, o + d - 1 + h) // c + 1) for o, d, h, c, n in zip(low, cells.shape, reach, chunk, shape, strict=True)]
                rows = []
                for b in product(*to):
                    begin = [max(o, k * c - h) for o, k, c, h in zip(low, b, chunk, reach, strict=True)]
                    end = [min(o + d, k * c + c + h) for o, d, k, c, h in zip(low, cells.shape, b, chunk, reach, strict=True)]
                    part = cells[tuple(slice(s - o, e - o) for s, e, o in zip(begin, end, low, strict=True))]
                    if part.any():
                        rows.append(brick_row(b, begin, part))
                if rows:
                    yield _frame(rows)

    return bricks.select(FIELDS).transform(in_frames, send, BRICK)


def with_halo(bricks: DataFrame, shape: Triple, chunk: Triple, reach: Triple, fn: Callable[..., np.ndarray], border: str | None = "constant", apart: bool = False) -> DataFrame:
    """Bricks of fn(cells of a brick and ``reach`` more on each side) -> its own cells.

    Beyond the volume is 0 (border ``constant``) or its mirror image d c b a | a b c d (``symmetric``); with border None
    the cells end there, and fn also gets the part of them that is the brick's own. apart: bricks are
    slabs that do not see the planes of those above and below; there the border rule holds too.
    """
    sent = (0, *reach[1:]) if apart else reach
    slabs = halo_slabs(bricks, shape, chunk, sent)

    def run(parts):
        for b, rows in _groups(parts, B_KEY):
            own = [k * c for k, c in zip(b, chunk, strict=True)]
            end = [min(o + c, n) for o, c, n in zip(own, chunk, shape, strict=True)]
            low = [max(o - h, 0) for o, h in zip(own, sent, strict=True)]
            high = [min(e + h, n) for e, h, n in zip(end, sent, shape, strict=True)]
            cells = np.zeros([e - s for s, e in zip(low, high, strict=True)], rows[0].dtype)
            for r in rows:
                cells[tuple(slice(s - o, s - o + d) for s, o, d in zip((r.z0, r.y0, r.x0), low, (r.dz, r.dy, r.dx), strict=True))] = cells_of(r)
            pad = [(h - (o - s), h - (t - e)) for h, o, s, t, e in zip(reach, own, low, high, end, strict=True)]
            at = tuple(slice(o - s, e - s) for o, e, s in zip(own, end, low, strict=True))
            out = fn(np.pad(cells, pad, border)) if border else fn(cells, at)
            if out.any():
                yield _frame([brick_row(b, own, out)])

    return slabs.repartition(*B_KEY).sortWithinPartitions(*B_KEY).transform(in_frames, run, BRICK)


def halo_at(bricks: DataFrame, where: DataFrame, shape: Triple, chunk: Triple, reach: Triple, fn: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> DataFrame:
    """(z, y, x, value) of with_halo's cells that are not 0, at the cells where the bricks of where, cut by ``chunk``, are not 0.

    Only the slabs and the bricks of where travel; what fn makes of a brick ends in the task that makes it.
    """
    own = where.select(FIELDS).withColumn("own", F.lit(True))
    slabs = halo_slabs(bricks, shape, chunk, reach).withColumn("own", F.lit(False)).unionByName(own)

    def run(parts):
        import pandas as pd

        for b, rows in _groups(parts, B_KEY):
            at = [r for r in rows if r.own]
            rows = [r for r in rows if not r.own]
            if not at or not rows:
                continue
            low = [k * c - h for k, c, h in zip(b, chunk, reach, strict=True)]
            end = [min(k * c + c, n) + h for k, c, n, h in zip(b, chunk, shape, reach, strict=True)]
            cells = np.zeros([e - s for s, e in zip(low, end, strict=True)], rows[0].dtype)
            for r in rows:
                cells[tuple(slice(s - o, s - o + d) for s, o, d in zip((r.z0, r.y0, r.x0), low, (r.dz, r.dy, r.dx), strict=True))] = cells_of(r)
            out = fn(cells)
            place = np.nonzero((out != 0) & (cells_of(at[0]) != 0))
            yield pd.DataFrame({c: (a + k * n).astype("int32") for c, a, k, n in zip(KEY, place, b, chunk, strict=True)} | {"value": out[place]})

    return slabs.repartition(*B_KEY).sortWithinPartitions(*B_KEY).transform(in_frames, run, f"z int, y int, x int, value {kind}")


def line_sums(cells: np.ndarray, weights: list[int], whole: int | None = None) -> np.ndarray:
    """Exact weighted sums along each axis in turn, one cell less for each weight but one; whole: divides each pass.

    A pass is a product with a banded matrix in doubles while all sums stay below 2^53 (values share a factor that is
    taken out first), else sums of shifted 64-bit cells. Sums beyond 64 bits raise.
    """
    total = sum(map(abs, weights))
    unit = 1 if whole else int(np.gcd.reduce(np.unique(cells), dtype=np.int64)) or 1
    out, top = cells.astype(np.int64) // unit, int(np.abs(cells).max(initial=0)) // unit
    if top * unit * total ** (1 if whole else 3) >= 1 << 63:
        raise OverflowError("weighted sums leave 64 bits")
    for axis in range(3):
        n = out.shape[axis] - len(weights) + 1
        top *= total
        if top < 1 << 53:
            band = np.zeros((n + len(weights) - 1, n))
            for k, w in enumerate(weights):
                band[np.arange(n) + k, np.arange(n)] = w
            out = np.moveaxis(np.moveaxis(out, axis, 2).astype(float) @ band, 2, axis)
            out = np.floor(out / whole) if whole else out
        else:
            part = lambda k, a=axis, n=n: tuple(slice(k, k + n) if x == a else slice(None) for x in range(3))
            exact = out.astype(np.int64)
            out = sum((exact[part(k)] * w for k, w in enumerate(weights) if w), np.zeros_like(exact[part(0)]))
            out = out // whole if whole else out
        top = -(-top // whole) if whole else top
    return out.astype(np.int64) * unit


def cell_rows(bricks: DataFrame, kind: str = "long") -> DataFrame:
    """(z, y, x, value) of the cells that are not 0, as ``kind``."""

    def unpack(parts):
        import pandas as pd

        for pdf in parts:
            for r in pdf.itertuples(index=False):
                cells = cells_of(r)
                at = np.nonzero(cells)
                yield pd.DataFrame({c: (a + o).astype("int32") for c, a, o in zip(KEY, at, (r.z0, r.y0, r.x0), strict=True)} | {"value": cells[at]})

    return bricks.select(FIELDS).transform(in_frames, unpack, f"z int, y int, x int, value {kind}")


def cells_where(bricks: DataFrame, where: DataFrame, kind: str = "long") -> DataFrame:
    """(z, y, x, value) at the cells where the bricks of where, cut alike, are not 0; other cells never become rows."""
    met = bricks.select(FIELDS).join(where.select(*B_KEY, F.col("dtype").alias("w_dtype"), F.col("data").alias("w_data")), B_KEY)

    def unpack(parts):
        import pandas as pd

        for pdf in parts:
            for r in pdf.itertuples(index=False):
                cells = cells_of(r)
                at = np.nonzero(np.frombuffer(r.w_data, r.w_dtype).reshape(cells.shape))
                yield pd.DataFrame({c: (a + o).astype("int32") for c, a, o in zip(KEY, at, (r.z0, r.y0, r.x0), strict=True)} | {"value": cells[at]})

    return met.transform(in_frames, unpack, f"z int, y int, x int, value {kind}")


def plane_sums(bricks: DataFrame) -> DataFrame:
    """(z, n, total): cells that are not 0 and their sum, by plane; summed in the brick first."""

    def sums(parts):
        import pandas as pd

        for pdf in parts:
            for r in pdf.itertuples(index=False):
                cells = cells_of(r)
                yield pd.DataFrame({"z": np.arange(r.z0, r.z0 + r.dz), "n": (cells != 0).sum(axis=(1, 2)), "total": cells.sum(axis=(1, 2), dtype=float)})

    rows = bricks.select(FIELDS).transform(in_frames, sums, "z int, n long, total double")
    return rows.groupBy("z").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).filter("n > 0")


def map_cells(bricks: DataFrame, fn: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """bricks with fn(cells) for their cells, of any type."""

    def run(parts):
        for pdf in parts:
            out = [fn(cells_of(r)) for r in pdf.itertuples(index=False)]
            yield pdf.assign(dtype=[o.dtype.str for o in out], data=[np.ascontiguousarray(o).tobytes() for o in out])

    return bricks.select(FIELDS).transform(in_frames, run, BRICK)


def along_lines(cubes: DataFrame, axis: str, shape: Triple, tile: int, fn: Callable[[np.ndarray, int], np.ndarray]) -> DataFrame:
    """cubes of ``tile`` cells after fn(whole lines of an axis, its number) -> as many cells; a bundle of lines is a task's."""
    k = KEY.index(axis)
    across = [b for b, c in zip(B_KEY, KEY, strict=True) if c != axis]

    def run(parts):
        for _, rows in _groups(parts, across):
            first = rows[0]
            size = [n if c == axis else d for c, n, d in zip(KEY, shape, (first.dz, first.dy, first.dx), strict=True)]
            cells = np.zeros(size, first.dtype)
            for r in rows:
                o = (r.z0, r.y0, r.x0)[k]
                cells[tuple(slice(o, o + d) if x == k else slice(None) for x, d in enumerate((r.dz, r.dy, r.dx)))] = cells_of(r)
            out = fn(cells, k)
            low, b = [first.z0, first.y0, first.x0], [first.bz, first.by, first.bx]
            for j, o in enumerate(range(0, shape[k], tile)):
                part = out[tuple(slice(o, o + tile) if x == k else slice(None) for x in range(3))]
                if part.any():
                    low[k], b[k] = o, j
                    yield _frame([brick_row(b, low, part)])

    return cubes.select(FIELDS).repartition(*across).sortWithinPartitions(*across).transform(in_frames, run, BRICK)


def paired(a: DataFrame, b: DataFrame, fn: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Bricks of fn(cells of a, cells of b) where either has one; both are cut alike, an absent brick is all 0."""
    of = lambda df, p: df.select(*B_KEY, F.struct(*[c for c in FIELDS if c not in B_KEY]).alias(p))
    met = of(a, "l").join(of(b, "r"), B_KEY, "full").select(*B_KEY, *[F.col(f"{p}.{c}").alias(f"{p}_{c}") for p in "lr" for c in FIELDS if c not in B_KEY])

    def run(parts):
        for pdf in parts:
            for r in pdf.to_dict("records"):
                sides = []
                for p in "lr":
                    sides.append(None if r[f"{p}_data"] is None else np.frombuffer(r[f"{p}_data"], r[f"{p}_dtype"]).reshape(*[int(r[f"{p}_{c}"]) for c in ("dz", "dy", "dx")]))
                p = "l" if sides[0] is not None else "r"
                x, y = (np.zeros(sides[1 if s is sides[0] else 0].shape) if s is None else s for s in sides)
                yield _frame([brick_row([r[c] for c in B_KEY], [r[f"{p}_{c}"] for c in ("z0", "y0", "x0")], fn(x, y))])

    return met.transform(in_frames, run, BRICK)
