"""Bricks: re-chunking, halo exchange and functions over slices and blocks.

brick rows: bz, by, bx, z0, y0, x0, dz, dy, dx, dtype, data (row-major, little endian); edge bricks are ragged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import in_frames
from .voxels import KEY

BRICK = "bz int, by int, bx int, z0 int, y0 int, x0 int, dz int, dy int, dx int, dtype string, data binary"
B_KEY = ["bz", "by", "bx"]
#: Bytes of finished bricks that go on together.
_HELD = 1 << 23


def brick_of(chunk: tuple[int, int, int]) -> list:
    return [F.floor(F.col(c) / n).cast("int").alias(b) for c, n, b in zip(KEY, chunk, B_KEY, strict=True)]


def brick_counts(vox: DataFrame, chunk: tuple[int, int, int]) -> DataFrame:
    """Occupied voxels and their sum by brick."""
    return vox.select(*brick_of(chunk), "value").groupBy(*B_KEY).agg(F.count("*").alias("n"), F.sum(F.col("value").cast("long")).alias("total"))


def to_bricks(vox: DataFrame, shape: tuple[int, int, int], chunk: tuple[int, int, int] = (128, 256, 256), dtype: str = "<u2") -> DataFrame:
    """Dense bricks of the occupied parts of a volume.

    Voxels come sorted by brick and are written into it as they come, so a task holds one brick's cells and one batch of
    rows, however many voxels a brick has and however many bricks a batch.
    """
    fields = [f.split()[0] for f in BRICK.split(", ")]

    def pack(parts):
        import numpy as np
        import pandas as pd

        now, low, cells, done, held = None, None, None, [], 0

        def row():
            return (*now, *low, *cells.shape, dtype, cells.tobytes())

        for pdf in parts:
            at, value = pdf[KEY].to_numpy(), pdf["value"].to_numpy()
            brick = at // chunk
            cut = np.flatnonzero((brick[1:] != brick[:-1]).any(axis=1)) + 1
            for s, e in zip(np.r_[0, cut], np.r_[cut, len(brick)], strict=True):
                if s == e:
                    continue
                if (b := tuple(brick[s])) != now:
                    if now is not None:
                        done.append(row())
                        held += cells.nbytes
                    now, low = b, brick[s] * np.array(chunk)
                    cells = np.zeros(np.minimum(low + chunk, shape) - low, dtype)
                    if held > _HELD:
                        yield pd.DataFrame(done, columns=fields)
                        done, held = [], 0
                cells[tuple((at[s:e] - low).T)] = value[s:e]
        if now is not None:
            yield pd.DataFrame([*done, row()], columns=fields)

    at = brick_of(chunk)
    return vox.select(*KEY, "value").repartition(*at).sortWithinPartitions(*at).transform(in_frames, pack, BRICK)


def from_bricks(bricks: DataFrame) -> DataFrame:
    """(z, y, x, value) of the voxels that are not 0."""

    def unpack(parts):
        import numpy as np
        import pandas as pd

        for pdf in parts:
            for r in pdf.itertuples(index=False):
                cells = np.frombuffer(r.data, r.dtype).reshape(r.dz, r.dy, r.dx)
                at = np.nonzero(cells)
                yield pd.DataFrame({c: (a + o).astype("int32") for c, a, o in zip(KEY, at, (r.z0, r.y0, r.x0), strict=True)} | {"value": cells[at].astype("int32")})

    return bricks.transform(in_frames, unpack, "z int, y int, x int, value int")


def to_slices(vox: DataFrame, shape: tuple[int, int, int], dtype: str = "<u2", prefix: str = "mask", tile: int = 1024) -> DataFrame:
    """(z, name, height, width, dtype, data): one dense image for each occupied slice.

    Voxels become bricks of a plane and ``tile`` x ``tile`` cells, and a slice is pasted from its bricks, so no task
    takes the voxels of a whole slice as rows. A slice of one brick is that brick.
    """
    _, ny, nx = shape
    tiles = to_bricks(vox, shape, (1, tile, tile), dtype)
    if max(ny, nx) <= tile:
        name = F.format_string(f"{prefix}_%04d", "bz")
        return tiles.select(F.col("bz").alias("z"), name.alias("name"), F.lit(ny).alias("height"), F.lit(nx).alias("width"), F.lit(dtype).alias("dtype"), "data")
    whole = tiles.groupBy(F.col("bz").alias("z")).agg(F.collect_list(F.struct("y0", "x0", "dy", "dx", "data")).alias("tiles"))

    def paste(parts):
        import numpy as np
        import pandas as pd

        for pdf in parts:
            for z, found in zip(pdf["z"], pdf["tiles"], strict=True):
                cells = np.zeros((ny, nx), dtype)
                for t in found:
                    cells[t["y0"] : t["y0"] + t["dy"], t["x0"] : t["x0"] + t["dx"]] = np.frombuffer(t["data"], dtype).reshape(t["dy"], t["dx"])
                yield pd.DataFrame([(z, f"{prefix}_{z:04d}", ny, nx, dtype, cells.tobytes())], columns=["z", "name", "height", "width", "dtype", "data"])

    return whole.transform(in_frames, paste, "z int, name string, height int, width int, dtype string, data binary")


def predict_bricks(bricks: DataFrame, load: Callable, batch: int = 8, dtype: str = "<u2") -> DataFrame:
    """bricks with data replaced by a model's prediction of the same shape, as ``dtype``.

    load() gives the model once for a partition; model(array of [batch, z, y, x]) -> the same shape. Up to ``batch``
    bricks that follow each other with one shape and type go in at once.
    """

    def run(parts):
        import numpy as np

        model = None
        for pdf in parts:
            model = load() if model is None else model
            kind = list(zip(pdf["dtype"], pdf["dz"], pdf["dy"], pdf["dx"], strict=True))
            out, at = [], 0
            while at < len(kind):
                end = at + 1
                while end < len(kind) and end - at < batch and kind[end] == kind[at]:
                    end += 1
                t, *size = kind[at]
                cells = np.stack([np.frombuffer(x, t).reshape(size) for x in pdf["data"].iloc[at:end]])
                out += [np.ascontiguousarray(x, dtype).tobytes() for x in model(cells)]
                at = end
            yield pdf.assign(data=out, dtype=dtype)

    return bricks.transform(in_frames, run, bricks.schema)


def map_slices(slices: DataFrame, fn: Callable, dtype: str = "<f8") -> DataFrame:
    """slices with data replaced by fn(image, z) as ``dtype``; a row at a time, no shuffle. Results go on a few at a time."""

    def run(parts):
        import numpy as np

        for pdf in parts:
            out, begin, held = [], 0, 0
            for k, (d, t, h, w, z) in enumerate(zip(pdf["data"], pdf["dtype"], pdf["height"], pdf["width"], pdf["z"], strict=True)):
                out.append(np.ascontiguousarray(fn(np.frombuffer(d, t).reshape(h, w), z), dtype).tobytes())
                held += len(out[-1])
                if held > _HELD // 2 or k + 1 == len(pdf):
                    yield pdf.iloc[begin : k + 1].assign(data=out, dtype=dtype)
                    out, begin, held = [], k + 1, 0

    return slices.transform(in_frames, run, slices.schema)


def map_blocks(vox: DataFrame, shape: tuple[int, int, int], block: tuple[int, int, int], halo: int, fn: Callable) -> DataFrame:
    """(bz, by, bx, z, y, x, value) from fn(z0, y0, x0, dense block with halo) -> (z, y, x, value) arrays.

    A voxel within ``halo`` of a face also goes to the block beyond it. What fn returns outside the block's own
    cells is dropped.
    """
    low = [F.floor((F.col(c) - halo) / n) for c, n in zip(KEY, block, strict=True)]
    high = [F.least(F.floor((F.col(c) + halo) / n), F.lit((s - 1) // n)) for c, n, s in zip(KEY, block, shape, strict=True)]
    out = vox.select(*KEY, "value")
    for b, lo, hi in zip(B_KEY, low, high, strict=True):
        out = out.withColumn(b, F.explode(F.sequence(F.greatest(lo, F.lit(0)).cast("int"), hi.cast("int"))))

    def run(pdf):
        import numpy as np
        import pandas as pd

        b = pdf[B_KEY].iloc[0].to_numpy()
        begin = b * np.array(block)
        end = np.minimum(begin + block, shape)
        z0 = np.maximum(begin - halo, 0)
        cells = np.zeros(np.minimum(end + halo, shape) - z0, pdf["value"].dtype)
        cells[tuple(pdf[c].to_numpy() - o for c, o in zip(KEY, z0, strict=True))] = pdf["value"].to_numpy()
        *at, value = fn(*z0, cells)
        own = np.all([(a >= lo) & (a < hi) for a, lo, hi in zip(at, begin, end, strict=True)], axis=0)
        cols = {c: np.full(own.sum(), v, "int32") for c, v in zip(B_KEY, b, strict=True)}
        return pd.DataFrame(cols | {c: a[own].astype("int32") for c, a in zip(KEY, at, strict=True)} | {"value": np.asarray(value)[own].astype("float64")})

    return out.groupBy(*B_KEY).applyInPandas(run, "bz int, by int, bx int, z int, y int, x int, value double")
