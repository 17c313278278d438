"""How well two labelled volumes agree: Dice overlap, and exact distances between surfaces.

Most surfaces lie close to each other, so a voxel first looks within a short reach, in the block it lies in and that
block's rim. What it meets there is nearest of all; the few that meet nothing look further in larger blocks, and those
that still meet nothing get their distance from a transform of the whole volume.

The transform goes along whole lines of one axis after the other. On a line each cell that has a squared distance d
already is a parabola d + w^2 (x - j)^2, and the lower envelope of the parabolas gives every cell its least value, in
whole numbers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import in_frames, spill
from .blocks import B_KEY, to_bricks
from .kernels import along_lines, cells_where
from .voxels import KEY

NONE = np.iinfo(np.int64).max // 4
#: Pairs of voxels that are compared at once, and in one block; voxels that a block may hold of each side.
AT_ONCE, PAIRS, HELD = 1 << 20, 1 << 28, 1 << 21


def envelope(values: np.ndarray, step: int = 1) -> np.ndarray:
    """min over j of values[:, j] + (step * (x - j))^2 for each x of each line; NONE where a line has no value.

    All lines advance together, cell by cell; each keeps its own stack of parabolas and where each begins to be least.
    """
    lines, n = values.shape
    every, square = np.arange(lines), step * step
    place, begin = np.zeros((lines, n), np.int64), np.zeros((lines, n), np.int64)
    top = np.full(lines, -1)
    for q in range(n):
        todo = every[values[:, q] < NONE]
        start = np.zeros(lines, np.int64)
        height = values[:, q] + square * q * q
        while len(todo):
            full = todo[top[todo] >= 0]
            v = place[full, top[full]]
            rise, run = height[full] - values[full, v] - square * v * v, 2 * square * (q - v)
            start[full] = -(-rise // run)  # the first cell where the new parabola is not above
            worse = start[full] <= begin[full, top[full]]
            top[full[worse]] -= 1
            start[full[worse]] = 0
            todo = full[worse]
        new = every[values[:, q] < NONE]
        new = new[start[new] < n]
        top[new] += 1
        place[new, top[new]], begin[new, top[new]] = q, np.where(top[new] == 0, 0, start[new])
    out, at = np.full((lines, n), NONE), np.zeros(lines, np.int64)
    some = every[top >= 0]
    for x in range(n):
        while True:
            on = some[(at[some] < top[some]) & (begin[some, np.minimum(at[some] + 1, n - 1)] <= x)]
            if not len(on):
                break
            at[on] += 1
        j = place[some, at[some]]
        out[some, x] = values[some, j] + square * (x - j) ** 2
    return out


def distance_bricks(surface: DataFrame, shape: tuple[int, int, int], steps: tuple[int, int, int] = (1, 1, 1), tile: int = 32) -> DataFrame:
    """Cubes of 1 + the squared distance of every cell to the nearest voxel of surface (z, y, x); none without voxels.

    steps: how far neighbours are on each axis, in whole units. 0 says that no voxel was met, so what is not there
    yet is an absent cube.
    """
    cubes = to_bricks(surface.select(*KEY, F.lit(1).alias("value")), shape, (tile,) * 3, "<i8")

    def along(cells: np.ndarray, k: int) -> np.ndarray:
        lines = np.moveaxis(cells, k, 2)
        flat = lines.reshape(-1, lines.shape[2])
        out, lot = np.empty_like(flat), max(1, (1 << 22) // flat.shape[1])
        for at in range(0, len(flat), lot):  # the stacks of parabolas are several times as large as the lines
            part = flat[at : at + lot]
            out[at : at + lot] = envelope(np.where(part > 0, part - 1, NONE), steps[k])
        return np.moveaxis(np.where(out < NONE, out + 1, 0).reshape(lines.shape), 2, k)

    for axis in reversed(KEY):
        cubes = along_lines(cubes, axis, shape, tile, along)
    return cubes


def _nearest(p: np.ndarray, q: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The least squared distance from each of p to q, rows of whole coordinates; by comparing all pairs."""
    out, lot = np.full(len(p), NONE), max(1, AT_ONCE // max(1, len(p)))
    for s in range(0, len(q), lot):
        d = sum((step * (p[:, k, None] - q[None, s : s + lot, k])) ** 2 for k, step in enumerate(scale.tolist()))
        np.minimum(out, d.min(axis=1), out=out)
    return out


def _transformed(p: np.ndarray, q: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The same as _nearest by a transform of the box that holds both; its cost does not depend on how many there are."""
    low = np.minimum(p.min(axis=0), q.min(axis=0))
    cells = np.full(np.maximum(p.max(axis=0), q.max(axis=0)) - low + 1, NONE)
    cells[tuple((q - low).T)] = 0
    for k, step in enumerate(scale.tolist()):
        lines = np.moveaxis(cells, k, 2)
        cells = np.moveaxis(envelope(lines.reshape(-1, lines.shape[2]), step).reshape(lines.shape), 2, k)
    return cells[tuple((p - low).T)]


def near_distance(a: DataFrame, b: DataFrame, steps: tuple[int, int, int], block: int, far: int) -> DataFrame:
    """Voxels of a (z, y, x) with dist2 to the nearest voxel of b, null where none lies within ``far`` (as far as steps go).

    A block of ``block`` cells a side gets its own voxels of a and those of b in it and in a rim as wide as ``far``. A
    block with too many voxels for a task hands its own on without a distance.
    """
    rim, scale = [far // s for s in steps], np.array(steps, np.int64)
    home = [F.floor(F.col(c) / block).cast("int").alias(k) for c, k in zip(KEY, B_KEY, strict=True)]
    sent = b.select(*KEY)
    for c, k, r in zip(KEY, B_KEY, rim, strict=True):
        sent = sent.withColumn(k, F.explode(F.sequence(F.floor((F.col(c) - r) / block).cast("int"), F.floor((F.col(c) + r) / block).cast("int"))))
    rows = a.select(*KEY, *home, F.lit(0).alias("side")).unionByName(sent.withColumn("side", F.lit(1)).select(*KEY, *B_KEY, "side"))

    def found(p: list, q: list, n_p: int, n_q: int):
        import pandas as pd

        p = np.concatenate(p).astype(np.int64)
        d = np.full(len(p), NONE)
        if n_q and max(n_p, n_q) <= HELD:
            q = np.concatenate(q).astype(np.int64)
            box = int(np.prod(np.minimum([block + 2 * r for r in rim], np.maximum(p.max(axis=0), q.max(axis=0)) - np.minimum(p.min(axis=0), q.min(axis=0)) + 1)))
            if n_p * n_q > 64 * box and box <= 1 << 22:
                d = _transformed(p, q, scale)
            elif n_p * n_q <= PAIRS:
                for s in range(0, len(p), 1024):
                    d[s : s + 1024] = _nearest(p[s : s + 1024], q, scale)
        d = pd.array(d, "Int64")
        d[np.asarray(d > far * far)] = pd.NA
        return pd.DataFrame({c: p[:, k].astype("int32") for k, c in enumerate(KEY)} | {"dist2": d})

    def run(parts):
        now, p, q, n_p, n_q = None, [], [], 0, 0
        for pdf in parts:
            key, at, side = pdf[B_KEY].to_numpy(), pdf[KEY].to_numpy(), pdf["side"].to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for s, e in zip(np.r_[0, cut], np.r_[cut, len(key)], strict=True):
                if s == e:
                    continue
                if (k := tuple(key[s])) != now:
                    if n_p:
                        yield found(p, q, n_p, n_q)
                    now, p, q, n_p, n_q = k, [], [], 0, 0
                own = side[s:e] == 0
                if n_p > HELD and own.any():  # they are more than a block compares
                    yield found(p, [], n_p, 0)
                    p, n_p = [], 0
                p, n_p = [*p, at[s:e][own]], n_p + int(own.sum())
                n_q += int((~own).sum())
                q = [*q, at[s:e][~own]] if n_p and n_q <= HELD else []
        if n_p:
            yield found(p, q, n_p, n_q)

    return rows.repartition(*B_KEY).sortWithinPartitions(*B_KEY, "side").transform(in_frames, run, "z int, y int, x int, dist2 long")


def surface_distance(a: DataFrame, b: DataFrame, shape: tuple[int, int, int], steps: tuple[int, int, int] = (1, 1, 1), tile: int = 32) -> DataFrame:
    """a (z, y, x and any columns) with dist2, the squared distance to the nearest voxel of b; no rows if b is empty."""
    todo, done = a.select(*KEY).distinct(), None
    for wider in (1, 4):  # blocks of 2 and of 8 tiles a side; within reach of half a tile and of two
        seen = spill(near_distance(todo, b, steps, 2 * tile * wider, max(steps) * max(1, tile // 2) * wider))
        met, todo = seen.filter("dist2 IS NOT NULL"), seen.filter("dist2 IS NULL").select(*KEY)
        done = met if done is None else done.unionByName(met)
        if todo.isEmpty():
            return a.join(done, KEY)
    at = to_bricks(todo.withColumn("value", F.lit(1)), shape, (tile,) * 3, "|u1")
    rest = cells_where(distance_bricks(b, shape, steps, tile), at)
    return a.join(done.unionByName(rest.select(*KEY, (F.col("value") - 1).alias("dist2"))), KEY)


def dice(a: DataFrame, b: DataFrame) -> DataFrame:
    """(label, n_a, n_b, dice) of two labelled volumes (z, y, x, label); label 0 is background."""
    both = a.filter("label <> 0").select(*KEY, F.col("label").alias("la")).join(b.filter("label <> 0").select(*KEY, F.col("label").alias("lb")), KEY, "full")
    own = F.array(F.struct(F.col("la").alias("label"), F.lit(1).alias("a"), F.lit(0).alias("b")), F.struct(F.col("lb").alias("label"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    same = F.array(F.struct(F.col("la").alias("label"), F.lit(1).alias("a"), F.lit(1).alias("b")))
    rows = both.select(F.inline(F.when(F.col("la") == F.col("lb"), same).otherwise(own))).filter("label IS NOT NULL")
    sums = rows.groupBy("label").agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b"), F.sum(F.col("a") * F.col("b")).alias("n"))
    return sums.select("label", "n_a", "n_b", (2 * F.col("n") / (F.col("n_a") + F.col("n_b"))).alias("dice"))


def registration_quality(a: DataFrame, b: DataFrame, edge_a: DataFrame, edge_b: DataFrame, shape: tuple[int, int, int], steps: tuple[int, int, int] = (1, 1, 1), tile: int = 32) -> DataFrame:
    """(label, n_a, n_b, dice, mean_ab, most_ab, mean_ba, most_ba): overlap of the regions and distances of their edges.

    a and b: labelled volumes; edge_a and edge_b (z, y, x, label): their surface voxels. Distances go from each edge voxel
    of one to the nearest edge voxel of the other, whatever its label; a label without edges, or without any edge to
    meet, has null distances.
    """
    out = dice(a, b)
    for one, other, name in ((edge_a, edge_b, "ab"), (edge_b, edge_a, "ba")):
        d = F.sqrt(F.col("dist2").cast("double"))
        far = surface_distance(one.filter("label <> 0"), spill(other.select(*KEY).distinct()), shape, steps, tile)
        out = out.join(far.groupBy("label").agg(F.avg(d).alias(f"mean_{name}"), F.max(d).alias(f"most_{name}")), "label", "left")
    return out
