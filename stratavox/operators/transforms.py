"""Lists of transforms: affines and displacement fields, forward or inverted, that points go through in order.

A point is a row; an affine is arithmetic on its columns. A field is given at the nodes of a coarse grid and is
linear in between: each grid cell becomes one row with its eight corners, so that a point finds its displacement by
one equi-join, and nothing is aggregated for a point. A field is inverted on its grid, once, before points meet it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import spill
from .voxels import KEY

MOVE = ["dz", "dy", "dx"]
CORNERS = list(product((0, 1), repeat=3))


@dataclass(frozen=True)
class Affine:
    """Twelve numbers, rows z, y, x of (z, y, x, 1)."""

    numbers: tuple[float, ...]
    invert: bool = False

    def matrix(self) -> np.ndarray:
        """Three rows of four."""
        whole = np.vstack([np.reshape(self.numbers, (3, 4)), [0, 0, 0, 1]]).astype(float)
        return (np.linalg.inv(whole) if self.invert else whole)[:3]


@dataclass(frozen=True)
class Field:
    """Displacements (z, y, x, dz, dy, dx) at grid nodes; node (i, j, k) lies at ``step`` times (i, j, k).

    A node that is absent does not move, so beyond the grid nothing does. grid: its nodes by axis, which an inverted
    field needs, as its inverse moves other nodes than it does.
    """

    nodes: DataFrame
    step: tuple[float, float, float] = (1.0, 1.0, 1.0)
    invert: bool = False
    grid: tuple[int, int, int] | None = None


def corner_cells(nodes: DataFrame) -> DataFrame:
    """(c_z, c_y, c_x, dz_0 .. dx_7): each grid cell with the displacements of its corners."""
    cell = lambda k, o: F.struct(F.lit(k).alias("k"), *[(F.col(c) - s).cast("long").alias(f"c_{c}") for c, s in zip(KEY, o, strict=True)])
    rows = nodes.select(*MOVE, F.explode(F.array(*[cell(k, o) for k, o in enumerate(CORNERS)])).alias("s")).select(*MOVE, "s.*")
    found = [F.max(F.when(F.col("k") == k, F.col(m).cast("double"))).alias(f"{m}_{k}") for k in range(8) for m in MOVE]
    return rows.groupBy(*[f"c_{c}" for c in KEY]).agg(*found)


def displaced(points: DataFrame, cells: DataFrame, step: tuple[float, float, float], at: tuple[str, ...] = ("pz", "py", "px")) -> DataFrame:
    """points with dz, dy, dx: the field at the columns ``at``, linear between nodes."""
    place = [F.col(p) / F.lit(float(s)) for p, s in zip(at, step, strict=True)]
    low = [F.floor(p) for p in place]
    rows = points.withColumns({f"c_{c}": x for c, x in zip(KEY, low, strict=True)} | {f"_f{c}": p - x for c, p, x in zip(KEY, place, low, strict=True)})
    met = rows.join(cells, [f"c_{c}" for c in KEY], "left")
    share = [reduce(lambda a, b: a * b, [F.col(f"_f{c}") if o else 1 - F.col(f"_f{c}") for c, o in zip(KEY, corner, strict=True)]) for corner in CORNERS]
    move = {m: reduce(lambda a, b: a + b, [w * F.coalesce(f"{m}_{k}", F.lit(0.0)) for k, w in enumerate(share)]) for m in MOVE}
    return met.select(*points.columns, *[x.alias(m) for m, x in move.items()])


def inverse_field(field: Field, rounds: int = 20, tolerance: float = 1e-3) -> DataFrame:
    """Nodes of the inverse on the same grid: v with v(p) = -u(p + v(p)), by fixed-point rounds.

    A round moves every node by one equi-join and writes the grid; it ends when no node moves by more than
    ``tolerance``. Nodes that do not move are left out. The field must not fold (no two points at one place), else the
    rounds do not settle and the last one counts.
    """
    if field.grid is None:
        raise ValueError("to invert a field its grid must be given")
    nz, ny, nx = field.grid
    i = F.col("id")
    cells = spill(corner_cells(field.nodes))
    all_nodes = field.nodes.sparkSession.range(nz * ny * nx).select(F.floor(i / (ny * nx)).cast("int").alias("z"), (F.floor(i / nx) % ny).cast("int").alias("y"), (i % nx).cast("int").alias("x"))
    now = all_nodes.select(*KEY, *[F.lit(0.0).alias(m) for m in MOVE])
    for _ in range(rounds):
        at = now.select(*KEY, *[F.col(m).alias(f"o{m}") for m in MOVE], *[(F.col(c) * F.lit(float(s)) + F.col(m)).alias(f"p{c}") for c, s, m in zip(KEY, field.step, MOVE, strict=True)])
        found = displaced(at, cells, field.step)
        now = spill(found.select(*KEY, *[(F.lit(0.0) - F.col(m)).alias(m) for m in MOVE], F.greatest(*[F.abs(F.col(m) + F.col(f"o{m}")) for m in MOVE]).alias("moved")))
        if (now.agg(F.max("moved")).first()[0] or 0.0) <= tolerance:
            break
    return now.filter(" OR ".join(f"{m} <> 0" for m in MOVE)).select(*KEY, *MOVE)


def moved_points(points: DataFrame, steps: list[Affine | Field], rounds: int = 20, tolerance: float = 1e-3) -> DataFrame:
    """points (pz, py, px and any other columns) after all steps, in order."""
    out = points
    for step in steps:
        if isinstance(step, Affine):
            row = lambda r: reduce(lambda a, b: a + b, [F.lit(float(n)) * F.col(p) for n, p in zip(r[:3], ("pz", "py", "px"), strict=True)]) + F.lit(float(r[3]))
            out = out.withColumns({p: row(r) for p, r in zip(("pz", "py", "px"), step.matrix(), strict=True)})
        else:
            nodes = inverse_field(step, rounds, tolerance) if step.invert else step.nodes
            found = displaced(out, corner_cells(nodes), step.step)
            out = found.withColumns({p: F.col(p) + F.col(m) for p, m in zip(("pz", "py", "px"), MOVE, strict=True)}).drop(*MOVE)
    return out


def nearest_cell(c: str) -> Column:
    return F.floor(F.col(c) + 0.5).cast("int")


def warp_list(fixed: DataFrame, moving: DataFrame, steps: list[Affine | Field], value: str = "value") -> DataFrame:
    """For each cell of fixed (z, y, x) the moving value at its place after all steps; outside is 0.

    The steps are in the order in which a point of the fixed volume goes through them; no step leaves it where it is.
    """
    points = fixed.select(*KEY, *[F.col(c).cast("double").alias(f"p{c}") for c in KEY])
    at = moved_points(points, steps).select(*KEY, *[nearest_cell(f"p{c}").alias(f"s_{c}") for c in KEY])
    source = moving.select(*[F.col(c).alias(f"s_{c}") for c in KEY], value)
    return at.join(source, [f"s_{c}" for c in KEY], "left").select(*KEY, F.coalesce(value, F.lit(0)).alias(value))
