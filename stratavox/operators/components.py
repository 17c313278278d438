"""Connected components of an edge list.

Every task first contracts its own edges to a forest. What is left is contracted by alternating large-star and
small-star rounds until it is small enough for one task (FEW edges, whatever the input) or all stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import spill
from .joins import hot_keys, join_unique

#: Edges that are contracted at once in a task; a list of no more is finished by one task.
FEW = 1_000_000


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n rows the least row of its component under links (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        for at in (i, j, label[i], label[j]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of all nodes that are not the least of their component."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = forest(len(ids), at[: len(a)], at[len(a) :])
    out = np.flatnonzero(label != np.arange(len(ids)))
    return ids[out], ids[label[out]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of up to FEW edges at a time."""

    def one(part: list) -> pa.RecordBatch:
        found = contracted(*(np.concatenate(c) for c in zip(*part, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["a", "b"])

    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, FEW):
            some = batch.slice(at, FEW)
            if held and n + some.num_rows > FEW:
                yield one(held)
                held, n = [], 0
            held.append(tuple(some.column(k).to_numpy() for k in (0, 1)))
            n += some.num_rows
    if n:
        yield one(held)


def _round(edges: DataFrame, total: int) -> DataFrame:
    """A large-star and a small-star step; edges are (a, b) with a > b.

    Large: b's least neighbour takes b's place where it is less. Small: a's lesser neighbours move to the least of
    them. A node with very many edges meets its neighbour's row by broadcast.
    """
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    large = join_unique(edges, low.withColumnRenamed("a", "b"), hot_keys(edges, ["b"], total), ["b"], "left")
    large = spill(large.select("a", F.coalesce("m", "b").alias("b")).distinct())
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    joined = join_unique(large, low, hot_keys(large, ["a"], total), ["a"])
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def connected_components(edges: DataFrame, rounds: int = 60, few: int = FEW) -> DataFrame:
    """(node, root) for every node of an edge other than the roots; root is the component's least node.

    edges: columns a, b (long, null-free), any order, repeats and loops allowed. An empty list gives no
    rows. The number of rounds grows with the logarithm of the nodes; reaching ``rounds`` raises.
    Each round is written to the shared folder, so no lineage builds up.
    """
    now = spill(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b").mapInArrow(_contract, "a long, b long"))
    seen = None
    for _ in range(rounds):
        mark = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark["n"] <= min(few, FEW):
            now = spill(now.coalesce(1).mapInArrow(_contract, "a long, b long"))
            break
        if mark == seen:
            break
        seen = mark
        now = spill(_round(now, mark["n"]))
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
