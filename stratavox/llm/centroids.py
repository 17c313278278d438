"""Centroid clustering on integers: distances are read from scalar look-up tables.

Each component x of a vector becomes floor(256 x). A round sends the centroids to every task; for a batch of
vectors a task tabulates, for each dimension, the squared difference between every integer that occurs there and
every centroid. A vector's distances are then 64 gathers from these tables and their sum, without a
multiplication. Tasks hand back sums and counts for each centroid, so a round moves as many rows as there are
tasks times centroids, whatever the number of vectors; all arithmetic is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, read, spill

DIMS, CENTROIDS, ROUNDS, SEED = 64, 40, 5, 2
#: Greater integers than this would not leave squared distances within 64 bits.
LIMIT = 1 << 27
#: Vectors whose tables are made at once.
BATCH = 8192


def sound(vector: str, dims: int | None = None) -> Column:
    """Whether a vector has no null and no non-finite component (and ``dims`` of them)."""
    good = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(good & (F.size(vector) == dims if dims else F.lit(True)), F.lit(False))


def packed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS) -> DataFrame:
    """(vec_id, cells): vectors of ``dims`` sound components as little-endian 32-bit integers floor(256 x).

    An integer beyond LIMIT raises.
    """
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].alias("v")).filter(sound("v", dims))

    def make():
        def each(b: pa.RecordBatch) -> list:
            x = np.floor(b.column(1).flatten().to_numpy(zero_copy_only=False).astype(float) * 256)
            if len(x) and np.abs(x).max() > LIMIT:
                raise OverflowError(f"components beyond {LIMIT // 256} have no exact distance")
            cells = x.astype("<i4").reshape(b.num_rows, dims)
            return [b.column(0), [c.tobytes() for c in cells]]

        return each

    return map_batches(rows, make, "vec_id long, cells binary")


def seeds(cells: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The first centroids: the k vectors of least sha256 of ``seed:vec_id``; equal ids by their cells, null ids last."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = cells.orderBy(rank.asc_nulls_last(), "cells").limit(k).collect()  # k rows
    return np.array([np.frombuffer(r["cells"], "<i4") for r in first], np.int64).reshape(len(first), len(first[0]["cells"]) // 4 if first else 0)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (vectors, centroids) by table look-up; x: integers (vectors, dims)."""
    n, dims = x.shape
    reach = int(max(abs(int(x.min())), abs(int(x.max())))) + int(np.abs(centroids).max()) if n else 0
    kind = np.int32 if dims * reach * reach < 1 << 31 else np.int64
    total, found = np.zeros((n, len(centroids)), kind), np.empty((n, len(centroids)), kind)
    for d in range(dims):
        values, place = np.unique(x[:, d], return_inverse=True)
        table = ((values[:, None].astype(np.int64) - centroids[None, :, d]) ** 2).astype(kind)
        total += np.take(table, place, axis=0, out=found)
    return total


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, squared distance) of each vector; of equal distances the smaller number."""
    d = distances(x, centroids)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(x)), best].astype(np.int64)


def _parts(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for b in batches:
        for at in range(0, b.num_rows, BATCH):
            part = b.slice(at, BATCH)
            cells = b"".join(part.column(1).to_pylist())
            yield part.column(0), np.frombuffer(cells, "<i4").reshape(part.num_rows, dims)


def moved(cells: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: floor(sum / count) of their vectors by component; empty ones stay."""
    k, dims = centroids.shape

    def sums(batches):
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, x in _parts(batches, dims):
            at, _ = nearest(x, centroids)
            n += np.bincount(at, minlength=k)
            order = np.argsort(at, kind="stable")
            used, first = np.unique(at[order], return_index=True)
            if len(used):
                total[used] += np.add.reduceat(x[order].astype(np.int64), first, axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    rows = cells.mapInArrow(sums, "cluster long, n long, total array<long>")
    at = rows.select("cluster", "n", F.posexplode("total").alias("d", "v")).groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    out = centroids.copy()
    for r in at.collect():  # k times dims rows at most
        out[r["cluster"], r["d"]] = r["v"] // r["n"]
    return out


def clustered(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector of ``dims`` sound components.

    Vectors that are null, of another length or with a null or non-finite component have no row. Rows of one
    vec_id each get their row; null ids stay null and come last as first centroids. With fewer vectors than k
    there are fewer centroids; equal vectors may be several centroids, of which the smaller number takes all.
    An empty table gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    cells = spill(packed(vectors, id_col, vector_col, dims))
    centroids = seeds(cells, k, seed)
    if len(centroids):
        for _ in range(rounds):
            centroids = moved(cells, centroids)

    def assign(batches):
        for ids, x in _parts(batches, dims):
            at, d = nearest(x, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(at.astype(np.int32)), pa.array(d)], names=["vec_id", "cluster", "distance"])

    found = spill(cells.mapInArrow(assign, "vec_id long, cluster int, distance long"))
    sizes = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows at most
    digest = [sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    table = spark.createDataFrame([(c, s, sum(sizes.values()), digest[c]) for c, s in sorted(sizes.items())], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(read(spark, sf_dir, "embeddings"))


def _round_sql(i: int) -> str:
    """Assignment to the centroids of c{i} and the centroids after it."""
    return f"""a{i} AS MATERIALIZED (SELECT r, any_value(v) AS v, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
  SELECT x.r, x.v, c.k, CAST(list_sum(list_transform(list_zip(x.v, c.v), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS BIGINT) AS d FROM x, c{i} c) GROUP BY r),
m{i} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM (SELECT k, j, CAST(sum(e) AS BIGINT) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS e, unnest(range({DIMS})) AS j FROM a{i}) GROUP BY k, j) GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON c.k = m.k)"""


ORACLE_SQL = f"""
WITH x AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIMS}),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST) - 1 AS INT) AS k, v FROM x QUALIFY k < {CENTROIDS}),
{", ".join(_round_sql(i) for i in range(ROUNDS + 1))},
t AS (SELECT k, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a{ROUNDS} GROUP BY k)
SELECT vec_id, a.k AS cluster, d AS distance, cluster_inertia, (SELECT CAST(sum(d) AS BIGINT) FROM a{ROUNDS}) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN x USING (r) JOIN t ON t.k = a.k JOIN c{ROUNDS} c ON c.k = a.k
"""
