"""Hard-negative mining by angular triangle filtering.

A row's angles to a few reference directions are stored beside it. By the triangle inequality on the sphere two
rows' own angle is at least the greatest difference and at most the least sum of their angles to a direction. So
an interval of angles bounds the cosine, and times the norms, widened for rounding, the score. Rows are sorted so
that neighbours have like angles; a window of ``WINDOW`` rows is compared by the least and greatest angles in it,
and only windows whose bounds overlap what an anchor still looks for get integer scores.

Anchors meet all rows in blocks: chunks of anchors with lanes of rows, every pair of the two in one group, sorted
so that the anchors come first; a group hands on a few rows for each anchor. The first pass finds the anchors'
best rows of their own label (positives), the second one the best rows of other labels in the score windows that
the positives open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .centroids import LIMIT, sound
from .common import map_batches, read, spill

REFERENCES, WINDOW, CHUNK, LANE = 8, 64, 1024, 32768
#: Anchors are the rows whose id is divisible by EVERY; ids divisible by SHIFTED get the next label.
EVERY, SHIFTED, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is from LOW to HIGH hundredths of the positive's.
LOW, HIGH = 50, 95
#: Radians that the stored angles (32 bits) may be off, and the share of the norms' product that a bound is widened by.
SLACK, WIDE = 4e-6, 1e-9

ROW = "rid long, vec_id long, label long, cells binary"


def prepared(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(rid, vec_id, label, cells): a written row for each row that takes part, its cells floor(256 x) as 32-bit integers."""
    vec_id = vectors[id_col].cast("long")
    label = vectors[label_col].cast("long")
    moved = F.when(F.coalesce(vec_id % SHIFTED == 0, F.lit(False)), (label + 1) % LABELS).otherwise(label)
    rows = vectors.select(vec_id.alias("vec_id"), moved.alias("label"), vectors[vector_col].alias("v")).filter(F.col("label").isNotNull() & sound("v"))

    def make():
        def each(b: pa.RecordBatch) -> list:
            x = np.floor(b.column(3).flatten().to_numpy(zero_copy_only=False).astype(float) * 256)
            if len(x) and np.abs(x).max() > LIMIT:
                raise OverflowError(f"components beyond {LIMIT // 256} have no exact score")
            ends = np.cumsum([0, *b.column(3).value_lengths().to_pylist()])
            cells = x.astype("<i4")
            return [b.column(0), b.column(1), b.column(2), [cells[s:e].tobytes() for s, e in zip(ends, ends[1:])]]

        return each

    return spill(map_batches(rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "v"), make, ROW))


def angles(x: np.ndarray, refs: list[np.ndarray]) -> np.ndarray:
    """Angles (rows, references) to the directions; a row of zeros has angles of 0."""
    out = np.zeros((len(x), len(refs)), np.float32)
    norm = np.sqrt((x * x).sum(axis=1))
    for k, r in enumerate(refs):
        u = np.resize(r, x.shape[1]).astype(float) if x.shape[1] else np.zeros(0)
        scale = norm * (np.sqrt((u * u).sum()) or 1.0)
        out[:, k] = np.where(scale > 0, np.arccos(np.clip(x @ u / np.where(scale > 0, scale, 1), -1, 1)), 0)
    return out


def with_angles(rows: DataFrame, references: int = REFERENCES) -> DataFrame:
    """rows with dims, near (the reference of least angle) and angles, written. References are the rows of least hash."""
    first = rows.orderBy(F.xxhash64("cells"), "cells").select("cells").limit(references).collect()  # a fixed number of rows
    refs = [np.frombuffer(r["cells"], "<i4").astype(float) for r in first]
    refs = [r for r in refs if r.any()] or [np.ones(1)]

    def make():
        def each(b: pa.RecordBatch) -> list:
            size = np.array([len(c) // 4 for c in b.column(3).to_pylist()], np.int64)
            found = np.zeros((b.num_rows, len(refs)), np.float32)
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                x = np.frombuffer(b"".join(b.column(3).take(pa.array(at)).to_pylist()), "<i4").reshape(len(at), d).astype(float)
                found[at] = angles(x, refs)
            return [b.column(0), b.column(1), b.column(2), b.column(3), size, found.argmin(axis=1), found.min(axis=1).astype(float), [a.tobytes() for a in found]]

        return each

    return spill(map_batches(rows, make, ROW + ", dims long, near long, least double, angles binary"))


class Rows:
    """A batch's rows as arrays."""

    def __init__(self, b: pa.RecordBatch):
        get = lambda n: b.column(b.schema.get_field_index(n))
        self.n = b.num_rows
        self.rid, self.label = (get(c).to_numpy(zero_copy_only=False) for c in ("rid", "label"))
        self.missing = np.asarray(get("vec_id").is_null())
        self.id = get("vec_id").fill_null(0).to_numpy(zero_copy_only=False)
        self.x = np.frombuffer(b"".join(get("cells").to_pylist()), "<i4").reshape(self.n, -1)
        self.angle = np.frombuffer(b"".join(get("angles").to_pylist()), "<f4").reshape(self.n, -1).astype(float)
        self.norm = np.sqrt((self.x.astype(float) ** 2).sum(axis=1))


def bounds(a: Rows, b: Rows, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) score of each anchor with each window of b that begins at start; bounds are never too tight."""
    low, high = np.minimum.reduceat(b.angle, start), np.maximum.reduceat(b.angle, start)
    least, most = np.zeros((a.n, len(start))), np.full((a.n, len(start)), np.pi)
    for k in range(a.angle.shape[1]):
        t = a.angle[:, k, None]
        np.maximum(least, np.maximum(low[:, k] - t, t - high[:, k]), out=least)
        far = t + high[:, k]
        np.minimum(most, np.where(t + low[:, k] >= np.pi, 2 * np.pi - t - low[:, k], np.where(far > np.pi, np.pi, far)), out=most)
    top, bottom = np.cos(np.clip(least - SLACK, 0, np.pi)), np.cos(np.clip(most + SLACK, 0, np.pi))
    n0, n1 = np.minimum.reduceat(b.norm, start), np.maximum.reduceat(b.norm, start)
    upper = a.norm[:, None] * np.where(top > 0, n1, n0) * top
    lower = a.norm[:, None] * np.where(bottom < 0, n1, n0) * bottom
    room = a.norm[:, None] * n1 * WIDE + 1
    return lower - room, upper + room


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floating point where no sum can leave its 53 bits."""
    size = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if size >= 1 << 63:
        raise OverflowError("an inner product does not fit in 64 bits")
    if size < 1 << 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def overlapping(a: Rows, b: Rows, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the pairs in windows that may reach low to high; the caller cuts by the scores."""
    start = np.arange(0, b.n, WINDOW)
    lower, upper = bounds(a, b, start)
    meets = (upper >= low[:, None]) & (lower <= high[:, None])
    who, which = np.flatnonzero(meets.any(axis=1)), np.flatnonzero(meets.any(axis=0))
    if not len(who):
        return (np.zeros(0, np.int64),) * 3
    rows = np.flatnonzero(np.isin(np.arange(b.n) // WINDOW, which))
    s = scores(a.x[who], b.x[rows])
    wanted = meets[who][:, rows // WINDOW] & (s >= low[who, None]) & (s <= high[who, None])
    i, j = np.nonzero(wanted)
    return who[i], rows[j], s[i, j]


class Best:
    """The best rows of each of ``n`` lists: greatest score, then least id, null ids last."""

    def __init__(self, n: int, keep: int):
        self.n, self.keep = n, keep
        self.list, self.score, self.id, self.rid = (np.zeros(0, np.int64) for _ in range(4))
        self.missing = np.zeros(0, bool)

    def add(self, where, score, ids, missing, rid) -> None:
        cols = [np.concatenate(x) for x in ((self.list, where), (self.score, score), (self.missing, missing), (self.id, ids), (self.rid, rid))]
        order = np.lexsort((cols[4], cols[3], cols[2], -cols[1], cols[0]))
        at = cols[0][order]
        first = np.searchsorted(at, at)
        kept = order[np.arange(len(at)) - first < self.keep]
        self.list, self.score, self.missing, self.id, self.rid = (c[kept] for c in cols)

    def floor(self) -> np.ndarray:
        """The least score that still gets into each list: that of its last row once it is full."""
        out = np.full(self.n, np.iinfo(np.int64).min)
        full = np.flatnonzero(np.bincount(self.list, minlength=self.n) == self.keep)
        last = np.searchsorted(self.list, full, "right") - 1
        out[full] = self.score[last]
        return out


def positives(a: Rows, b: Rows, best: Best) -> None:
    for label in np.intersect1d(a.label, b.label):
        own, rows = np.flatnonzero(a.label == label), np.flatnonzero(b.label == label)
        i, j, s = overlapping(part(a, own), part(b, rows), best.floor()[own], np.full(len(own), np.iinfo(np.int64).max))
        i, j = own[i], rows[j]
        other = a.rid[i] != b.rid[j]
        i, j, s = i[other], j[other], s[other]
        best.add(i, s, b.id[j], b.missing[j], b.rid[j])


def part(r: Rows, at: np.ndarray) -> Rows:
    out = object.__new__(Rows)
    out.n = len(at)
    for name in ("rid", "label", "missing", "id", "x", "angle", "norm"):
        setattr(out, name, getattr(r, name)[at])
    return out


def negatives(a: Rows, b: Rows, best: Best, wants: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
    """wants: (anchor, least score, greatest score) of each list, sorted by anchor."""
    who, low, high = wants
    low = np.maximum(low, best.floor())
    open_ = low <= high
    least, most = np.full(a.n, np.iinfo(np.int64).max), np.full(a.n, np.iinfo(np.int64).min)
    np.minimum.at(least, who[open_], low[open_])
    np.maximum.at(most, who[open_], high[open_])
    i, j, s = overlapping(a, b, least, most)
    other = a.label[i] != b.label[j]
    i, j, s = i[other], j[other], s[other]
    # each pair with each list of its anchor
    first, n = np.searchsorted(who, i, "left"), np.searchsorted(who, i, "right") - np.searchsorted(who, i, "left")
    pair = np.repeat(np.arange(len(i)), n)
    lists = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    fits = (s[pair] >= low[lists]) & (s[pair] <= high[lists])
    pair, lists = pair[fits], lists[fits]
    best.add(lists, s[pair], b.id[j[pair]], b.missing[j[pair]], b.rid[j[pair]])


FOUND = "anchor long, slot long, score long, vec_id long, rid long"


def _met(batches: Iterator[pa.RecordBatch], second: bool) -> Iterator[pa.RecordBatch]:
    """Groups (sorted by key, anchors first): the best rows of each group's anchors."""
    key, a, best, wants = None, None, None, None
    held: list[pa.RecordBatch] = []

    def done():
        if best is None or not len(best.list):
            return
        anchor, slot = (wants[0][best.list], wants[3][best.list]) if second else (best.list, np.zeros(len(best.list), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(a.rid[anchor]), pa.array(slot), pa.array(best.score), pa.array(best.id, mask=best.missing), pa.array(best.rid)], names=[c.split()[0] for c in FOUND.split(", ")])

    for whole in batches:
        keys = whole.column(0).to_numpy(zero_copy_only=False)
        kind = whole.column(1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (kind[1:] != kind[:-1])]) if len(keys) else []
        for s, e in zip(cuts, [*cuts[1:], len(keys)]):
            if keys[s] != key:
                yield from done()
                key, a, best, held = keys[s], None, None, []
            if kind[s] == 0:
                held.append(whole.slice(s, e - s))
                continue
            if not held and a is None:
                continue  # rows of a lane without anchors
            if a is None:
                table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                a, held = Rows(table), []
                if second:
                    lists = table.column(table.schema.get_field_index("lists"))
                    size = np.array(lists.value_lengths().to_pylist(), np.int64)
                    cells = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, 3)
                    wants = np.repeat(np.arange(a.n), size // 3), cells[:, 1], cells[:, 2], cells[:, 0]
                    best = Best(len(cells), NEGATIVES)
                else:
                    best = Best(a.n, POSITIVES)
            for at in range(s, e, CHUNK):
                b = Rows(whole.slice(at, min(CHUNK, e - at)))
                if second:
                    negatives(a, b, best, wants[:3])
                else:
                    positives(a, b, best)
    yield from done()


def meet(anchors: DataFrame, rows: DataFrame, second: bool, n_anchors: int, n_rows: int) -> DataFrame:
    """What each group of a chunk of anchors and a lane of rows finds.

    A chunk has about CHUNK anchors; a lane at most about LANE rows, and fewer where that makes too few groups. Rows
    and anchors are dealt by their row number, so neither a label nor a vector that many rows have is one task's.
    """
    chunks = -(-max(n_anchors, 1) // CHUNK)
    lanes = max(1, -(-n_rows // LANE), min(64 // chunks, n_rows // 512))
    spread = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    lists = F.col("lists") if second else F.lit(None).cast("array<long>")
    one = anchors.withColumn("lists", lists).withColumn("kind", F.lit(0)).withColumn("chunk", spread(chunks)).withColumn("lane", each(lanes))
    two = rows.withColumn("lists", F.lit(None).cast("array<long>")).withColumn("kind", F.lit(1)).withColumn("lane", spread(lanes)).withColumn("chunk", each(chunks))
    columns = ["key", "kind", "rid", "vec_id", "label", "cells", "angles", "lists", "near", "least"]
    both = one.unionByName(two).withColumn("key", (F.col("dims") * chunks + F.col("chunk")) * lanes + F.col("lane")).select(columns)
    # by label and nearest reference, so that a window holds rows of like angles
    dealt = both.repartition("key").sortWithinPartitions("key", "kind", "label", "near", "least")
    return dealt.mapInArrow(lambda batches: _met(batches, second), FOUND)


def mined(vectors: DataFrame, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Rows with a null label, a null vector or a null or non-finite component take no part. Null ids are never anchors
    and come last among equal scores. Rows that repeat an id are rows of their own: each may be an anchor, and each is
    an "other row" to its like. Vectors of different lengths do not meet; those of no components score 0. An anchor
    without positives, or a positive without fitting negatives, has no rows, nor has an empty table. Other columns
    are ignored.
    """
    rows = with_angles(prepared(vectors, id_col, vector_col, label_col))
    anchors = rows.filter(F.col("vec_id") % every == 0)
    n_anchors, n_rows = anchors.count(), rows.count()
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "rid"]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    found = meet(anchors, rows, False, n_anchors, n_rows)
    pos = spill(found.withColumn("slot", rank("anchor").cast("long")).filter(F.col("slot") <= POSITIVES))
    # 50 p <= 100 s <= 95 p in whole numbers
    low, high = F.ceil(F.col("score") * LOW / F.lit(100).cast("decimal(3,0)")), F.floor(F.col("score") * HIGH / F.lit(100).cast("decimal(3,0)"))
    lists = pos.filter("score >= 0").select("anchor", F.array("slot", low.cast("long"), high.cast("long")).alias("one"))
    wanted = lists.groupBy("anchor").agg(F.flatten(F.sort_array(F.collect_list("one"))).alias("lists"))  # POSITIVES at most
    asking = anchors.join(wanted, anchors["rid"] == wanted["anchor"]).drop("anchor")
    neg = meet(asking, rows, True, n_anchors, n_rows).withColumn("rank", rank("anchor", "slot")).filter(F.col("rank") <= NEGATIVES)
    named = pos.join(anchors.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor").select("anchor", "slot", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = neg.select("anchor", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(named, ["anchor", "slot"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(read(spark, sf_dir, "embeddings"))


ORACLE_SQL = f"""
WITH x AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % {SHIFTED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
  list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding)),
s AS MATERIALIZED (SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda t: t[1] * t[2])) AS BIGINT) AS score
  FROM x a JOIN x b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.vec_id % {EVERY} = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS k FROM s WHERE same QUALIFY k <= {POSITIVES}),
n AS (SELECT p.r, p.k, p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.r = s.r AND NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY r, k ORDER BY negative_score DESC, negative_id NULLS LAST) AS INT) AS rank, negative_id, positive_score, negative_score
FROM n QUALIFY rank <= {NEGATIVES}
"""
