"""SimHash near-duplicates: pivot distance tables discard pairs, survivors are verified, links become components.

A fingerprint is 64 bits. Two fingerprints link at ``radius`` (3) or fewer differing bits. Candidates
meet in buckets: of five bands of bits, a linked pair agrees on at least two, so ten keys of two bands
lose no link. Inside a bucket each fingerprint has its precomputed distances to reference fingerprints
(the pivot table); by the triangle inequality a pair whose coordinates differ by more than the radius
anywhere can't link and is discarded; what is left is verified bit by bit. A bucket hands on a spanning
forest of its links, never its pairs; a bucket beyond ``block`` fingerprints is compared block against
block in separate tasks, so no group has to fit into one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import connected_components, forest
from .common import HOT, hot_keys, join_unique, map_batches, quoted, raw_texts, read, spill, texts

BANDS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
RADIUS, BLOCK, N_PIVOTS = 3, 4096, 16
_ROW = "the row's digest (near-duplicates)"
#: Rows as text that tells all their values apart: nulls are written, times have all their digits.
_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """n fixed reference fingerprints, spread by a multiplicative rule."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def fingerprint(raw: bytes) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text."""
    from xxhash import xxh64_digest

    words = raw.lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False)) if len(words) > 2 else [b" ".join(words)]
    bits = np.unpackbits(np.frombuffer(b"".join(map(xxh64_digest, shingles, repeat(42))), np.uint8)).reshape(-1, 64)
    n = len(bits)
    ones = np.add.reduceat(bits, np.arange(0, n, 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) for every row."""
    return map_batches(texts(docs, id_col, text_col), lambda: lambda b: (b.column(0), [fingerprint(t) for t in raw_texts(b)]), "doc_id long, fp long")


def _survivors(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) left after the pivot coordinates, one by one, and then verified."""
    for p in table:
        near = np.abs(p[i] - p[j]) <= radius
        i, j = i[near], j[near]
    linked = np.bitwise_count(fp[i] ^ fp[j]) <= radius
    return i[linked], j[linked]


def bucket_links(key: np.ndarray, fp: np.ndarray, refs: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that span each bucket's components; rows come sorted by bucket."""
    fp = fp.view(np.uint64)
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[start, len(key)])
    keep = np.repeat(size > 1, size)
    fp, size = fp[keep], size[size > 1]
    if not len(size):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = np.r_[0, np.cumsum(size)[:-1]]
    table = np.bitwise_count(refs[:, None] ^ fp[None, :]).astype(np.int8)
    found = []
    for s in np.unique(size[size <= 48]):
        a, b = np.triu_indices(s, 1)
        at = start[size == s]
        for k in range(0, len(at), step := max(1, 2_000_000 // len(a))):
            lo = at[k : k + step, None]
            found.append(_survivors(fp, table, (lo + a).ravel(), (lo + b).ravel(), radius))
    for lo, s in zip(start[size > 48], size[size > 48], strict=True):
        order = lo + np.argsort(table[0, lo : lo + s], kind="stable")
        first = table[0][order].astype(np.int64)
        end = np.searchsorted(first, first + radius, "right")
        for k in range(0, s, 256):  # rows in order of the first coordinate: only a window of it can survive
            rows = np.arange(k, min(k + 256, s))
            n = np.maximum(end[rows] - rows - 1, 0)
            i = np.repeat(rows, n)
            j = i + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append(_survivors(fp, table, order[i], order[j], radius))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    label = forest(len(fp), i, j)
    out = np.flatnonzero(label != np.arange(len(fp)))
    return fp[out].view(np.int64), fp[label[out]].view(np.int64)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole buckets at a time, over batches sorted by bucket."""
    refs, held = pivots(), None
    for b in batches:
        key, fp = (b.column(k).to_numpy() for k in (0, 1))
        if held is not None:
            key, fp = np.r_[held[0], key], np.r_[held[1], fp]
        if not len(key):
            continue
        cut = np.searchsorted(key, key[-1])
        held = key[cut:], fp[cut:]
        if cut:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in bucket_links(key[:cut], fp[:cut], refs)], names=["a", "b"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in bucket_links(*held, refs)], names=["a", "b"])


def links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between different fingerprints of column fp that span all components.

    fp holds no nulls (a null text has fingerprint zero); fingerprints that repeat are one; an empty table gives no
    links; other columns are ignored.
    """
    part = [F.shiftrightunsigned(F.shiftleft(F.col("fp"), 64 - at - n), 64 - n) for at, n in BANDS]
    keys = [F.shiftleft(F.lit(k).cast("long"), 26) + F.shiftleft(part[i], 13) + part[j] for k, (i, j) in enumerate(combinations(range(5), 2))]
    rows = fps.select("fp").distinct().select("fp", F.explode(F.array(*keys)).alias("key"))
    large = rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > block).select("key", F.ceil(F.col("n") / block).alias("c"))
    # (bucket, block, other block): c is 1 but for large buckets, whose rows go to each pair of blocks with their own
    own = F.pmod(F.xxhash64("fp"), F.col("c"))
    dealt = rows.join(large, "key", "left").withColumn("c", F.coalesce("c", F.lit(1).cast("long")))
    plain = dealt.filter("c = 1").select("key", "fp")
    split = dealt.filter("c > 1").withColumn("own", own).select("key", "fp", "c", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)).alias("other"))
    split = split.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).bitwiseOR(F.lit(1 << 62).cast("long")).alias("key"), "fp")
    met = plain.union(split).repartition("key").sortWithinPartitions("key", "fp")
    return met.mapInArrow(_links, "a long, b long")


def _rooted(fps: DataFrame) -> DataFrame:
    """(fp, root) for every fingerprint of column fp; root is that of its component."""
    roots = connected_components(links(fps))
    one = fps.select("fp").distinct()
    return one.join(roots, one["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs.

    A null or wordless text has fingerprint zero and links like any other. Rows of equal id or text each
    get their row. component_id is the least non-null id of the component (null if it has none). An empty
    table gives no rows; columns other than the two named are ignored.
    """
    fps = spill(fingerprints(docs, id_col, text_col))
    one = fps.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    roots = connected_components(links(fps))
    one = spill(one.join(roots, one["fp"] == roots["node"], "left").select("fp", "low", "n", F.coalesce("root", "fp").alias("root")))
    least = one.groupBy("root").agg(F.min("low").alias("component_id"))
    # most fingerprints may be of one component, whose row then goes to them by broadcast
    named = spill(join_unique(one, least, hot_keys(one, ["root"], one.count()), ["root"]).select("fp", "component_id", "n"))
    hot = named.filter(F.col("n") * HOT > fps.count())
    return join_unique(fps, named, hot, ["fp"]).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_survivors(docs: DataFrame) -> DataFrame:
    """docs with exactly one row of each near-duplicate group: that of its least doc_id, null ids last, and of
    rows of that id the one whose digest over all columns is least.

    Rows of one doc_id in different groups don't touch each other. Of rows equal in all columns one stays. Null and
    wordless texts are one group. Other columns of any name pass through. An empty table gives no rows.
    """
    names = quoted(docs.columns)
    # the digest of the whole row is its key: rows that share it are equal in all columns
    keyed = docs.withColumn(_ROW, F.unhex(F.sha2(F.to_json(F.struct(*names), _JSON), 256)))
    rows = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(_ROW).alias("_row"), F.coalesce("text", F.lit("")).alias("text"))
    fps = spill(map_batches(rows, lambda: lambda b: (b.column(0), b.column(1), [fingerprint(t) for t in raw_texts(b)]), "doc_id long, _row binary, fp long"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first")
    one = fps.groupBy("fp").agg(first).join(_rooted(fps), "fp")
    kept = spill(one.groupBy("root").agg(F.min("first").alias("first")).select("first._row"))
    # rows that repeat meet in each task before the shuffle, so that no key brings many
    return keyed.dropDuplicates([_ROW]).join(kept.withColumnRenamed("_row", _ROW), _ROW, "left_semi").select(names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
