"""Quality rules: counted base rules and a hashed n-gram log-likelihood ratio.

Word 1- and 2-grams are hashed into ``buckets``. Two multinomials over the buckets are counted from all
documents: the raw corpus, and the trusted target, which is every document that labels mark as good. A
document's score is the mean over its n-grams of log p_target - log p_raw, so length cancels out; a
document is kept at or above a fixed threshold, never by a draw.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hot_keys, join_unique, map_batches, raw_texts, read

BITS, SMOOTHING, THRESHOLD = 16, 6.0, -0.2
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TAIL = bytes(range(0x80, 0xC0))
_SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"


def _hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def _grams(h: np.ndarray) -> np.ndarray:
    """Buckets of the 1-grams, then of the 2-grams."""
    return (np.r_[h, h[:-1] * _ODD + h[1:]] >> np.uint64(64 - BITS)).astype(np.int64)


def _repeated(h: np.ndarray, width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    n = len(h)
    if n <= width:
        return 0
    win = h[: n - width + 1].copy()
    for k in range(1, width):
        win = win * _ODD + h[k : n - width + 1 + k]
    s = np.sort(win)
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    at = np.flatnonzero(np.isin(win, s[1:][same]))
    cover = np.zeros(n + 1, np.int64)
    cover[at] += 1
    cover[at + width] -= 1
    return int((np.cumsum(cover) > 0).sum())


def _counter():
    size = 1 << BITS

    def each(b: pa.RecordBatch) -> tuple:
        good = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
        sums = np.zeros((2, size), np.int64)
        for which in (False, True):
            held, n = [], 0
            for t, g in zip(raw_texts(b), good, strict=True):
                if g == which:
                    held.append(_grams(_hashes(t.split())))
                    n += len(held[-1])
                    if n > 2_000_000:
                        sums[int(which)] += np.bincount(np.concatenate(held), minlength=size)
                        held, n = [], 0
            if held:
                sums[int(which)] += np.bincount(np.concatenate(held), minlength=size)
        used = np.flatnonzero(sums.any(axis=0))
        return used, sums.sum(axis=0)[used], sums[1][used]

    return each


def log_ratio(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """log p_target - log p_raw for each bucket; zeros where no document is trusted.

    trusted: ids, in a column named as id_col, of the target's documents; repeats and nulls are ignored.
    The result has as many numbers as buckets, whatever the corpus.
    """
    ids = trusted.select(F.col(id_col).cast("long").alias("doc_id"), F.lit(True).alias("good")).filter("doc_id IS NOT NULL").distinct()
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).filter("text IS NOT NULL")
    named = rows.filter("doc_id IS NOT NULL")
    # a shuffled join at every size, as the trusted ids grow with the corpus; rows without an id stay where they are
    marked = join_unique(named, ids, hot_keys(rows, ["doc_id"], rows.count()).filter("doc_id IS NOT NULL"), ["doc_id"], "left")
    marked = marked.select("text", F.coalesce("good", F.lit(False)).alias("good")).unionByName(rows.filter("doc_id IS NULL").select("text", F.lit(False).alias("good")))
    parts = map_batches(marked, _counter, "bucket long, raw long, target long")
    total = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    both = np.zeros((2, 1 << BITS))
    both[:, total["bucket"].to_numpy(np.int64)] = total[["raw", "target"]].to_numpy(float).T
    if not both[1].any():
        return np.zeros(1 << BITS)
    # smoothing in proportion to the two sizes: a bucket that the target should hold but a few times says little
    share = both[1].sum() / both[0].sum()
    return np.log(both[1] + SMOOTHING) - np.log(both[0] * share + SMOOTHING)


def judge(raw: bytes, ratio: np.ndarray, threshold: float) -> tuple:
    words = raw.split()
    n, joined = len(words), b"".join(words)
    h = _hashes(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = _repeated(h)
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    score = float(ratio[_grams(h)].mean()) if n else 0.0
    return n, len(joined.translate(None, _TAIL)), len(raw) - len(raw.translate(None, b"#*$%&|<>")), len(lines) - len(set(lines)), repeated, failed, not failed and score >= threshold, score


def verdicts(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: the counts, base_failed, kept and score.

    Null and empty texts have no words and fail the base rules; null ids stay null; repeated rows get equal
    rows; an empty table gives none; without trusted documents every score is 0. Other columns are ignored.
    """
    ratio = log_ratio(docs, trusted, id_col, text_col)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return map_batches(rows, lambda: lambda b: (b.column(0), *zip(*[judge(t, ratio, threshold) for t in raw_texts(b)], strict=True)), _SCHEMA)


def keep_good(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are kept, all columns as they are.

    Null and empty texts fail the base rules and go; rows that repeat stay or go together; null ids are judged like
    others; an empty table gives no rows; columns of any name pass through.
    """
    ratio = log_ratio(docs, trusted)

    @F.pandas_udf("boolean")
    def good(t):
        import pandas as pd

        return pd.Series([judge((x or "").encode(), ratio, threshold)[6] for x in t], dtype=bool)

    return docs.filter(good(docs["text"]))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(read(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))
