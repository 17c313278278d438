"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned: words, and first bytes of words, whose document frequency among toxic training texts is far above that among
the others. Features of a training text use a lexicon counted without its own fold, so that chance words
earn no trust. The trees and the calibration see different rows. Training takes at most ``max_train``
labelled rows (the first by a hash of their id), once per distinct text, toxic if any of its rows is; scoring
takes every row. The lexicon has all words beyond the least count and weight, as many as the labelled rows give.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, quoted, read, spill, texts

MAX_TRAIN, FOLDS, NEAR, STEM = 20_000, 3, 5, 4
#: Labelled rows (two numbers each) that may be broadcast.
MAX_BROADCAST = 1_000_000
MIN_TOXIC, MIN_WEIGHT = 3, 2.0
#: Second-person words of the corpus' languages.
SECOND_PERSON = frozenset(b"you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos ti tus usted ustedes vosotros".split())
_KEEP = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_UPPER, _PUNCT, _ALPHA = (bytes(c for c in range(128) if f(chr(c))) for f in (str.isupper, lambda x: not x.isalnum() and not x.isspace() and x.isprintable(), str.isalpha))
_LEET = bytes.maketrans(b"013457@$!|", b"oieastasil")
_MIXED = re.compile(rb"[A-Za-z]+(?:[0-9@$*!|._-]+[A-Za-z]+)+")
_LONG = re.compile(rb"([A-Za-z])\1\1")
N_FEATURES = 14


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_KEEP).split()


def keys_of(text: str) -> set[bytes]:
    """What the lexicon is counted over: a text's words, and the stems of its longer words."""
    words = set(words_of(text))
    return words | {b"^" + w[:STEM] for w in words if len(w) > STEM + 1}


class Lexicon(dict):
    """Weights of words; stems has those of first bytes."""

    def __init__(self, weights: dict[bytes, float]) -> None:
        super().__init__((w, s) for w, s in weights.items() if w[:1] != b"^")
        self.stems = {w[1:]: s for w, s in weights.items() if w[:1] == b"^"}


def masked(lexicon: Lexicon) -> dict[bytes, float]:
    """The lexicon's words with each one letter starred."""
    return {w[:k] + b"*" + w[k + 1 :]: s for w, s in lexicon.items() if len(w) > 3 for k in range(1, len(w))}


def features(text: str, lexicon: Lexicon, stars: dict[bytes, float], second: frozenset) -> list[float]:
    raw = text.encode()
    words = words_of(text)
    n, size = max(len(words), 1), max(len(raw), 1)
    stems = lexicon.stems
    seen = [i for i, w in enumerate(words) if w in lexicon or w[:STEM] in stems or len(w) == 1]
    hits = [i for i in seen if words[i] in lexicon or words[i][:STEM] in stems]
    hidden, mixed = [], _MIXED.findall(raw)
    for m in mixed:
        plain = m.lower()
        bare = plain.translate(_LEET, b"*._-")
        hidden += [lexicon[bare]] if bare in lexicon else [stars[plain]] if plain in stars else []
    run: list[int] = []
    spelled = 0
    for i in [*(i for i in seen if len(words[i]) == 1), -9]:  # letters spaced or dotted out
        if run and i != run[-1] + 1:
            if len(run) > 2:
                spelled += 1
                w = b"".join(words[k] for k in run)
                hidden += [lexicon[w]] if w in lexicon else []
            run = []
        run.append(i)
    near = sum(any(w in second for w in words[max(0, i - NEAR) : i + NEAR + 1]) for i in hits)
    weights = [lexicon.get(words[i]) or stems[words[i][:STEM]] for i in hits] + hidden
    punct = len(raw) - len(raw.translate(None, _PUNCT))
    letters = max(size - len(raw.translate(None, _ALPHA)), 1)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    return [
        len(hits) / n,
        sum(weights) / n,
        log(1 + len(weights)),
        float(len({words[i] for i in hits})),
        max(weights, default=0.0),
        near / n,
        near / max(len(hits), 1),
        sum(w in second for w in words) / n if hits else 0.0,
        upper / letters,
        punct / size,
        raw.count(b"!") / n,
        (len(mixed) + spelled) / n,
        len(hidden) / n,
        len(_LONG.findall(raw)) / n,
    ]


def _weights(rows: list[tuple], total: list[int], toxic: list[int], without: int | None) -> dict[bytes, float]:
    """Log-odds of words, counted over all folds but one."""
    use = [k for k in range(FOLDS) if k != without]
    t, o = sum(toxic[k] for k in use), sum(total[k] - toxic[k] for k in use)
    out = {}
    for w, a, b in rows:
        x, y = sum(a[k] for k in use), sum(b[k] for k in use)
        s = log((x + 0.5) / (t + 1)) - log((y + 0.5) / (o + 1))
        if x >= (MIN_TOXIC if without is None else 2) and s >= MIN_WEIGHT:
            out[w.encode("latin-1")] = s
    return out


class Model:
    """Lexicon, trees and calibration; or one constant score where the labels have but one class."""

    def __init__(self, weights: dict, trees, calibration, constant: float | None) -> None:
        self.weights, self.trees, self.calibration, self.constant = weights, trees, calibration, constant

    def score(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """rows' columns ``keep`` and score; rows has a string column text without nulls."""
        if self.constant is not None:
            return rows.select(*keep, F.lit(self.constant).alias("score"))
        weights = self.weights

        def dense(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            lexicon = Lexicon(weights)
            stars = masked(lexicon)
            for t in parts:
                yield pd.Series([features(x, lexicon, stars, SECOND_PERSON) for x in t])

        dense = F.pandas_udf(dense, "array<double>")
        return self._calibrated(rows.select(*keep, array_to_vector(dense("text")).alias("features"))).select(*keep, "score")

    def _calibrated(self, rows: DataFrame) -> DataFrame:
        p = self.trees.transform(rows).withColumn("p", vector_to_array("probability")[1])
        return self.calibration.transform(p).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated")))) if self.calibration else p.withColumn("score", F.col("p"))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Learn from labels (doc_id, toxic) of docs outside the held-out fifth; at most max_train rows.

    Null labels, ids without a document and repeated rows are left out.
    """
    spark = docs.sparkSession
    usable = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("toxic").cast("int").alias("toxic")).dropna().filter(F.crc32(F.col("l_id").cast("string")) % 5 != 0)
    usable = usable.groupBy("l_id").agg(F.max("toxic").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("l_id"), "l_id").limit(max_train)
    rows = texts(docs)
    rows = rows.join(F.broadcast(chosen) if max_train <= MAX_BROADCAST else chosen, rows["doc_id"] == chosen["l_id"])
    h = F.xxhash64("text", F.lit("fold"))
    train = spill(rows.groupBy("text").agg(F.max("toxic").alias("toxic")).select("text", "toxic", F.pmod(h, F.lit(FOLDS)).cast("int").alias("fold"), (F.pmod(F.shiftright(h, 20), F.lit(4)) == 0).alias("calibrate")))

    sizes = {(r["fold"], r["toxic"]): r["count"] for r in train.groupBy("fold", "toxic").count().collect()}
    toxic = [sizes.get((k, 1), 0) for k in range(FOLDS)]
    total = [toxic[k] + sizes.get((k, 0), 0) for k in range(FOLDS)]
    if sum(toxic) in (0, sum(total)):
        return Model({}, None, None, sum(toxic) / sum(total) if sum(total) else 0.0)

    bags = map_batches(train, lambda: lambda b: ([[w.decode("latin-1") for w in sorted(keys_of(t))] for t in b.column(0).to_pylist()], b.column(1), b.column(2)), "words array<string>, toxic int, fold int")
    counts = bags.select(F.explode("words").alias("w"), "toxic", "fold").groupBy("w")
    by = lambda k, t: F.count_if((F.col("fold") == k) & (F.col("toxic") == t))
    counts = counts.agg(F.array(*[by(k, 1) for k in range(FOLDS)]).alias("a"), F.array(*[by(k, 0) for k in range(FOLDS)]).alias("b"), F.count_if(F.col("toxic") == 1).alias("x"), F.count_if(F.col("toxic") == 0).alias("y"))
    odds = F.log((F.col("x") + 0.5) / (sum(toxic) + 1)) - F.log((F.col("y") + 0.5) / (sum(total) - sum(toxic) + 1))
    best = counts.withColumn("s", odds).filter((F.col("x") >= MIN_TOXIC) & (F.col("s") >= MIN_WEIGHT))
    rows = sorted((r["w"], r["a"], r["b"]) for r in best.collect())  # of at most max_train rows' words
    weights, folds = _weights(rows, total, toxic, None), [_weights(rows, total, toxic, k) for k in range(FOLDS)]

    def make():
        folded = [Lexicon(x) for x in folds]
        stars = [masked(x) for x in folded]
        return lambda b: ([features(t, folded[k], stars[k], SECOND_PERSON) for t, k in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)], b.column(1), b.column(3))

    known = spill(map_batches(train, make, "f array<double>, toxic int, calibrate boolean"))
    known = known.select(array_to_vector("f").alias("features"), F.col("toxic").cast("double").alias("label"), "calibrate").cache()
    trees = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.3, minInstancesPerNode=2, seed=7).fit(known.filter("NOT calibrate") if known.filter("NOT calibrate").select("label").distinct().count() == 2 else known)
    calibration = None
    held = known.filter("calibrate")
    if held.select("label").distinct().count() == 2:
        # most rows have one of few probabilities: each counts once, with its weight
        p = trees.transform(held).groupBy("label", vector_to_array("probability")[1].alias("p")).agg(F.count("*").cast("double").alias("n"))
        calibration = IsotonicRegression(featuresCol="p", labelCol="label", weightCol="n", predictionCol="calibrated").fit(p)
    known.unpersist()
    return Model(weights, trees, calibration, None)


def scores(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs.

    Null and empty texts are scored like any text, from features that are all zero. A null doc_id is not
    held out. Repeated rows get equal rows. Without labels, or with labels of one class, the score is that
    class' share. Other columns are ignored.
    """
    model = fit(docs, labels, max_train)
    rows = model.score(texts(docs), ["doc_id"])
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of docs whose score is below one half, all columns as they are.

    Null and empty texts are scored as in scores(); repeated rows stay or go together; null ids stay; an empty table
    gives no rows; without toxic labels all rows stay. Columns of any name pass through, but docs must have doc_id
    and text.
    """
    model = fit(docs, labels, max_train)
    packed = docs.select(F.struct(*[docs[c] for c in quoted(docs.columns)]).alias("row"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return model.score(packed, ["row"]).filter("score < 0.5").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
