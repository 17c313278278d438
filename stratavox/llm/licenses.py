"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A block is a window of the text's words, whatever its line breaks: ``span`` words long, which is twice the
template's length and MIN_SPAN at least. There is one from every template word on, so each run of ``span``
words is in a block whole. A block meets a template of its span when it holds at least ``threshold`` of the
template's distinct words; in a short template, where that can't tell one license from another, these must
include its marks (the words that name the license), or all its words if it has no marks. Words that no template of the span has can't count, so blocks keep template words
only; a window that another one holds, or with fewer words than any template of the span needs, is left out.
Words are ordered by their number of blocks over the whole corpus, rarest first. If a block and a template share ``need`` words,
then the first size - need + 1 words of each share one (prefix filter); a block of fewer than ``need`` words
can't meet it (length filter); and the words left behind the shared ones bound the overlap (position filter).
What passes is verified in full. All joins are on the span and the shared prefix word.
"""

from __future__ import annotations

from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hot_keys, join_unique, map_batches, raw_texts, read, spill, texts

#: phrase, label
PHRASES = ((b"cc by", "cc-by"), (b"general public license", "gpl"), (b"all rights reserved", "reserved"))
#: label, template text
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "Copyright. All rights reserved"),
)
THRESHOLD = 0.8
#: Templates of fewer different words need their marks, whatever else is there of them.
SHORT = 10
MARKS = frozenset(b"apache by cc gnu mit mozilla nc reserved sa".split())
#: Words that are ordinary ones too (mit is German for with): they count only right after, or right before, such words.
ORDINARY = {b"mit": (frozenset((b"released", b"under", b"the")), frozenset((b"license",)))}
#: Least words of a window, so that a short template may have a name or a year between its words.
MIN_SPAN = 12
#: Rows of template prefixes that may be broadcast.
MAX_BROADCAST = 100_000
_KEEP = bytes(c if c > 127 or 48 <= c < 58 or 97 <= c < 123 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    """Words of digits, letters a-z after lowering A-Z, and all beyond ASCII."""
    return raw.translate(_KEEP).split()


def templates(items=TEMPLATES, threshold: float = THRESHOLD) -> list[tuple[int, str, frozenset[bytes], int]]:
    """(number, label, words, words needed, whichever they are); a template without words is left out."""
    sets = [(k, label, frozenset(words_of(text.encode()))) for k, (label, text) in enumerate(items)]
    return [(k, label, w, len(w) if len(w) < SHORT else max(1, ceil(threshold * len(w) - 1e-9))) for k, label, w in sets if w]


def with_marks(found: list, threshold: float = THRESHOLD) -> list[tuple[int, str, frozenset[bytes], int, frozenset[bytes]]]:
    """(number, label, words, words needed, marks): fewer words than templates() says will do where marks are among them."""
    out = []
    for k, label, w, need in found:
        marks = w & MARKS if len(w) < SHORT else frozenset()
        out.append((k, label, w, max(len(marks), ceil(threshold * len(w) - 1e-9)) if marks else need, marks))
    return out


def stray_words(words: list[bytes]) -> list[int]:
    """Places of ORDINARY words that don't count."""
    out = []
    for word, (before, after) in ORDINARY.items():
        i = -1
        for _ in range(words.count(word)):
            i = words.index(word, i + 1)
            if not (i and words[i - 1] in before or words[i + 1 : i + 2] and words[i + 1] in after):
                out.append(i)
    return out


def spans(items=TEMPLATES) -> dict[int, int]:
    """The window's words for each template, by its number in templates()."""
    return {k: max(MIN_SPAN, 2 * len(words_of(text.encode()))) for k, (_, text) in enumerate(items)}


def windows(at: np.ndarray, token: np.ndarray, span: int, least: int, step: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the windows, as rows of at, that hold ``least`` different tokens and lie in no other window.

    at: ascending places of the words, token: their numbers.
    """
    end = np.searchsorted(at, at + span)
    first = np.flatnonzero((end - np.arange(len(at)) >= least) & np.r_[True, end[1:] > end[:-1]])
    order = np.argsort(token, kind="stable")
    again = token[order[1:]] == token[order[:-1]]
    before = np.full(len(at), -1)  # the row that has the same token before
    before[order[1:][again]] = order[:-1][again]
    keep = []
    for k in range(0, len(first), step):
        lo = first[k : k + step]
        n = end[lo] - lo
        start = np.cumsum(n) - n
        rows = np.arange(n.sum()) - np.repeat(start - lo, n)
        keep.append(np.add.reduceat(before[rows] < np.repeat(lo, n), start, dtype=np.int64) >= least)
    first = first[np.concatenate(keep)] if keep else first
    return first, end[first]


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a phrase."""
    line = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in PHRASES:
        at, n, done = line.find(b" " + phrase + b" "), 0, 0
        while at >= 0:
            n, done = n + line.count(b" ", done, at), at  # words are counted on from the place before
            out.append((n, label))
            at = line.find(b" " + phrase + b" ", at + 1)
    return out


def _scanner(vocabulary: dict[bytes, int], classes: list[tuple[int, int, np.ndarray]]):
    """classes: (span, least words that a template of the span needs, which words are in such templates)."""
    gap = max((span for span, *_ in classes), default=0)  # between texts, so that no window holds words of two

    def each(b: pa.RecordBatch) -> tuple:
        rows, at, token, start = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
        begin = 0
        for raw in raw_texts(b):
            words = raw.translate(_KEEP).split()
            places = phrase_places(words)
            number = np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int64, len(words))
            number[stray_words(words)] = -1
            hit = np.flatnonzero(number >= 0)
            at.append(hit + begin)
            token.append(number[hit])
            start.append(begin)
            begin += len(words) + gap
            starts = [p for p, _ in places]
            rows.append((len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))))
        at, token = np.concatenate(at), np.concatenate(token)
        blocks = [set() for _ in rows]
        for span, least, own in classes:
            mine = own[token]
            where, what = at[mine], token[mine]
            first, end = windows(where, what, span, least)
            for k, i, j in zip(np.searchsorted(start, where[first], "right") - 1, first, end, strict=True):
                blocks[k].add((span, tuple(sorted(set(what[i:j].tolist())))))
        return b.column(0), *zip(*rows, strict=True), [[{"span": n, "block": x} for n, x in sorted(found)] for found in blocks]

    return each


def least_words(found: list, span: dict[int, int]) -> dict[int, int]:
    """The least words needed by a template of each span."""
    out: dict[int, int] = {}
    for k, _, _, need, _ in found:
        out[span[k]] = min(need, out.get(span[k], need))
    return out


def met_templates(blocks: DataFrame, found: list, words: list[bytes], span: dict[int, int]) -> DataFrame:
    """(key, label, containment): the best containment by key and label over blocks that meet a template.

    A null or empty block meets none; blocks that repeat count once in the result; rows of a null key are grouped as
    one key; an empty table gives no rows. blocks: key (any type), span, block (array of word numbers, distinct). found: as with_marks() gives them;
    span: as spans() gives them.
    """
    spark = blocks.sparkSession
    number = {w: k for k, w in enumerate(words)}
    counted = blocks.select(F.explode("block").alias("w")).groupBy("w").count()
    often = {r["w"]: r["count"] for r in counted.collect()}  # at most a row for each template word
    order = sorted(range(len(words)), key=lambda k: (often.get(k, 0), words[k]))
    rank = {k: r for r, k in enumerate(order)}
    rows = []
    for k, label, w, need, marks in found:
        ranks, named = sorted(rank[number[x]] for x in w), sorted(rank[number[x]] for x in marks)
        rows += [(k, label, span[k], need, len(ranks), ranks, named, pos, t) for pos, t in enumerate(ranks[: len(ranks) - need + 1])]
    table = spark.createDataFrame(rows, "t int, label string, span int, need int, t_size int, t_ranks array<int>, marks array<int>, t_pos int, token int")
    least = F.create_map(*[F.lit(x) for pair in least_words(found, span).items() for x in pair])[F.col("span")]
    if len(rows) <= MAX_BROADCAST:  # the templates are a parameter; a very long list is joined by shuffle instead
        table = F.broadcast(table)
    as_rank = F.create_map(*[F.lit(x) for k in rank for x in (k, rank[k])])
    ranked = blocks.select("key", "span", F.array_sort(F.transform("block", lambda x: as_rank[x])).alias("ranks")).withColumn("size", F.size("ranks")).filter(F.col("size") >= least)
    heads = ranked.select("key", "span", "ranks", "size", F.posexplode(F.slice("ranks", F.lit(1), F.col("size") - least + 1)).alias("pos", "token"))
    near = heads.join(table, ["span", "token"]).filter(
        (F.col("size") >= F.col("need"))
        & (F.col("pos") <= F.col("size") - F.col("need"))
        & (F.least(F.col("pos"), F.col("t_pos")) + 1 + F.least(F.col("size") - F.col("pos"), F.col("t_size") - F.col("t_pos")) - 1 >= F.col("need"))
    )
    overlap = F.size(F.array_intersect("ranks", "t_ranks"))
    return near.withColumn("n", overlap).filter("n >= need AND size(array_except(marks, ranks)) = 0").groupBy("key", "label").agg(F.max(F.col("n") / F.col("t_size")).alias("containment"))


def scan(docs: DataFrame, items=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Phrase places, labels and score for every row of docs.

    score is the greatest containment of a template that is met, 1 where a phrase stands, else 0. Null and
    empty texts have no words and no labels; rows may repeat and ids may be null; an empty table gives no
    rows; other columns are ignored.
    """
    found = with_marks(templates(items, threshold), threshold)
    words = sorted(set().union(*(w for _, _, w, *_ in found))) if found else []
    vocabulary = {w: k for k, w in enumerate(words)}
    span = spans(items)
    classes = [(n, least, np.isin(words, sorted(set().union(*(w for k, _, w, *_ in found if span[k] == n))))) for n, least in least_words(found, span).items()]
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, blocks array<struct<span: int, block: array<int>>>"
    rows = spill(map_batches(texts(docs, id_col, text_col), lambda: _scanner(vocabulary, classes), schema))
    # rows of one id may have different texts: the key holds both
    rows = rows.withColumn("key", F.concat_ws(":", F.col("doc_id").cast("string"), F.hex(F.xxhash64("blocks"))))
    blocks = rows.select("key", F.inline("blocks")) if found else None
    base = rows.drop("blocks")
    if blocks is None:
        return base.drop("key").select("*", F.col("base_labels").alias("labels"), F.least(F.col("n_base"), F.lit(1)).cast("double").alias("score"))
    met = met_templates(blocks, found, words, span).groupBy("key").agg(F.collect_set("label").alias("more"), F.max("containment").alias("most"))
    # rows without an id and with equal blocks share a key; it may be that of most rows
    out = join_unique(base, spill(met), hot_keys(base, ["key"], base.count()), ["key"], "left")
    own = F.filter(F.split("base_labels", ","), lambda x: x != "")
    labels = F.array_join(F.array_sort(F.array_distinct(F.concat(own, F.coalesce("more", F.array().cast("array<string>"))))), ",")
    score = F.greatest(F.coalesce("most", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", labels.alias("labels"), score.alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
