"""Rows without ids, rows that share one id, times of microseconds and names of any characters."""

from datetime import datetime

import pytest

pytest.importorskip("xxhash")

from stratavox.llm import licenses, pii, quality, simhash, toxicity

SCHEMA = "doc_id long, text string"
PLAIN = "one plain line about walking along the river in the early morning of a quiet day"


def test_trusted_counts_with_null_and_shared_ids(spark):
    import numpy as np

    texts = [f"{PLAIN} number {k} and {k * k}" for k in range(40)]
    data = [(None, t) for t in texts] + [(7, t) for t in texts] + [(k, t) for k, t in enumerate(texts[:5])] + [(3, None)]
    docs = spark.createDataFrame(data, SCHEMA)
    trusted = spark.createDataFrame([(7,), (2,), (2,), (None,), (99,)], "doc_id long")
    both = np.zeros((2, 1 << quality.BITS))
    for i, t in data:
        if t is not None:
            at = quality._grams(quality._hashes(t.encode().split()))
            np.add.at(both[0], at, 1)
            if i in (7, 2):
                np.add.at(both[1], at, 1)
    share = both[1].sum() / both[0].sum()
    want = np.log(both[1] + quality.SMOOTHING) - np.log(both[0] * share + quality.SMOOTHING)
    assert np.allclose(quality.log_ratio(docs, trusted), want)
    assert not quality.log_ratio(docs, trusted.filter("doc_id IS NULL")).any()


def test_licenses_of_rows_without_ids(spark):
    label, text = next((n, t) for n, t in licenses.TEMPLATES if len(t.split()) > 20)
    data = [(None, text)] * 1500 + [(None, PLAIN)] * 200 + [(1, text), (1, PLAIN)]
    got = [tuple(r) for r in licenses.scan(spark.createDataFrame(data, SCHEMA)).groupBy("doc_id", "labels").count().collect()]
    assert len(got) == 4 and sum(n for *_, n in got) == len(data)
    assert {(i, n) for i, x, n in got if label in x.split(",")} == {(None, 1500), (1, 1)}


def test_one_large_component_is_named(spark):
    """More than a thousandth of the fingerprints are of one component."""
    fps = [0] + [1 << k for k in range(64)] + [(1 << 60) + (1 << k) for k in range(50)]
    rooted = simhash._rooted(spark.createDataFrame([(x - (1 << 64) if x >= 1 << 63 else x,) for x in fps], "fp long"))
    assert rooted.select("root").distinct().count() == 1 and rooted.count() == len(set(fps))
    docs = spark.createDataFrame([(k, "") for k in range(5)] + [(None, None)] + [(50, PLAIN), (40, PLAIN)], SCHEMA)
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(k, 0) for k in range(5)} | {(None, 0), (50, 40), (40, 40)}


def test_survivors_differ_in_microseconds(spark):
    """Rows of one id in two groups that differ but in text, and rows equal but for a microsecond: one stays of each group."""
    at = [datetime(2020, 1, 1, 0, 0, 0, k) for k in (1, 2)]
    other = "nothing at all in common with what stands in the first of these two rows of text"
    docs = spark.createDataFrame([(1, PLAIN, at[0]), (1, PLAIN, at[1]), (1, other, at[0])], f"{SCHEMA}, `odd ``name` timestamp")
    kept = simhash.keep_survivors(docs)
    assert kept.columns == docs.columns and sorted(r["text"] for r in kept.collect()) == sorted([PLAIN, other])


def test_names_with_backticks(spark):
    docs = spark.createDataFrame([(1, "write to ann.lee@mail.example.org now", 1, 2), (2, None, 3, 4)], "doc_id long, text string, `a``b` int, n_chars long")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "write to [EMAIL] now", 2: None}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 2
