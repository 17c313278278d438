"""Centroid clustering, mixing and hard negatives against plain loops, and their edge cases."""

import math
import random
from collections import defaultdict
from hashlib import md5, sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavox.llm import centroids, mixing, negatives

SCHEMA = "vec_id long, embedding array<float>, label int, cells binary, score double, cluster string, n long"
DOCS = "doc_id long, text string, source string, size string, n long, key int, row int"


def vectors(rng, n, dims=64, spread=1.0):
    base = rng.normal(size=(7, dims))
    return [(i, (base[i % 7] * 0.2 + rng.normal(size=dims) * spread * 0.2).astype(np.float32).tolist(), i % 5) for i in range(n)]


@pytest.fixture(scope="module")
def given():
    rng = np.random.default_rng(4)
    rows = vectors(rng, 300)
    rows += [(i, rows[50][1], 3) for i in range(300, 400)]  # one vector very often
    rows += [(50, rows[50][1], 3), (50, rows[7][1], 1), (100, rows[3][1], 2), (None, rows[4][1], 2), (None, rows[50][1], 3), (None, rows[50][1], 0)]
    rows += [(500, None, 1), (501, [None] + [0.5] * 63, 1), (502, [math.nan] * 64, 1), (503, [math.inf] + [0.0] * 63, 1), (504, [0.25] * 3, 1), (505, [], 1), (550, [0.5, 0.25, -1.0], 1)]
    rows += [(600, [0.0] * 64, 2), (601, [0.0] * 64, 3), (602, [-0.001] * 64, None), (650, [1e-4] * 64, 4), (350, [0.3] * 64, None)]
    rows += [(700, [0.5, 0.25, -1.0], 1), (701, [0.5, 0.25, -0.5], 2), (702, [0.5, 0.2, -0.5], 2)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, b"x", 0.5, "c", 7) for r in rows], SCHEMA).repartition(3)


def good(v, dims=None):
    return v is not None and (dims is None or len(v) == dims) and all(x is not None and math.isfinite(x) for x in v)


def ints(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain_clusters(rows, k, rounds):
    kept = [(i, ints(v)) for i, v, _ in rows if good(v, 64)]
    first = sorted((r for r in kept if r[0] is not None), key=lambda r: (sha256(f"2:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    first += sorted((r for r in kept if r[0] is None), key=lambda r: np.array(r[1], "<i4").tobytes())
    c = [list(r[1]) for r in first[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        met = defaultdict(list)
        for _, v in kept:
            met[near(v)[1]].append(v)
        for j, vs in met.items():
            c[j] = [sum(x) // len(vs) for x in zip(*vs)]
    at = [(i, *near(v)) for i, v in kept]
    size = defaultdict(int)
    for _, d, j in at:
        size[j] += d
    return sorted(((i, j, d, size[j], sum(size.values()), sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in at), key=repr)


def test_clusters_equal_plain_loops(spark, given):
    df = frame(spark, given)
    assert table(centroids.clustered(df, rounds=3)) == plain_clusters(given, 40, 3)
    assert table(centroids.clustered(df, k=4, rounds=2)) == plain_clusters(given, 4, 2)
    assert centroids.clustered(df).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_clusters_of_few_no_and_great_vectors(spark, given):
    few = given[:9] + given[-12:]
    assert table(centroids.clustered(frame(spark, few), rounds=2)) == plain_clusters(few, 40, 2)
    assert centroids.clustered(frame(spark, given).limit(0)).count() == 0
    great = [(i, [float((i * 37 + d) % 11 - 5) * 90_000 for d in range(64)], 0) for i in range(30)]
    assert table(centroids.clustered(frame(spark, great), k=5, rounds=2)) == plain_clusters(great, 5, 2)
    with pytest.raises(Exception, match="no exact distance"):
        centroids.clustered(frame(spark, [(1, [1e30] * 64, 0)])).collect()


def test_table_distances_are_exact():
    rng = np.random.default_rng(0)
    for top in (3, 500, centroids.LIMIT):
        x, c = rng.integers(-top, top, (50, 64)), rng.integers(-top, top, (7, 64))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, m)) for m in c] for v in x]
        assert centroids.distances(x.astype(np.int32), c).tolist() == want
    same = np.zeros((1, 64), np.int64)
    assert centroids.nearest(np.ones((3, 64), np.int32), np.r_[same, same])[0].tolist() == [0, 0, 0]


def plain_negatives(rows, every=50):
    kept = [(i, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab, ints(v)) for i, v, lab in rows if lab is not None and good(v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for k, (i, lab, v) in enumerate(kept):
        if i is None or i % every:
            continue
        met = [(dot(v, w), j, lab2 == lab) for m, (j, lab2, w) in enumerate(kept) if m != k and len(w) == len(v)]
        for p, pid, _ in sorted((r for r in met if r[2]), key=order)[:5]:
            fits = sorted((r for r in met if not r[2] and 50 * p <= 100 * r[0] <= 95 * p), key=order)[:3]
            out += [(i, pid, n, nid, p, s) for n, (s, nid, _) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def test_negatives_equal_plain_loops(spark, given, monkeypatch):
    df = frame(spark, given)
    want = plain_negatives(given)
    assert len(want) > 60 and table(negatives.mined(df)) == want
    monkeypatch.setattr(negatives, "CHUNK", 3)  # many chunks and lanes
    monkeypatch.setattr(negatives, "LANE", 40)
    assert table(negatives.mined(df)) == want
    assert table(negatives.mined(df, every=7)) == plain_negatives(given, 7)


def test_negatives_of_no_and_odd_rows(spark, given):
    assert negatives.mined(frame(spark, given).limit(0)).count() == 0
    assert negatives.mined(frame(spark, given[:40])).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    zero = [(50 * i, [0.0] * 4, i % 2) for i in range(6)]
    assert table(negatives.mined(frame(spark, zero))) == plain_negatives(zero)
    alone = [(50, [1.0, 2.0], 1), (51, [1.0, 2.0], 2)]
    assert negatives.mined(frame(spark, alone)).count() == 0


def rows_of(x, ids=None):
    r = object.__new__(negatives.Rows)
    r.n, r.x, r.norm = len(x), x, np.sqrt((x.astype(float) ** 2).sum(axis=1))
    return r


def test_bounds_hold_and_leave_windows_out():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(6, 16)) * 2000
    for spread in (0.0, 1.0, 60.0, 3000.0):
        x = np.concatenate([b + rng.normal(size=(64, 16)) * spread for b in base]).astype(np.int64)
        a, b = rows_of(x[::5]), rows_of(x)
        refs = [x[k].astype(float) for k in (0, 70, 200, 300)]
        a.angle, b.angle = (negatives.angles(r.x, refs).astype(float) for r in (a, b))
        start = np.arange(0, b.n, 64)
        lower, upper = negatives.bounds(a, b, start)
        s = a.x @ b.x.T
        assert (np.minimum.reduceat(s, start, axis=1) >= lower).all() and (np.maximum.reduceat(s, start, axis=1) <= upper).all()
        if spread == 60.0:
            assert (upper < 0.9 * s.max()).mean() > 0.5  # most windows cannot hold a great score


def corpus():
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([0, 3, 40, 900]))), rng.choice(["a", "b", "b", "b", "é", "Z", "z", None])) for i in range(150)]
    rows += [(200, "x " * 30_000, "b"), (201, None, "a"), (202, "\t\x0b \r", "only blank"), (203, "one", "tiny"), (204, " four five\u00a0six seven", "tiny2"), (3, rows[3][1], rows[3][2]), (3, "other text of it", "b"), (None, "no id at all", None), (None, "no id at all", None), (None, "no", None)]
    return rows


def words(text):
    out, inside = 0, False
    for c in text or "":
        space = c in " \t\n\v\f\r"
        out += not space and not inside
        inside = not space
    return out


def plain_targets(size):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + ([None] if None in size else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, stopped = 1.5 * sum(size.values()), set()
    while True:
        rest = total - sum(2 * size[s] for s in stopped)
        left = sum(weight[s] for s in names if s not in stopped)
        target = {s: 2.0 * size[s] if s in stopped else rest * weight[s] / left for s in names}
        over = {s for s in names if target[s] > 2 * size[s]}
        if not over:
            return target
        stopped |= over


def mixture(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, 2, 3) for i, t, s in rows], DOCS).repartition(3)


@pytest.mark.parametrize("block", [7, 1024])
def test_mixture_meets_its_targets(spark, block):
    rows = corpus()
    got = table(mixing.taken(mixture(spark, rows), block=block))
    assert got == table(mixing.taken(mixture(spark, rows).repartition(5), block=block))
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += words(t)
    target = plain_targets(size)
    assert sorted((r[0] if r[0] is not None else -1, r[1]) for r in got) == sorted((i if i is not None else -1, words(t)) for i, t, _ in rows)
    want = sorted((size[s], round(target[s], 6)) for _, _, s in rows)
    assert sorted((r[2], round(r[3], 6)) for r in got) == want
    taken = defaultdict(int)
    for _, n, whole, t, k in got:
        assert 0 <= k <= 2 * n
        taken[whole, t] += k
    assert all(k == math.floor(t + 0.5) for (_, t), k in taken.items())


def test_schedule_is_even_and_pieces_lie_end_to_end(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(0, 60), "abc"[min(i % 5, 2)]) for i in range(400)]
    sized = mixing.sized(mixture(spark, rows)).cache()
    plan = mixing.targets(sized).cache()
    share = {r["n"]: r["target"] for r in plan.collect()}
    total = sum(share.values())
    slots = defaultdict(list)
    for r in mixing.mixed(sized, plan, 16).orderBy("slot", "offset").collect():
        slots[r["slot"]].append(r)
    seen, done = defaultdict(int), 0
    for slot in sorted(slots):
        pieces = slots[slot]
        assert len({p["n"] for p in pieces}) == 1
        at = 0
        for p in pieces:  # a slot's pieces follow each other without a gap
            assert p["offset"] == at
            at += p["length"]
        assert at <= 16
        seen[pieces[0]["n"]] += at
        done += at
        if done > 1000:  # every stretch from the start holds the sources nearly by weight
            assert all(abs(seen[n] / done - share[n] / total) < 0.05 for n in share)
    k = defaultdict(list)
    for slot in sorted(slots):
        k[slots[slot][0]["n"]].append(slots[slot][0]["k"])
    assert all(v == list(range(len(v))) for v in k.values())


def test_mixture_of_no_words_and_no_rows(spark):
    empty = mixture(spark, corpus()).limit(0)
    assert mixing.taken(empty).count() == 0
    blank = [(1, "", "a"), (2, None, None), (3, " \n", "b")]
    assert table(mixing.taken(mixture(spark, blank))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0), (3, 0, 0, 0.0, 0)]
    one = [(1, "a b c", None)]
    assert table(mixing.taken(mixture(spark, one))) == [(1, 3, 3, 4.5, 5)]
    many = mixing.taken(mixture(spark, [(i, "a", f"s{i}") for i in range(300)])).collect()
    assert all(r["taken"] == math.floor(r["target"] + 0.5) for r in many) and len({r["target"] for r in many}) == 3


def test_van_der_corput_points(spark):
    got = [r[0] for r in spark.range(16).select(mixing.reversed_bits(F.col("id"), 4)).collect()]
    assert got == [int(f"{i:04b}"[::-1], 2) for i in range(16)]


def test_shuffle_order_is_by_digest(spark):
    rows = mixing.sized(mixture(spark, corpus())).collect()
    assert all(r["key"] == md5(f"{'' if r['doc_id'] is None else r['doc_id']}:{r['size']}".encode()).hexdigest() for r in rows)
