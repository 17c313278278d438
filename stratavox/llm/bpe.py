"""Byte-level BPE by merge replay over distinct words.

A text falls into pre-tokens, and equal pre-tokens get equal ids, so merges are replayed over distinct
words, not over texts. An inverted index maps each token pair to the words and positions where it stands;
merges are applied in rank order, each to all its places at once, and only the pairs beside a merge change
in the index. Every task replays the distinct new words of its own part of the corpus, batch by batch, and
keeps them for the next batch: no occurrence of a word is shuffled.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import map_batches, plain_classes, read, texts

#: Pre-tokens up to so many characters are remembered, in so many bytes at most (about); places of a rank that are taken as arrays.
WORD_CHARS, MEMORY_BYTES, MANY = 48, 320 << 20, 48


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def load_ranks(path: str) -> dict[bytes, int]:
    from base64 import b64decode

    with open(path, "rb") as f:
        return {b64decode(a): int(b) for a, b in map(bytes.split, f)}


WIDTH = 20  # bits of an id in a pair's key


class Merges:
    """The merges of a rank file: a pair's rank is the id of the token that it makes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.pairs: dict[int, int] = {}
        for token, i in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    self.pairs[a << WIDTH | b] = i
        self.splits: dict[int, list[int]] = {}
        for key, i in self.pairs.items():
            self.splits.setdefault(i, []).append(key)
        #: tokens that have a part in a token of lower rank than their own
        self.odd = {part for key, i in self.pairs.items() for part in (key >> WIDTH, key & (1 << WIDTH) - 1) if i < part}
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.made = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)
        self.single = np.array([ranks[bytes([k])] for k in range(256)], np.int64)
        self.double = np.full(1 << 16, -1, np.int64)
        for a in range(256):
            for b in range(256):
                self.double[a << 8 | b] = ranks.get(bytes([a, b]), -1)


def replay(words: list[bytes], merges: Merges) -> list[list[int]]:
    """Ids of each word; equal to merging, in each word, the pair of least rank first.

    The symbols of all words lie in one list; nxt and prv link those that are left. ``where`` is the inverted
    index: rank -> left places of its pairs. A rank is taken once for all words; each of its places is merged if
    the pair still stands there, and the two pairs beside it are entered. A rank with many places is taken as
    arrays, one with few in a loop. A word that is a token stays one.
    """
    ids: list[list[int]] = [[i] if (i := merges.ranks.get(w)) is not None else [] for w in words]
    todo = [k for k, w in enumerate(words) if w and not ids[k]]
    if not todo:
        return ids
    raw = np.frombuffer(b"".join(words[k] for k in todo), np.uint8).astype(np.int64)
    n = len(raw)
    size = np.fromiter((len(words[k]) for k in todo), np.int64, len(todo))
    last = np.cumsum(size) - 1
    first = last - size + 1
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[last], before[first] = -1, -1
    rank = np.append(merges.double[raw[:-1] << 8 | raw[1:]], -1)
    rank[last] = -1
    place = np.flatnonzero(rank >= 0)
    place = place[np.argsort(rank[place], kind="stable")]
    ranks, cut = np.unique(rank[place], return_index=True)
    ends = [*cut[1:].tolist(), len(place)]
    places_ = place.tolist()
    where = {r: places_[a:b] for r, a, b in zip(ranks.tolist(), cut.tolist(), ends, strict=True)}
    sym, nxt, prv = (array("q", x.tobytes()) for x in (merges.single[raw], after, before))
    S, N, V = (np.frombuffer(x, np.int64) for x in (sym, nxt, prv))  # the same memory
    get = merges.pairs.get

    def at_once(m: int, places: list[int]) -> list[int] | None:
        """Merges all places of m and enters the new pairs; the places that are left if some overlap."""
        p = np.unique(np.array(places))
        q = N[p]
        live = (q >= 0) & (S[p] >= 0)
        p, q = p[live], q[live]
        live = np.isin(S[p] << WIDTH | S[q], merges.splits[m])
        p, q = p[live], q[live]
        if np.isin(q, p).any():
            return p.tolist()
        r = N[q]
        S[p], S[q], N[p] = m, -1, r
        has = r >= 0
        V[r[has]] = p[has]
        o = V[p]
        o = o[o >= 0]
        key = np.concatenate([m << WIDTH | S[r[has]], S[o] << WIDTH | m])
        spot = np.concatenate([p[has], o])
        k = np.minimum(np.searchsorted(merges.keys, key), len(merges.keys) - 1)
        hit = merges.keys[k] == key
        x, spot = merges.made[k[hit]], spot[hit]
        if not len(x):
            return None
        order = np.argsort(x, kind="stable")
        found, cut = np.unique(x[order], return_index=True)
        spot_ = spot[order].tolist()
        for y, a, b in zip(found.tolist(), cut.tolist(), [*cut[1:].tolist(), len(spot_)], strict=True):
            if y in where:
                where[y].extend(spot_[a:b])
            else:
                where[y] = spot_[a:b]
                heappush(heap, y)
        return None

    heap = list(where)  # sorted, so a heap
    while heap:
        m = heappop(heap)
        places = where.pop(m)
        if len(places) >= MANY and m not in merges.odd:
            places = at_once(m, places)
            if places is None:
                continue
        places.sort()  # overlapping places of one pair merge from the left
        for k, p in enumerate(places):
            if heap and heap[0] < m:  # a merge made a pair of lower rank: that one comes first
                where[m] = places[k:]
                heappush(heap, m)
                break
            q = nxt[p]
            if q < 0 or sym[p] < 0 or get(sym[p] << WIDTH | sym[q]) != m:
                continue
            r, o = nxt[q], prv[p]
            sym[p], sym[q], nxt[p] = m, -1, r
            if r >= 0:
                prv[r] = p
                x = get(m << WIDTH | sym[r])
                if x is not None:
                    if x in where:
                        where[x].append(p)
                    else:
                        where[x] = [p]
                        heappush(heap, x)
            if o >= 0:
                x = get(sym[o] << WIDTH | m)
                if x is not None:
                    if x in where:
                        where[x].append(o)
                    else:
                        where[x] = [o]
                        heappush(heap, x)
    for k, p in zip(todo, first.tolist(), strict=True):
        out = ids[k]
        while p >= 0:
            out.append(sym[p])
            p = nxt[p]
    return ids


class Codec:
    """Encodes texts to decimal ids and back to bytes, remembering pre-tokens.

    In plain text the same pre-tokens are found by a pattern with its character classes written out.
    """

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        self.merges = Merges(load_ranks(path))
        self.token = {i: t for t, i in self.merges.ranks.items()}
        self.pattern = regex.compile(pattern)
        white, letters, digits, self.odd = plain_classes()
        classes = (("[^\\s\\p{L}\\p{N}]", f"[^{white}{letters}{digits}]"), ("\\p{L}", f"[{letters}]"), ("\\p{N}", f"[{digits}]"), ("\\s", f"[{white}]"), ("\\S", f"[^{white}]"))
        for name, listed in classes:
            pattern = pattern.replace(name, listed)
        self.plain = re.compile(pattern)
        self.words: dict[str, tuple[str, bytes]] = {}
        self.size = 0

    def _learn(self, fresh: list[str]) -> None:
        token = self.token.__getitem__
        for w, ids in zip(fresh, replay([w.encode() for w in fresh], self.merges), strict=True):
            self.words[w] = " ".join(map(str, ids)), b"".join(map(token, ids))
            self.size += 300 + 12 * len(ids)

    def encode(self, texts_: list[str]) -> list[list[tuple[str, bytes]]]:
        """For each text its pre-tokens' (ids in decimal, decoded bytes)."""
        if self.size > MEMORY_BYTES:
            self.words.clear()
            self.size = 0
        parts = [(self.pattern if self.odd.search(t) else self.plain).findall(t) for t in texts_]
        if fresh := list(set().union(*parts) - self.words.keys()):
            self._learn(fresh)
        get = self.words.__getitem__
        out = [list(map(get, p)) for p in parts]
        for w in fresh:
            if len(w) > WORD_CHARS:
                del self.words[w]
        return out


def shares(text: list[str], size: int = 1 << 21) -> Iterator[list[str]]:
    """Runs of texts of about ``size`` characters, or of one text that is longer."""
    some, n = [], 0
    for t in text:
        some.append(t)
        n += len(t)
        if n >= size:
            yield some
            some, n = [], 0
    if some:
        yield some


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes they decode to, for every row of docs.

    Null and empty texts have no ids, and both digests are those of nothing; rows may repeat and ids may be
    null; an empty table gives no rows; other columns are ignored.
    """
    import public_tokenizers

    path, pattern = path or rank_file(), pattern or public_tokenizers.PATTERN

    def make():
        codec = Codec(path, pattern)

        def each(b: pa.RecordBatch) -> tuple:
            text, rows = b.column(1).to_pylist(), []
            for some in shares(text):
                for words in codec.encode(some):
                    ids, raw = zip(*words, strict=True) if words else ((), ())
                    ids = " ".join(ids)
                    rows.append((ids.count(" ") + bool(ids), sha256(ids.encode()).hexdigest(), sha256(b"".join(raw)).hexdigest()))
            return b.column(0), *zip(*rows, strict=True)

        return each

    return map_batches(texts(docs, id_col, text_col), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "documents"))
