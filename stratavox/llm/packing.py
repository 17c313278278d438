"""Best-fit packing of tokenized documents by linear grouping.

Documents become token pieces of at most ``capacity``. Pieces are dealt evenly into shards of a bounded
number of pieces, and each shard is packed on its own, so the loss stays in proportion (a few sequences of some
thousands in a shard). Inside a shard, large pieces are sorted by length and cut into groups of equal
cardinality, each group rounded up to its longest; the fractional packing of the few rounded sizes is
approximated by multiplicative weights, each step adding the pattern of the greatest price (a knapsack), and the
patterns' amounts are rounded down; real pieces replace the rounded sizes, longest slots first; the large
pieces that no whole pattern took and then the small ones go by best fit into what is left.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from struct import pack as pack_ids
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, plain_classes, read, spill, texts

CAPACITY, SHARD_PIECES, GROUPS, LARGE = 4096, 20_000, 64, 4096 // 6
END = 1
#: Pre-tokens up to so many characters are remembered, in so many bytes at most (about; their ids and the table included).
WORD_CHARS, MEMORY_BYTES = 48, 160 << 20
#: Longer pre-tokens are left to the tokenizer, whose time doesn't grow with the square of the length.
LONG_PIECE = 400
_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_ranks(tok):
    """The tokenizer's merges as a function from a lower-case pre-token's bytes and 0xff to ids."""
    import tiktoken

    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in plain)}
    special = {t.content for t in tok.get_added_tokens_decoder().values()}
    ranks = {}
    for word, i in tok.get_vocab().items():
        if word not in special:
            end = word.endswith("</w>")
            ranks[bytes(byte[c] for c in (word[:-4] if end else word)) + b"\xff" * end] = i
    return tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece


def plain_tokens() -> re.Pattern:
    """The tokenizer's pre-tokens in plain lower-case text."""
    white, letters, digits, _ = plain_classes()
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{white}{letters}{digits}]+")


class Pieces(dict):
    """Pre-token -> its ids as little-endian uint32 bytes, found when first asked for."""

    def __init__(self, find) -> None:
        self.find, self.size = find, 0

    def __missing__(self, word: str) -> bytes:
        ids = self.find(word)
        if len(word) <= WORD_CHARS:
            self[word] = ids
            self.size += 200 + len(word) + len(ids)
        return ids

    def forget(self) -> None:
        self.clear()
        self.size = 0


def encoder(vocab: str):
    """A function from a text to its ids as little-endian uint32 bytes.

    The tokenizer lowers letters, drops white space, cuts at it and between classes of characters, and merges in each
    pre-token alone. In a plain text the pre-tokens are found by the same pattern, and each different one is merged
    once, its bytes by the vocabulary's ranks (0xff for the end of a word). In other texts this holds for the plain
    ones of the blank-separated words, and the rest go to the tokenizer; a text that spells a special token goes there
    whole.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocab)
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    merges = byte_ranks(tok)
    odd, tokens = plain_classes()[3], plain_tokens()

    def whole(text: str) -> bytes:
        ids = tok.encode(text, add_special_tokens=False).ids
        return pack_ids(f"<{len(ids)}I", *ids)

    def merged(word: str) -> bytes:
        if len(word) > LONG_PIECE:
            return whole(word)
        ids = merges(word.encode() + b"\xff")
        return pack_ids(f"<{len(ids)}I", *ids)

    known = Pieces(merged)
    strange = Pieces(whole)  # words with other characters

    def encode(text: str) -> bytes:
        if known.size + strange.size > MEMORY_BYTES:
            known.forget()
            strange.forget()
        if any(s in text for s in special):
            return whole(text)
        if not odd.search(text):
            return b"".join(map(known.__getitem__, tokens.findall(text.lower())))
        return b"".join([strange[w] if odd.search(w) else b"".join(map(known.__getitem__, tokens.findall(w.lower()))) for w in text.split(" ")])

    return encode


def pieces(docs: DataFrame, vocab: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for every row of docs.

    A null or empty text is one piece of the end id; rows that repeat have pieces each; null ids stay; an empty table
    gives no rows; other columns are ignored.
    """

    def make():
        encode, end = encoder(vocab), pack_ids("<I", END)

        def each(b):
            out = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                e = memoryview(encode(text.as_py()) + end)
                for p, at in enumerate(range(0, len(e) // 4, capacity)):
                    part = e[4 * at : 4 * (at + capacity)]
                    out.append((i, p, at, len(part) // 4, crc32(part)))
            return zip(*out, strict=True)

        return each

    return map_batches(texts(docs, id_col, text_col), make, _SCHEMA)


def _patterns(size: list[int], need: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns of the sizes, with weights, that cover ``need`` at nearly the fewest sequences.

    Multiplicative weights: the price of a size falls as patterns cover it; each step takes the pattern
    of the greatest price, an unbounded knapsack over the few sizes.
    """
    k = len(size)
    price = np.array(size, float) / capacity
    used: dict[tuple, float] = defaultdict(float)
    covered = np.zeros(k)
    steps = 40 * k
    for _ in range(steps):
        best, back = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for g in range(k):
            s = size[g]
            for m in range(1, capacity // s + 1):  # at most a handful, as only large pieces come here
                lo, hi = m * s, min(capacity, (m + 1) * s - 1)
                cand = best[lo - s : hi - s + 1] + price[g]
                better = cand > best[lo : hi + 1] + 1e-12
                best[lo : hi + 1][better] = cand[better]
                back[lo : hi + 1][better] = g
        c, pat = int(best.argmax()), np.zeros(k)
        while back[c] >= 0:
            pat[back[c]] += 1
            c -= size[back[c]]
        if not pat.any():
            break
        amount = max(1.0, float(np.min(need[pat > 0] / pat[pat > 0])) / 8)
        used[tuple(pat)] += amount
        covered += amount * pat
        price *= np.exp(-0.5 * amount * pat / np.maximum(need, 1))
        if (covered >= need).all():
            break
    return [(np.array(p, int), n) for p, n in used.items()]


def pack(lengths: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS, large: int = LARGE) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) for each length; sequences from 0, gapless offsets."""
    n = len(lengths)
    seq, room, free = np.full(n, -1), [], defaultdict(list)
    big = np.flatnonzero(lengths > large)
    big = big[np.argsort(-lengths[big], kind="stable")]

    def put(item: int, bin_: int) -> None:
        seq[item] = bin_
        room[bin_] -= int(lengths[item])

    alone = big[lengths[big] > capacity - 1]
    for i in alone:
        room.append(capacity)
        put(i, len(room) - 1)
    big = big[len(alone) :]
    if len(big):
        cuts = [x for x in np.array_split(big, min(groups, len(big))) if len(x)]
        by_size: dict[int, list[int]] = {}
        for x in cuts:  # equal cardinality; groups that round up to one size join
            by_size.setdefault(int(lengths[x[0]]), []).extend(x.tolist())
        size, queues = list(by_size), list(by_size.values())
        need = np.array([len(q) for q in queues], float)
        taken = [0] * len(size)
        for pat, amount in sorted(_patterns(size, need, capacity), key=lambda x: (-float(x[0] @ np.array(size)), -x[1])):
            for _ in range(int(amount)):
                if any(taken[g] + pat[g] > len(queues[g]) for g in np.flatnonzero(pat)):
                    break
                room.append(capacity)
                for g in np.flatnonzero(pat):
                    for _ in range(pat[g]):
                        put(queues[g][taken[g]], len(room) - 1)
                        taken[g] += 1
        rest = [i for g, q in enumerate(queues) for i in q[taken[g] :]]
    else:
        rest = []
    # best fit, longest first, for the large pieces that no whole pattern took and for all small ones
    mask = 0
    for b, r in enumerate(room):
        if r:
            free[r].append(b)
            mask |= 1 << r
    small = np.flatnonzero((lengths <= large))
    order = sorted(rest, key=lambda i: -lengths[i]) + small[np.argsort(-lengths[small], kind="stable")].tolist()
    for i in order:
        s = int(lengths[i])
        fits = mask >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = free[r].pop()
            if not free[r]:
                mask ^= 1 << r
        else:
            b = len(room)
            room.append(capacity)
        put(i, b)
        if r := room[b]:
            free[r].append(b)
            mask |= 1 << r
    offset = np.zeros(n, np.int64)
    by = np.argsort(seq, kind="stable")
    total = np.cumsum(lengths[by])
    first = np.r_[True, seq[by][1:] != seq[by][:-1]]
    before = total - lengths[by]
    offset[by] = before - np.maximum.accumulate(np.where(first, before, 0))
    return seq, offset


def pack_pieces(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """found, a written table of pieces() columns, and sequence_id, offset.

    Rows that repeat are pieces of their own; null ids stay; an empty table gives no rows; no other columns come out.
    """
    shards = max(1, math.ceil(found.count() / SHARD_PIECES))
    # the row's number spreads rows that are equal in all columns; found is a written table, so it is stable
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards)).cast("long"))

    def one(pdf):
        pdf = pdf.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        seq, offset = pack(pdf["length"].to_numpy(np.int64), capacity)
        pdf["sequence_id"] = seq + (pdf["shard"].iloc[0] << 32)
        pdf["offset"] = offset
        return pdf.drop(columns="shard")

    return dealt.groupBy("shard").applyInPandas(one, f"{_SCHEMA}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocab: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every row of docs with their place in a sequence.

    A null or empty text is the end id alone, one piece of length 1. Rows of equal id or text are packed
    each; a null doc_id stays null. An empty table gives no rows. Other columns are ignored. Only texts
    longer than ``capacity`` are cut.
    """
    return pack_pieces(spill(pieces(docs, vocab or vocabulary(), capacity)), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
