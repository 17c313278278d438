"""Personal data: exact base patterns, and spans added by a linear-chain CRF over word shapes.

The CRF is trained from a small labelled table and decoded by Viterbi in numpy batches. For most words the
score of "outside" beats every other label whatever stands around it: no best path then leaves "outside"
there, so such words split a text into independent short chains and only these are decoded. The bound is
checked for each word shape against the trained weights, not assumed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, quoted, read, texts
from .pii_table import LABELLED

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS, "secret")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_RUN = re.compile(r"(.)\1+")
_PAIRS = re.compile(r"(..)\1+")
_CLASSES = bytes(ord("d") if 48 <= c < 58 else ord("h") if 97 <= c < 103 else ord("x") if 103 <= c < 123 or c > 127 else ord("X") if 65 <= c < 91 else c for c in range(256))
#: Words and shapes that are remembered, each of at most so many bytes.
PLAIN_WORDS, WORD_BYTES = 150_000, 64
_SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
Span = tuple[int, int, int]  # start, place of the kind, end


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The base patterns' spans; each kind's are leftmost and do not overlap."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:  # an address begins where the run of local characters before its @ does
        lo = at
        while lo > done and text[lo - 1] in _LOCAL:
            lo -= 1
        if lo < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((lo, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                    out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if 12 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def signature(word: bytes) -> bytes:
    """Classes of bytes: d digit, h a-f, x other lower case and all beyond ASCII, X upper case; the rest as it is."""
    return word.translate(_CLASSES)


def own_features(sig: bytes) -> list[str]:
    """Word-shape features; all a word's scores depend on its signature alone."""
    bare = sig.strip(b"\"'<>[]{},;:!?").decode()
    s = _PAIRS.sub(r"\1", _RUN.sub(r"\1", bare.replace("h", "x")))
    n, digits = len(sig), sig.count(b"d")
    lower = sig.count(b"h")
    alpha = lower + sig.count(b"x") + sig.count(b"X")
    some = "0" if not digits else "1" if digits < 4 else "4" if digits < 12 else "12" if digits < 20 else "20"
    mix = ("h" if digits + lower == len(bare.strip(".")) else "m") if digits and alpha else "a" if alpha else "d" if digits else "p"
    return ["*", f"s={s}", f"n={some}", f"m={mix}", f"l={min(n // 4, 9)}", f"nm={some}{mix}{n > 3}", f"@={b'@' in sig[1:-1]}", f".={min(bare.strip('.').count('.'), 4)}", f"f={s[:1]}", f"e={s[-1:]}"]


def context_class(word: str | None) -> str:
    if word is None:
        return "-"
    return "+" if word[0] == "+" else "@" if "@" in word else "d" if _DIGIT.search(word) else "x" if any(c.isalpha() for c in word) else "p"


CLASSES = ("-", "+", "@", "d", "x", "p")


def parse(line: str) -> tuple[list[str], list[int]]:
    """Words and label numbers of a marked-up line."""
    text, marks, at = "", [], 0
    for m in re.finditer(r"\{(\w+)\|([^}]*)\}", line):
        text += line[at : m.start()]
        marks.append((len(text), len(text) + len(m[2]), LABELS.index(m[1])))
        text += m[2]
        at = m.end()
    text += line[at:]
    words = list(_WORD.finditer(text))
    return [w[0] for w in words], [next((k for a, b, k in marks if w.start() < b and w.end() > a), 0) for w in words]


class Crf:
    """Weights: own (feature -> scores), before and after (class of the neighbour), step, first, last."""

    def __init__(self, lines=LABELLED, rounds: int = 400, rate: float = 0.1, decay: float = 0.0005, step_decay: float = 0.3) -> None:
        n = len(LABELS)
        data = [parse(x) for x in lines]
        self.own = {f: k for k, f in enumerate(sorted({f for ws, _ in data for w in ws for f in own_features(signature(w.encode()))}))}
        n_own, nc = len(self.own), len(CLASSES)
        width = max(len(w) for w, _ in data)
        rows, y, mask = np.zeros((len(data), width, n_own + 2 * nc)), np.zeros((len(data), width), int), np.zeros((len(data), width), bool)
        for i, (ws, ys) in enumerate(data):
            for t, w in enumerate(ws):
                rows[i, t, [self.own[f] for f in own_features(signature(w.encode()))]] = 1
                rows[i, t, n_own + CLASSES.index(context_class(ws[t - 1] if t else None))] = 1
                rows[i, t, n_own + nc + CLASSES.index(context_class(ws[t + 1] if t + 1 < len(ws) else None))] = 1
            y[i, : len(ws)], mask[i, : len(ws)] = ys, True
        last = mask.sum(axis=1) - 1
        shapes = [(n_own + 2 * nc, n), (n, n), (n,), (n,)]
        p = [np.zeros(s) for s in shapes]
        m1, m2 = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
        each, eye = np.arange(len(data)), np.eye(n)
        for k in range(1, rounds + 1):  # full-batch gradient of the log-likelihood, Adam steps
            w, step, first, end = p
            e = rows @ w
            a, b = np.zeros((len(data), width, n)), np.zeros((len(data), width, n))
            a[:, 0] = first + e[:, 0]
            for t in range(1, width):
                new = np.logaddexp.reduce(a[:, t - 1, :, None] + step, axis=1) + e[:, t]
                a[:, t] = np.where(mask[:, t, None], new, a[:, t - 1])
            for t in range(width - 1, -1, -1):
                if t + 1 < width:
                    new = np.logaddexp.reduce(step + (e[:, t + 1] + b[:, t + 1])[:, None, :], axis=2)
                    b[:, t] = np.where(mask[:, t + 1, None], new, end)
                else:
                    b[:, t] = end
            z = np.logaddexp.reduce(a[:, 0] + b[:, 0], axis=1)
            d = (eye[y] - np.exp(a + b - z[:, None, None])) * mask[:, :, None]
            both = mask[:, 1:, None, None]
            pair = np.exp(a[:, :-1, :, None] + step + (e + b)[:, 1:, None, :] - z[:, None, None, None]) * both
            seen = (eye[y[:, :-1]][..., :, None] * eye[y[:, 1:]][..., None, :]) * both
            g = [np.einsum("itf,itl->fl", rows, d), (seen - pair).sum(axis=(0, 1)), d[:, 0].sum(axis=0), d[each, last].sum(axis=0)]
            for j, lam in enumerate((decay, step_decay, step_decay, step_decay)):
                grad = g[j] - lam * p[j]
                m1[j] = 0.9 * m1[j] + 0.1 * grad
                m2[j] = 0.999 * m2[j] + 0.001 * grad**2
                p[j] = p[j] + rate * (m1[j] / (1 - 0.9**k)) / (np.sqrt(m2[j] / (1 - 0.999**k)) + 1e-8)
        self.weights, self.step, self.first, self.last = p
        self.before, self.after = p[0][n_own : n_own + nc], p[0][n_own + nc :]
        into, out = np.vstack([self.step, self.first]), np.vstack([self.step.T, self.last])  # by label before; after
        high = into.max(axis=0) + out.max(axis=0) + self.before.max(axis=0) + self.after.max(axis=0)
        low = into[:, 0].min() + out[:, 0].min() + self.before[:, 0].min() + self.after[:, 0].min()
        self.bound = high[1:] - low

    def scores(self, sig: bytes) -> np.ndarray:
        return self.weights[[k for f in own_features(sig) if (k := self.own.get(f)) is not None]].sum(axis=0)

    def outside(self, s: np.ndarray) -> bool:
        """True if no best path can give a word of these scores any label but O."""
        return bool((s[1:] + self.bound < s[0] - 1e-9).all())

    def decode(self, chains: list[tuple[np.ndarray, bool, bool]]) -> list[np.ndarray]:
        """Viterbi over chains (scores by word, whether it begins, whether it ends its text), in batches of like length."""
        out: list = [None] * len(chains)
        by: dict[int, list[int]] = {}
        for k, (e, _, _) in enumerate(chains):
            by.setdefault((len(e) - 1).bit_length(), []).append(k)
        for ks in by.values():
            for lo in range(0, len(ks), 4096):
                part = ks[lo : lo + 4096]
                size = np.array([len(chains[k][0]) for k in part])
                e = np.zeros((len(part), size.max(), len(LABELS)))
                for r, k in enumerate(part):
                    e[r, : size[r]] = chains[k][0]
                begins, ends = (np.array([chains[k][j] for k in part])[:, None] for j in (1, 2))
                best = np.where(begins, self.first, self.step[0]) + e[:, 0]
                back = np.zeros(e.shape, np.int8)
                for t in range(1, e.shape[1]):
                    to = best[:, :, None] + self.step
                    back[:, t] = to.argmax(axis=1)
                    best = np.where((t < size)[:, None], to.max(axis=1) + e[:, t], best)
                y = np.zeros(e.shape[:2], int)
                now = (best + np.where(ends, self.last, self.step[:, 0])).argmax(axis=1)
                rows = np.arange(len(part))
                for t in range(e.shape[1] - 1, -1, -1):
                    live = t < size
                    y[live, t] = now[live]
                    now = np.where(live, back[rows, t, now], now)
                for r, k in enumerate(part):
                    out[k] = y[r, : size[r]]
        return out


@lru_cache(maxsize=8)
def trained(lines: tuple[str, ...]) -> Crf:
    """The weights for a labelled table, fitted once in a process."""
    return Crf(lines)


def finder(crf: Crf):
    """A function from texts to (base spans, all spans) of each."""
    plain: set[bytes] = set()
    known: dict[bytes, np.ndarray | None] = {}

    def score(word: bytes) -> np.ndarray | None:
        """Scores, or None for a word that stays outside."""
        sig = word.translate(_CLASSES)
        if sig in known:
            return known[sig]
        s = crf.scores(sig)
        s = None if crf.outside(s) else s
        if len(sig) <= WORD_BYTES:
            known[sig] = s
        return s

    def find(batch: list[str]) -> list[tuple[list[Span], list[Span]]]:
        if len(plain) > PLAIN_WORDS:
            plain.clear()
        if len(known) > PLAIN_WORDS:
            known.clear()
        chains, places, found = [], [], []
        for k, text in enumerate(batch):
            found.append(base_spans(text))
            fresh = set(text.encode().split()) - plain
            odd = False
            for w in fresh:
                if score(w) is None:
                    if len(w) <= WORD_BYTES:
                        plain.add(w)
                else:
                    odd = True
            if not odd:
                continue
            words = list(_WORD.finditer(text))
            s = [score(w[0].encode()) for w in words]
            t = 0
            while t < len(words):
                if s[t] is None:
                    t += 1
                    continue
                end = t
                while end < len(words) and s[end] is not None:
                    end += 1
                e = np.array(s[t:end])
                near = [CLASSES.index(context_class(words[i][0] if 0 <= i < len(words) else None)) for i in range(t - 1, end + 1)]
                chains.append((e + crf.before[near[:-2]] + crf.after[near[2:]], t == 0, end == len(words)))
                places.append((k, words[t:end]))
                t = end
        added: list[list[Span]] = [[] for _ in batch]
        for (k, words), y in zip(places, crf.decode(chains), strict=True):
            for a, b in _runs(y):
                lo, hi = words[a].start(), words[b - 1].end()
                text = batch[k]
                while lo < hi and text[lo] in "\"'<[{=:":
                    lo += 1
                while hi > lo and text[hi - 1] in ".,;:!?\"'>]}":
                    hi -= 1
                if lo < hi:
                    added[k].append((lo, int(y[a]) - 1, hi))
        return [(base, sorted(base + _clear(base, more))) for base, more in zip(found, added, strict=True)]

    return find


def _clear(base: list[Span], more: list[Span]) -> list[Span]:
    """Those of more that meet no base span; both in order."""
    reach = np.maximum.accumulate([e for _, _, e in base]) if base else []
    starts = [s for s, _, _ in base]
    return [x for x in more if not (n := int(np.searchsorted(starts, x[2]))) or reach[n - 1] <= x[0]]


def _runs(y: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(np.r_[True, y[1:] != y[:-1], True])
    return [(int(a), int(b)) for a, b in zip(cut, cut[1:], strict=False) if y[a]]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{LABELS[k + 1]}:{a}:{b}" for a, k, b in spans)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines=LABELLED) -> DataFrame:
    """Counts and spans for every row of docs.

    Null and empty texts have no spans; ids may be null and rows may repeat; an empty table gives no rows.
    Other columns are ignored. Spans of the method never meet a base span.
    """
    crf = trained(tuple(lines))

    def make():
        find = finder(crf)

        def each(b: pa.RecordBatch) -> tuple:
            rows, text = [], b.column(1).to_pylist()
            for lo in range(0, len(text), 1000):
                for base, all_ in find(text[lo : lo + 1000]):
                    n = [sum(k == j for _, k, _ in base) for j in range(4)]
                    rows.append((*n, sha256(listed(base).encode()).hexdigest(), listed(all_)))
            return b.column(0), *zip(*rows, strict=True)

        return each

    return map_batches(texts(docs, id_col, text_col), make, _SCHEMA)


def redact(docs: DataFrame, lines=LABELLED) -> DataFrame:
    """docs with each span of text replaced by its kind in brackets, and n_chars to match; nulls stay null.

    Rows that repeat stay and are changed alike; an empty table gives an empty table; other columns of any name pass through.
    """
    crf = trained(tuple(lines))

    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = finder(crf)
        for t in parts:
            out: list[str | None] = []
            for lo in range(0, len(t), 500):
                some = t.iloc[lo : lo + 500]
                out += [None if x is None else hide(x, f[1]) for x, f in zip(some, find([x or "" for x in some]), strict=True)]
            yield pd.Series(out, dtype=object)

    clean = F.pandas_udf(clean, "string")
    out = docs.withColumn("text", clean(docs["text"]))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(quoted(docs.columns)) if "n_chars" in docs.columns else out


def hide(text: str, all_: list[Span]) -> str:
    out, at = [], 0
    for a, k, b in all_:
        if a >= at:
            out += [text[at:a], f"[{LABELS[k + 1].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(read(spark, sf_dir, "documents"))
