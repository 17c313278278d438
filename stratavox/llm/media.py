"""Media columns: content-defined chunks, stored once each, and media rebuilt from ordered chunk lists.

A payload is cut where a rolling gear hash over 32 bytes has its top bits clear. Chunks are named by digest;
an aggregate over the digests finds those that several payloads hold, and each is stored once, in the row of its
owner (the payload of the least content key that has it). A store row holds a media header, the ordered
digests, the chunks it owns and the digests of those it lacks, so most media are rebuilt from their own row; what
is lacking is fetched by a join on digest. Bytes move once, into the store: texts that have copies or lack
a chunk are found by a bitmap of bounded size over their content keys (a false hit only joins in vain), and
only they are shuffled before being written, one row of each text from a task.

A key that more than one in HOT rows has is joined by broadcast: there are at most HOT such keys, whatever the table.
"""

from __future__ import annotations

import struct
from hashlib import blake2b, sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT, bitmap, join_unique, listed, map_batches, maybe, read, spill, texts

UNIT, MIN_CHUNK, MAX_CHUNK, CUT_BITS = 64, 256, 8192, 10
RATE = 8000
SEEN = 1 << 20
_CATALOG = "doc_id long, k binary, parts array<binary>"
_STORE = "doc_id long, alone boolean, k binary, n_bytes long, header binary, media_sha256 string, digests array<binary>, own array<struct<seq: int, bytes: binary, shared: boolean>>, missing array<binary>"
_FEATURES = "doc_id long, k binary, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def gear() -> np.ndarray:
    """256 fixed 32-bit numbers."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0x2545F4914F6CDD1D)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) >> np.uint64(32)).astype(np.uint32)


def cut(payload: bytes, table: np.ndarray) -> list[bytes]:
    """The payload's chunks in order, each of at most MAX_CHUNK bytes and, but for the last, MIN_CHUNK or more."""
    n = len(payload)
    if n <= MIN_CHUNK:
        return [payload]
    h = table[np.frombuffer(payload, np.uint8)]
    for s in (1, 2, 4, 8, 16):
        wider = h.copy()
        wider[s:] += h[:-s] << np.uint32(s)
        h = wider
    out, last = [], 0
    for c in [*(np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist(), n]:
        while c - last > MAX_CHUNK:
            out.append(payload[last : last + MAX_CHUNK])
            last += MAX_CHUNK
        if c - last >= MIN_CHUNK or c == n and c > last:
            out.append(payload[last:c])
            last = c
    return out


def padded(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % UNIT or (0 if raw else UNIT))


def header(n: int) -> bytes:
    """The RIFF/WAVE header of n unsigned 8-bit mono samples."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", (36 + n) & 0xFFFFFFFF, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", n & 0xFFFFFFFF)


def samples(media: bytes) -> bytes:
    """The samples of such a file."""
    fields = struct.unpack_from("<4sI4s4sIHHIIHH4sI", media)
    if (fields[0], fields[2], fields[5], fields[6], fields[10]) != (b"RIFF", b"WAVE", 1, 1, 8):
        raise ValueError("not 8-bit mono PCM")
    return media[44 : 44 + fields[12]]


def digest(chunk: bytes) -> bytes:
    return blake2b(chunk, digest_size=16).digest()


def features(n_bytes: int, head: bytes, chunks: list[bytes], digests: list[bytes], expected: str) -> tuple:
    """What is told of one rebuilt media; raises if a chunk or the whole is not what was stored."""
    if [digest(c) for c in chunks] != list(digests):
        raise ValueError("a chunk differs from its digest")
    media = head + b"".join(chunks)
    whole = sha256(media).hexdigest()
    if whole != expected:
        raise ValueError("the rebuilt media differs from the stored one")
    payload = samples(media)
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    crossings = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    feature = f"sum={int(x.sum())};energy={int((x * x).sum())};crossings={crossings};chunks={len(chunks)}"
    return n_bytes, len(payload), sha256(payload).hexdigest(), crc32(payload[-UNIT:]), len(media), whole, feature


def _catalog_rows():
    """Columns: doc_id, k, text. A text's distinct chunks are told by its first row in a task."""
    table, seen = gear(), set()

    def each(b: pa.RecordBatch) -> tuple:
        keys, parts = b.column(1).to_pylist(), []
        for k, raw in zip(keys, b.column(2).cast(pa.large_binary()), strict=True):
            if k in seen:
                parts.append([])
                continue
            if len(seen) > SEEN:
                seen.clear()
            seen.add(k)
            parts.append(list(dict.fromkeys(map(digest, cut(padded(raw.as_py()), table)))))
        return b.column(0), b.column(1), parts

    return each


def _store_rows(shared):
    """Columns: doc_id, alone, k, text, theirs (digests of chunks that others own, or null). shared: their Bitmap."""
    table = gear()

    def each(b: pa.RecordBatch) -> tuple:
        from xxhash import xxh64_intdigest

        out, payloads = [], [padded(x.as_py()) for x in b.column(3).cast(pa.large_binary())]
        chunks = [cut(p, table) for p in payloads]
        digests = [list(map(digest, c)) for c in chunks]
        flat = list({d for found in digests for d in found})
        seen = listed(np.fromiter((xxh64_intdigest(d, 42) for d in flat), np.uint64, len(flat)), shared.value)
        fetched = {d for d, hit in zip(flat, seen.tolist(), strict=True) if hit}
        bare = b.column(3).cast(pa.large_binary())
        for k, (i, alone, key, theirs) in enumerate(zip(*(b.column(c).to_pylist() for c in (0, 1, 2, 4)), strict=True)):
            head, done, own = header(len(payloads[k])), set(theirs or ()), []
            for s, (c, d) in enumerate(zip(chunks[k], digests[k], strict=True)):
                if d not in done:
                    done.add(d)
                    own.append({"seq": s, "bytes": c, "shared": d in fetched})
            out.append((i, alone, key, len(bare[k].as_buffer()), head, sha256(head + payloads[k]).hexdigest(), digests[k], own, theirs or []))
        return zip(*out, strict=True)

    return each


def _rebuilt(b: pa.RecordBatch) -> tuple:
    """Columns: those of _STORE, and more, an array of (digest, bytes), where chunks were missing."""
    out = []
    for r in b.to_pylist():
        found = {r["digests"][c["seq"]]: c["bytes"] for c in r["own"]} | {c["digest"]: c["bytes"] for c in r["more"] or ()}
        out.append((r["doc_id"], r["k"], *features(r["n_bytes"], r["header"], [found[d] for d in r["digests"]], r["digests"], r["media_sha256"])))
    return zip(*out, strict=True)


def catalog(docs: DataFrame) -> DataFrame:
    """A written table of docs' (doc_id, text) rows: doc_id, content key k, and parts for the first row of a text in a task."""
    return spill(map_batches(keyed(docs), _catalog_rows, _CATALOG))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("k"), "text")


def chunk_store(docs: DataFrame, listing: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, np.ndarray]:
    """The store for docs (doc_id, text), one row for each text and one copy of each chunk.

    listing: catalog(docs). Returns the store; the digests that more than one in HOT parts has, and the keys that
    more than one in HOT rows has; and a bitmap of the keys that are not written by their only row.
    """
    spark = docs.sparkSession
    n = listing.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("parts")), F.lit(0)).alias("parts")).first()
    parts = listing.select("k", F.explode("parts").alias("digest"))
    owners = parts.groupBy("digest").agg(F.min("k").alias("owner"), F.max("k").alias("other"), F.count("*").alias("n"))
    shared = spill(owners.filter("owner <> other").select("digest", "owner", "n"))
    hot_chunks = shared.filter(F.col("n") * HOT > n["parts"])
    theirs = join_unique(parts, shared, hot_chunks, ["digest"]).filter("k <> owner").groupBy("k").agg(F.collect_set("digest").alias("theirs"))
    copies = listing.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1")
    known = spill(theirs.hint("merge").join(copies, "k", "full"))
    hot_keys = known.filter(F.col("n") * HOT > n["rows"])

    keys = bitmap(known.select("k"), "k")
    marked = keyed(docs).withColumn("maybe", maybe(keys, "k"))
    alone = marked.filter("NOT maybe").select("doc_id", F.lit(True).alias("alone"), "k", "text", F.lit(None).cast("array<binary>").alias("theirs"))
    some = marked.filter("maybe").groupBy("k").agg(F.first("text").alias("text")).join(known.hint("merge"), "k", "left")
    some = some.select(F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("alone"), "k", "text", "theirs")
    bits = spark.sparkContext.broadcast(bitmap(shared.select("digest"), "digest"))
    make = lambda: _store_rows(bits)
    return spill(map_batches(alone, make, _STORE).unionByName(map_batches(some, make, _STORE))), hot_chunks, hot_keys, keys


def completed(store: DataFrame, hot_chunks: DataFrame) -> DataFrame:
    """The store's rows that lack chunks, with these in a column more."""
    part = store.filter(F.size("missing") > 0)
    own = store.select(F.explode(F.filter("own", lambda c: c["shared"])).alias("c"), "digests").select(F.element_at("digests", F.col("c.seq") + 1).alias("digest"), F.col("c.bytes").alias("bytes"))
    fetched = join_unique(part.select("k", F.explode("missing").alias("digest")), own, hot_chunks, ["digest"])
    more = fetched.groupBy("k").agg(F.collect_list(F.struct("digest", "bytes")).alias("more"))
    return part.join(more.hint("merge"), "k").select(*store.columns, "more")


def rebuilt(rows: DataFrame) -> DataFrame:
    """Features of the media of store rows, verified; rows that lack chunks must come from completed()."""
    if "more" not in rows.columns:
        rows = rows.withColumn("more", F.lit(None).cast("array<struct<digest: binary, bytes: binary>>"))
    return map_batches(rows, lambda: _rebuilt, _FEATURES)


def stored_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sizes, digests and features of every row's media, read back from the chunk store.

    A null or empty text is 64 zero bytes. Rows of equal text share one stored media and get equal values;
    ids may be null or repeat; an empty table gives no rows; other columns are ignored.
    """
    rows = texts(docs, id_col, text_col)
    listing = catalog(rows)
    store, hot_chunks, hot_keys, keys = chunk_store(rows, listing)
    whole = rebuilt(store.filter("NOT alone AND size(missing) = 0"))
    told = spill(whole.unionByName(rebuilt(completed(store, hot_chunks)))).drop("doc_id")
    listing = listing.filter(maybe(keys, "k")).select("doc_id", "k")
    return rebuilt(store.filter("alone")).drop("k").unionByName(join_unique(listing, told, hot_keys, ["k"]).drop("k"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_media(read(spark, sf_dir, "documents"))
