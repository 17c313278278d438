"""Helpers shared by the corpus operators: inputs, spilled tables and Arrow mapping."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import HOT, hot_keys, join_unique
from ..storage import spill

__all__ = ["HOT", "LOWER", "ROWS", "UPPER", "bitmap", "hot_keys", "join_unique", "listed", "lower_ascii", "map_batches", "maybe", "plain_classes", "quoted", "raw_texts", "read", "spill", "texts"]

#: A-Z to a-z; other characters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Bits of a bitmap of keys at most (16 MB).
BITMAP_BITS = 1 << 27

#: Rows that a function of a batch sees at once.
ROWS = 2048


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def quoted(names: list[str]) -> list[str]:
    """Names of columns for expressions, whatever characters they hold."""
    return ["`" + n.replace("`", "``") + "`" for n in names]


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), null texts empty; other columns, whatever their names, are left out."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list | tuple]], schema: str) -> DataFrame:
    """make() builds, once for a task, a function from a record batch to the output's columns."""
    fields = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                cols = each(whole.slice(at, ROWS))
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(cols, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, fields)


def raw_texts(b: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A string column as UTF-8 bytes."""
    return b.column(b.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


def plain_classes() -> tuple[str, str, str, re.Pattern]:
    """(white space, letters, digits, what has another character than plain ones), for character classes.

    Plain are white space and the printable characters below U+0250 whose lower case is one of them too: they
    are in normal form, and their classes are the same to tokenizers and here.
    """
    white = " \t\n\v\f\r"
    below = [c for c in map(chr, range(33, 0x250)) if not 127 <= ord(c) <= 160 and len(c.lower()) == 1 and c.lower() < "\u0250"]
    letters, digits = (re.escape("".join(c for c in below if unicodedata.category(c)[0] == x)) for x in "LN")
    return white, letters, digits, re.compile(f"[^{white}{re.escape(''.join(below))}]")


def listed(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) a bitmap may hold: all that were entered, and a few others."""
    size = np.uint64(32 * len(bits))
    a, b = ((h >> np.uint64(s)) % size for s in (0, 32))
    bit = lambda at: bits[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32) & np.uint32(1)
    return (bit(a) & bit(b)) > 0


def bitmap(keys: DataFrame, name: str) -> np.ndarray:
    """A bitmap of at most BITMAP_BITS with two bits set for each value of the column."""
    size = min(BITMAP_BITS, 1 << max(10, (16 * keys.count()).bit_length()))
    h = F.xxhash64(name)
    at = keys.select(F.explode(F.array(h.bitwiseAND(size - 1), F.shiftrightunsigned(h, 32).bitwiseAND(size - 1))).alias("at"))
    words = at.groupBy(F.shiftright("at", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(at & 31))")).alias("bits")).toPandas()
    bits = np.zeros(size >> 5, np.uint32)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return bits


def maybe(bits: np.ndarray, name: str) -> Column:
    """Whether a bitmap may hold the column's value."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def test(h):
        import pandas as pd

        return pd.Series(listed(h.to_numpy(np.int64).view(np.uint64), shared.value))

    return test(F.xxhash64(name))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)
