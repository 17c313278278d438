"""File names: channel and slice numbers, routing and selection. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _found(name: Column, pattern: str, group: int = 1) -> Column:
    """The group, or null where nothing matches."""
    return F.nullif(F.regexp_extract(name, pattern, group), F.lit(""))


def parse_strict(name: Column) -> tuple[Column, Column]:
    """Channel and z as written (``C3``, ``0042``) from ``_C<n>_Z<n>``; null if the pair is absent."""
    pattern = r"_(C\d+)_Z(\d+)"
    return _found(name, pattern, 1), _found(name, pattern, 2)


def parse_loose(name: Column) -> tuple[Column, Column]:
    """Channel and z as integers from the first ``C<n>`` and the first ``Z<n>`` of the stem; each may be null."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return _found(stem, r"C(\d+)").try_cast("int"), _found(stem, r"Z(\d+)").try_cast("int")


def route_channel(name: Column) -> Column:
    """The folder ``ch<n>`` that a file belongs to, null if it has none.

    A name with ``_C<n>_`` before ``.tif``, in any case, goes by its last such number; else a name with ``_Ch<n>``
    goes by the token before its extension.
    """
    new = _found(name, r"(?i)^.*_C(\d+)_.*\.tif")
    tokens = F.split(name, r"[_.]")
    token = F.try_element_at(tokens, F.lit(-2))
    old = F.when(name.rlike(r"_Ch\d+"), _found(token, r"(?i)^ch(\d+)$"))
    return F.when(new.isNotNull(), F.concat(F.lit("ch"), new.cast("int").cast("string"))).when(old.isNotNull(), F.concat(F.lit("ch"), old.cast("int").cast("string")))


def select_files(files: DataFrame, channel: int | None = None, z: int | None = None, z_min: int | None = None, z_max: int | None = None) -> DataFrame:
    """Files (columns c, z) that pass every given test; a null number passes, bounds count, -1 means all."""
    out = files
    if channel not in (None, -1):
        out = out.filter(F.col("c").isNull() | (F.col("c") == channel))
    if z not in (None, -1):
        out = out.filter(F.col("z").isNull() | (F.col("z") == z))
    if z_min is not None:
        out = out.filter(F.col("z").isNull() | (F.col("z") >= z_min))
    if z_max is not None:
        out = out.filter(F.col("z").isNull() | (F.col("z") <= z_max))
    return out
