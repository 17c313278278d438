"""Joins of tables in which one key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if more than one in HOT rows has it.
HOT = 1000


def join_unique(rows: DataFrame, other: DataFrame, hot: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """The inner or left join of rows with other, whose key is unique; rows of hot keys don't go through a shuffle.

    hot: the keys that more than one in HOT rows has, so at most HOT of them; they and their rows of other are
    broadcast. The others go by a sort-merge join, where no key is more than a small part.
    """
    hot = F.broadcast(hot.select(key))
    few = F.broadcast(hot.join(other, key, how))
    return rows.join(few, key).unionByName(rows.join(hot, key, "left_anti").join(other.hint("merge"), key, how))


def hot_keys(rows: DataFrame, key: list[str], total: int) -> DataFrame:
    """The keys that more than one in HOT of the ``total`` rows has."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") * HOT > total).select(key)
