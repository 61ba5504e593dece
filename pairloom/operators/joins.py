"""Joins whose left side may have keys that fill a large part of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.session import settle

SHARES = 4096  # a key is hot if it holds more than one of so many parts of the rows; so there are fewer hot keys than that


def hot_keys(counts: DataFrame, keys: Sequence[str], shares: int = SHARES) -> DataFrame:
    """``keys`` that hold more than ``1/shares`` of the rows that ``counts (keys..., n)`` counts, written.

    There are fewer than ``shares``, whatever the table.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    return settle(counts.filter(F.col("n") > total // shares).select(*keys), "hot")[0]


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", counts: DataFrame | None = None, shares: int = SHARES) -> DataFrame:
    """``left`` joined with at most one row of ``right`` for each key, without a task that gets a hot key's rows.

    Rows of hot keys stay where they are and meet their partners, fewer than ``shares`` rows, in a broadcast.
    The others are shuffled; no key among them holds more than ``1/shares`` of all rows.  ``left`` is
    read once for the counts (unless ``counts (keys..., n)`` are given), and once for each of the two joins.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    keys = list(keys)
    if counts is None:
        counts, _ = settle(left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    hot = hot_keys(counts, keys, shares)
    partners = F.broadcast(right.join(F.broadcast(hot), keys, "left_semi"))
    warm = left.join(F.broadcast(hot), keys, "left_semi").join(partners, keys, how)
    cold = left.join(F.broadcast(hot), keys, "left_anti").join(right, keys, how)
    return warm.unionByName(cold)
