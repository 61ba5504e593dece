"""Cutting documents into segments, lines and pre-tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import patterns


def split_special(
    docs: DataFrame,
    special_tokens: Sequence[str],
    text_col: str = "text",
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """One row per non-empty segment or special token, in order."""
    cut = patterns.segments(F.col(text_col), special_tokens)
    return docs.select(*keys, F.posexplode(cut).alias("seg_pos", "s")).select(
        *keys, "seg_pos", F.col("s.segment").alias("segment"), F.col("s.is_special").alias("is_special")
    )


def split_lines(
    docs: DataFrame, text_col: str = "text", keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """One row per line; a line keeps its own line feed."""
    return docs.select(*keys, F.posexplode(patterns.lines(F.col(text_col))).alias("line_no", "line"))


def pretokenize(
    docs: DataFrame,
    special_tokens: Sequence[str] = (),
    pattern: str = patterns.PRETOKEN_PATTERN,
    text_col: str = "text",
    keys: Sequence[str] = ("doc_id",),
    keep_special: bool = False,
) -> DataFrame:
    """One row per pre-token, in order; none crosses a special token."""
    cut = patterns.pieces(F.col(text_col), special_tokens, pattern, keep_special)
    return docs.select(*keys, F.posexplode(cut).alias("pos", "pretoken"))
