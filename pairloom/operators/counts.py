"""Counts of pre-tokens and of adjacent symbol pairs.

All counts are plain ``groupBy`` sums.  Spark adds up inside each task before
it shuffles, so a pre-token that fills a third of the corpus costs one row per
task.  Texts are cut like those that are encoded, and the pieces of a slice counted
before Spark sees them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import cuts, patterns
from pairloom.functions.symbols import Alphabet, neighbours, pack_bytes
from pairloom.operators.encode import _slices


def count_pretokens(
    docs: DataFrame,
    special_tokens: Sequence[str] = (),
    pattern: str = patterns.PRETOKEN_PATTERN,
    text_col: str = "text",
) -> DataFrame:
    """``(pretoken, cnt)`` over all documents; special tokens are left out."""
    if pattern == patterns.PRETOKEN_PATTERN:
        found = _counted(docs, special_tokens, text_col)
    else:
        cut = patterns.pieces(F.col(text_col), special_tokens, pattern, keep_special=False)
        found = docs.select(F.explode(cut).alias("pretoken"), F.lit(1).cast("long").alias("cnt"))
    return found.groupBy("pretoken").agg(F.coalesce(F.sum("cnt"), F.count("cnt")).alias("cnt"))  # never null


def _counted(docs: DataFrame, special_tokens: Sequence[str], text_col: str) -> DataFrame:
    """``(pretoken, cnt)``: the distinct pre-tokens of each slice of texts."""
    kinds, special = cuts.kinds(docs.sparkSession), pa.array(list(special_tokens), pa.string())
    parts = F.coalesce(patterns.parts(F.col(text_col), special_tokens), F.array().cast("array<string>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kinds.value
        for all_rows in batches:
            for batch in _slices(all_rows, "parts"):
                texts = batch.column("parts").flatten().cast(pa.string())
                texts = texts.filter(pc.invert(pc.is_in(texts, special)))
                pieces, _ = cuts.cut(texts, known, np.zeros(len(texts), bool))
                found = pc.value_counts(pieces)
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["pretoken", "cnt"])
                del texts, pieces, found
                pa.default_memory_pool().release_unused()

    return docs.select(parts.alias("parts")).mapInArrow(run, "pretoken string, cnt long")


def merge_pretoken_counts(*parts: DataFrame) -> DataFrame:
    """Add up count tables of shards or days."""
    union = reduce(DataFrame.unionByName, (p.select("pretoken", "cnt") for p in parts))
    return union.groupBy("pretoken").agg(F.sum("cnt").alias("cnt"))


def to_byte_symbols(counts: DataFrame) -> DataFrame:
    """Word table ``(pretoken, seq, cnt)`` with one symbol per UTF-8 byte."""
    return counts.select("pretoken", pack_bytes(F.col("pretoken")).alias("seq"), "cnt")


def packed_pairs(words: DataFrame) -> DataFrame:
    """``(pair, cnt)`` with the pair as a two-character string."""
    return (
        words.select(F.explode(neighbours(F.col("seq"))).alias("pair"), "cnt")
        .groupBy("pair")
        .agg(F.sum("cnt").alias("cnt"))
    )


def with_sides(pairs: DataFrame, alphabet: Alphabet, *values: str) -> DataFrame:
    """Replace the packed pair by the hex of its two sides."""
    return pairs.select(
        alphabet.hex_of(F.substring("pair", 1, 1)).alias("l"),
        alphabet.hex_of(F.substring("pair", 2, 1)).alias("r"),
        *values,
    )


def count_pairs(words: DataFrame, alphabet: Alphabet | None = None) -> DataFrame:
    """``(l, r, cnt)``: every adjacent position counts, weighted by the word count."""
    return with_sides(packed_pairs(words), alphabet or Alphabet(), "cnt")


def pair_index(words: DataFrame, alphabet: Alphabet | None = None) -> DataFrame:
    """Inverted index ``(l, r, pretoken)``, one row per pair and word holding it.

    It stays in long form: the words of a frequent pair are never gathered in
    one group, and as words are distinct the index needs no shuffle.
    """
    pairs = words.select("pretoken", F.explode(F.array_distinct(neighbours(F.col("seq")))).alias("pair"))
    return with_sides(pairs, alphabet or Alphabet(), "pretoken")


def top_pairs(pairs: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` most frequent pairs; ties go to the greatest pair by bytes."""
    return pairs.orderBy(F.desc("cnt"), F.desc("l"), F.desc("r")).limit(k)


def corpus_stats(words: DataFrame) -> DataFrame:
    """One row: pre-tokens, distinct pre-tokens, distinct byte pairs, bytes."""
    of_words = words.agg(
        F.count(F.lit(1)).alias("distinct_pretokens"),
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("pretokens"),
        F.coalesce(F.sum(F.col("cnt") * F.length("seq")), F.lit(0)).alias("bytes"),
        F.lit(0).cast("long").alias("distinct_pairs"),
    )
    of_pairs = packed_pairs(words).agg(F.count(F.lit(1)).alias("distinct_pairs"))
    parts = of_words.unionByName(of_pairs, allowMissingColumns=True)
    return parts.agg(*[F.sum(c).alias(c) for c in of_words.columns])
