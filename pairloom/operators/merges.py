"""Applying merges to word tables, and what a merge does to the pair counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.symbols import Alphabet, holds_any, neighbours, string_array
from pairloom.operators.counts import with_sides


@dataclass(frozen=True)
class PackedMerge:
    """A pair of symbols and the symbol it becomes, in packed form."""

    pair: str
    result: str


def pack_merges(merges: Iterable[tuple[bytes, bytes]], alphabet: Alphabet) -> list[PackedMerge]:
    """Packed form of merges; new symbols enter the alphabet."""
    return [
        PackedMerge(alphabet.add(left) + alphabet.add(right), alphabet.add(left + right))
        for left, right in merges
    ]


def replace_all(seq: Column, merges: Sequence[PackedMerge]) -> Column:
    """The sequence after all merges, applied in order.

    One ``aggregate`` over a folded array literal: nested ``replace`` calls
    would be compiled anew for every number of merges, and many of them
    would make methods too large to be compiled at all.  Words that hold none
    of the pairs are left alone, as no later merge can come about in them.
    """
    if not merges:
        return seq
    steps = F.arrays_zip(
        string_array([m.pair for m in merges]).alias("pair"),
        string_array([m.result for m in merges]).alias("result"),
    )
    done = F.aggregate(steps, seq, lambda done, m: F.replace(done, m["pair"], m["result"]))
    return F.when(holds_any(seq, [m.pair for m in merges]), done).otherwise(seq)


def apply_merges(words: DataFrame, merges: Sequence[PackedMerge]) -> DataFrame:
    """Replace each pair in every word, left to right and without overlaps."""
    return words.withColumn("seq", replace_all(F.col("seq"), merges))


def signed_pairs(changes: DataFrame) -> DataFrame:
    """Pairs of the new words and negated pairs of the old ones, not added up.

    Reads ``(old_seq, seq, cnt)`` and skips the words that did not change.
    """

    both = F.array(
        F.struct(F.col("seq").alias("seq"), F.col("cnt").alias("cnt")),
        F.struct(F.col("old_seq").alias("seq"), (-F.col("cnt")).alias("cnt")),
    )
    return (
        changes.filter(F.col("seq") != F.col("old_seq"))
        .select(F.explode(both).alias("w"))
        .select(F.explode(neighbours(F.col("w.seq"))).alias("pair"), F.col("w.cnt").alias("cnt"))
    )


def pair_count_delta(words: DataFrame, left: bytes, right: bytes, alphabet: Alphabet) -> DataFrame:
    """``(l, r, delta)`` of one merge, from the words that hold the pair alone."""
    (merge,) = pack_merges([(left, right)], alphabet)
    affected = words.filter(F.contains(F.col("seq"), F.lit(merge.pair)))
    changes = affected.select(
        F.col("seq").alias("old_seq"), replace_all(F.col("seq"), [merge]).alias("seq"), "cnt"
    )
    delta = (
        signed_pairs(changes).groupBy("pair").agg(F.sum("cnt").alias("delta")).filter(F.col("delta") != 0)
    )
    return with_sides(delta, alphabet, "delta")
