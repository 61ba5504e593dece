"""Near copies by 64-bit similarity fingerprints and pigeonring filtering.

A fingerprint is cut into a ring of four 16-bit segments.  Two fingerprints
that differ in at most ``MAX_BITS`` bits have a segment from which every run of
consecutive segments stays within its share of that budget: no difference in
one segment, at most one in two, two in three.  So a pair shares a whole
segment and, as the next one differs in at most one bit, one of its halves: 24
equal bits are what pairs are looked up by.  Runs of two and three segments
are then checked before the full distance is.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import kind_of, map_batches
from pairloom.llm.components import components
from pairloom.session import settle

SEED = 42
SEGMENTS = 4
WIDTH = 64 // SEGMENTS
MAX_BITS = 3
#: Shingles whose bits are added up at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int) -> int:
    """The fingerprint as a signed long; each bit is the majority of the shingles' hashes, ties count as 0."""
    found = text.encode("utf-8").lower().split() if text else []
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    n = max(1, len(found) - words + 1)
    parts = (range(at, min(n, at + CHUNK)) for at in range(0, n, CHUNK))
    return majority(np.fromiter((digest(b" ".join(found[i : i + words]), SEED) for i in part), np.uint64, len(part)) for part in parts)


def majority(parts: Iterable[np.ndarray]) -> int:
    """The fingerprint of unsigned hashes that come in parts; 0 of no hashes."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in parts:
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, fp)`` of every row.  Letters A-Z count as small; texts without words get 0."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            return {id_column: batch.column(0), "fp": [fingerprint(t, words) for t in batch.column(1).to_pylist()]}

        return work

    return map_batches(docs.select(id_column, text_column), make, f"`{id_column}` {kind_of(docs, id_column)}, fp long")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _keys(fp: Column) -> Column:
    """A key for each place in the ring and half of the segment after it."""
    half = WIDTH // 2
    found = []
    for i in range(SEGMENTS):
        own, after = _segment(fp, i), _segment(fp, i + 1)
        for k, part in enumerate((after.bitwiseAND(F.lit((1 << half) - 1)), F.shiftright(after, half))):
            found.append(F.lit((2 * i + k) << (WIDTH + half)).bitwiseOR(F.shiftleft(own, half)).bitwiseOR(part))
    return F.array(*found)


def _viable(left: Column, right: Column, key: Column, max_bits: int) -> Column:
    """The chain of the key's segment stays within budget at one, two and three segments, then in full."""
    place = F.shiftrightunsigned(key, WIDTH + WIDTH // 2 + 1).cast("int")
    differ = left.bitwiseXOR(right)
    # turn the ring so that the key's segment comes first
    turned = F.expr("0").cast("bigint")
    for i in range(SEGMENTS):
        by = WIDTH * i
        ring = differ if not i else F.shiftrightunsigned(differ, by).bitwiseOR(F.shiftleft(differ, 64 - by))
        turned = F.when(place == i, ring).otherwise(turned)
    chain = F.lit(True)
    for length in range(1, SEGMENTS):
        low = turned.bitwiseAND(F.lit((1 << (WIDTH * length)) - 1))
        chain = chain & (F.bit_count(low) <= length * max_bits // SEGMENTS)
    return chain & (F.bit_count(differ) <= max_bits)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``(a, b)`` of node ids whose different fingerprints differ in at most ``max_bits`` bits.

    ``prints`` is ``(node, fp)`` with one row per fingerprint: copies have met
    before, so the size of a group of equal fingerprints plays no part.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"keys of half segments need at most {MAX_BITS} bits")
    keyed = prints.select("node", "fp", F.explode(_keys(F.col("fp"))).alias("key"))
    left = keyed.select(F.col("node").alias("a"), F.col("fp").alias("fp_a"), "key")
    right = keyed.select(F.col("node").alias("b"), F.col("fp").alias("fp_b"), F.col("key").alias("key_b"))
    near = _viable(F.col("fp_a"), F.col("fp_b"), F.col("key"), max_bits)
    return left.join(right, (F.col("key") == F.col("key_b")) & (F.col("fp_a") < F.col("fp_b")) & near).select("a", "b").distinct()


def near_copies(
    docs: DataFrame, words: int = 3, max_bits: int = MAX_BITS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(id, fp, component_id)`` of every row: its fingerprint and the smallest id it is linked to over any chain.

    Rows are linked if their fingerprints differ in at most ``max_bits`` bits.
    Null and empty texts share fingerprint zero and are linked like any other.
    Ids are whole numbers; rows with a null id link others like any row, but are not
    the smallest (a component of null ids alone is named null).
    Repeated rows come back repeated; other columns are not looked at.
    """
    prints, _ = settle(fingerprints(docs, words, id_column, text_column), "prints")
    nodes, _ = settle(prints.groupBy("fp").agg(F.min(id_column).cast("long").alias("least")), "nodes")
    # fingerprints are the nodes, so that rows without an id link others as well
    found = components(links(nodes.select("fp", F.col("fp").alias("node")), max_bits))
    owned, _ = settle(nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "owned")
    best = owned.groupBy("component").agg(F.min("least").alias("component_id"))
    named = owned.select("fp", "component").join(best, "component").select("fp", "component_id")
    return prints.join(named, "fp").select(id_column, "fp", "component_id")


def keep_first(docs: DataFrame, words: int = 3, max_bits: int = MAX_BITS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one of each group of near copies does: the one of the smallest id.

    Rows with a null id are left alone, and so are rows that share their group's smallest id
    (repeated ids are the caller's to tell apart).
    """
    groups = near_copies(docs, words, max_bits, id_column, text_column)
    gone = groups.filter(F.col(id_column) > F.col("component_id")).select(F.col(id_column).alias("_gone")).distinct()
    return docs.join(gone, docs[id_column] == gone["_gone"], "left_anti")
