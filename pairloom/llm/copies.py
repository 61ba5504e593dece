"""Near copies by shared shingles of five words: a Jaccard similarity of at least ``SHARE``, checked exactly.

First come the fingerprints of the shingles and the pigeonring filter of
``simhash``: texts whose fingerprints differ in a few bits are compared.  A pair
at 0.8 differs in about 10 of 64 bits, which no key of equal bits finds among many
texts, so the others meet by minima.
Each text has ``BANDS`` keys of ``ROWS`` minima of its shingles' hashes.  A
pair at 0.8 shares none of them with a chance of (1 - 0.8^4)^32 = 5e-8, a pair
above it with less.  Texts that share a key are compared by their whole sets
of shingles.  In a bucket all are first compared with one of them, so that a
large group takes as many comparisons as it has members.  Those that are then
still in different components meet by the rarest shingles of their sets, of
which similar ones have one in common, so texts that are alike only in a
passage that many hold are not compared.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom import session
from pairloom.llm import simhash
from pairloom.llm.common import free_name, kind_of, map_batches
from pairloom.llm.components import components
from pairloom.session import drop_scratch, settle

WORDS = 5
SHARE = 0.8
BANDS, ROWS = 32, 4
#: Rounds in which a bucket is compared with one of its members.
STARS = 2
#: Remainders of shingles whose occurrences are counted to tell rare ones from frequent ones.
COUNTED = 1 << 16
SEED = 42
#: Longs of a parity sketch; each shingle turns over one bit, so two sketches differ in no more bits than two sets in shingles.
SKETCH = 8
#: Shingles whose minima are taken at once.
CHUNK = 1 << 11
MULTIPLIERS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of runs of ``words`` words, sorted; a shorter text is one run.  Letters A-Z count as small."""
    found = text.encode("utf-8").lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    n, digest = max(1, len(found) - words + 1), xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(found[i : i + words]), SEED) for i in range(n)), np.uint64, n))


def keys(grams: np.ndarray) -> list[int]:
    """A signed long for each band; none of no shingles."""
    if not len(grams):
        return []
    least = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), CHUNK):
        np.minimum(least, np.multiply.outer(MULTIPLIERS, grams[at : at + CHUNK]).min(axis=1), out=least)
    bands = least.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(band.tobytes(), k) - (1 << 63) for k, band in enumerate(bands)]


def fingerprint(grams: np.ndarray) -> int:
    """The 64-bit similarity fingerprint of a set of shingles, each counted once."""
    return simhash.majority(grams[at : at + simhash.CHUNK] for at in range(0, len(grams), simhash.CHUNK))


def parities(grams: np.ndarray) -> np.ndarray:
    """The parity sketch of distinct hashes."""
    odd = np.bincount(grams.view(np.uint64) % np.uint64(64 * SKETCH), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def marked(docs: DataFrame, stem: str, words: int = WORDS, text_column: str = "text") -> DataFrame:
    """``docs`` with a row number, the digest, number and fingerprint of the shingles, and the keys; shingles are made again where needed."""
    names = docs.columns
    at = names.index(text_column)

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            found = [shingles(t, words) for t in batch.column(at).to_pylist()]
            return {n: batch.column(k) for k, n in enumerate(names)} | {
                f"{stem}_node": [xxhash.xxh64_intdigest(g.tobytes(), SEED) - (1 << 63) for g in found],
                f"{stem}_n": [len(g) for g in found],
                f"{stem}_fp": [fingerprint(g) for g in found],
                f"{stem}_keys": [keys(g) for g in found],
            }

        return work

    schema = [f"`{n}` {kind_of(docs, n)}" for n in names] + [f"`{stem}_node` long", f"`{stem}_n` long", f"`{stem}_fp` long", f"`{stem}_keys` array<long>"]
    return map_batches(docs, make, ", ".join(schema)).withColumn(f"{stem}_row", F.monotonically_increasing_id())


def shingle_sets(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """``(node, grams)`` of ``(node, text)``."""

    def make():
        return lambda batch: {"node": batch.column("node"), "grams": [shingles(t, words).view(np.int64) for t in batch.column("text").to_pylist()]}

    return map_batches(texts.select("node", "text"), make, "node long, grams array<long>")


def similar(pairs: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """Those of the pairs ``(a, b, ...)`` of nodes whose sets are at least ``share`` similar."""
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"))
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    enough = common >= share * (F.size("grams_a") + F.size("grams_b") - common) - 1e-9
    return pairs.join(left, "a").join(right, "b").filter(enough).select(*pairs.columns)


def rarest(sets: DataFrame, share: float) -> DataFrame:
    """``(node, component, n, gram, place, s0, s1, ...)``: of ``(node, grams, component)`` the rarest shingles of each set, and its parity sketch.

    Sets of at least ``share`` similarity have one of them in common, whatever the order, as long as it is one for all
    sets.  The order is by how often shingles of one of ``COUNTED`` remainders occur, so those of a passage that many
    texts hold come last; the driver sees a number a remainder.
    """
    remainder = F.pmod("gram", F.lit(COUNTED))
    often = sets.select(F.explode("grams").alias("gram")).groupBy(remainder.alias("r")).agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(COUNTED, np.int64)
    for row in session.bounded_rows(often, COUNTED, "the remainders"):
        counts[row["r"]] = row["n"]
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def make():
        known = shared.value

        def work(batch: pa.RecordBatch) -> dict:
            take, sizes, grams, places = [], [], [], []
            odd = np.zeros((batch.num_rows, SKETCH), np.int64)
            for k, found in enumerate(batch.column(1)):
                own = found.values.to_numpy(zero_copy_only=False)
                n, odd[k] = len(own), parities(own)
                first = own[np.lexsort((own, known[own % COUNTED]))[: n - int(np.ceil(share * n - 1e-9)) + 1]]
                take.append(np.full(len(first), k))
                sizes.append(np.full(len(first), n))
                grams.append(first)
                places.append(np.arange(1, len(first) + 1))
            rows = pa.array(np.concatenate(take)) if take else pa.array([], pa.int64())
            joined = [np.concatenate(x) if x else [] for x in (sizes, grams, places)]
            whole = {"node": batch.column(0), "component": batch.column(2)} | {f"s{i}": pa.array(odd[:, i]) for i in range(SKETCH)}
            return {name: column.take(rows) for name, column in whole.items()} | dict(zip(("n", "gram", "place"), joined, strict=True))

        return work

    return map_batches(sets.select("node", "grams", "component"), make, "node long, component long, n long, gram long, place long, " + ", ".join(f"s{i} long" for i in range(SKETCH)))


def near_prints(texts: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of ``(node, fp)`` whose fingerprints differ in ``simhash.MAX_BITS`` bits at most.

    Of equal fingerprints the least node meets every other one, and it alone meets other fingerprints.
    """
    prints = texts.groupBy("fp").agg(F.min("node").alias("a"))
    equal = texts.join(prints, "fp").filter("a <> node").select("a", F.col("node").alias("b"))
    return equal.unionByName(simhash.links(prints.withColumnRenamed("a", "node")))


def links(texts: DataFrame, sets_of: Callable[[DataFrame], DataFrame], share: float = SHARE) -> DataFrame:
    """Edges ``(a, b)`` that connect what pairs of at least ``share`` similarity connect, written.

    ``texts`` is ``(node, n, fp, keys)`` with one row a node; ``sets_of`` gives ``(node, grams)`` of a table of
    nodes and is asked for those alone that share a key with another.
    """
    paths: list[str] = []

    def settle(frame: DataFrame, name: str) -> tuple[DataFrame, str]:
        table, path = session.settle(frame, name)
        paths.append(path)
        return table, path

    keyed = texts.select("node", "n", F.explode("keys").alias("key"))
    shared, _ = settle(keyed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("key"), "shared")
    members, _ = settle(keyed.join(shared, "key"), "members")
    alike, _ = settle(near_prints(texts.select("node", "fp")), "alike")
    ends = alike.select(F.col("a").alias("node")).unionByName(alike.select(F.col("b").alias("node")))
    candidates, _ = settle(members.select("node").unionByName(ends).distinct(), "candidates")
    sets, _ = settle(sets_of(candidates), "sets")

    def near(a: str, b: str) -> Column:
        return F.least(a, b) >= share * F.greatest(a, b) - 1e-9

    def named(grouped: DataFrame, edges: DataFrame) -> DataFrame:
        """``grouped`` after the components that the edges connect have become one."""
        least = components(edges).select(F.col("node").alias("component"), F.col("component").alias("least"))
        found = grouped.join(least, "component", "left").select("key", "node", "n", F.coalesce("least", "component").alias("component"))
        return settle(found, "grouped")[0]

    edges, _ = settle(similar(alike, sets, share), "edges")
    grouped = named(members.withColumn("component", F.col("node")), edges)
    for turn in range(STARS):
        head = grouped.groupBy("key").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), "node", "n", "component")).alias("head"))
        head, _ = settle(head.select("key", F.col("head.node").alias("b"), F.col("head.n").alias("m"), F.col("head.component").alias("other")), "heads")
        stars = grouped.join(head, "key").filter((F.col("component") != F.col("other")) & near("n", "m"))
        # a node has one component, so this is one row a pair
        pairs, _ = settle(stars.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"), F.least("component", "other").alias("low"), F.greatest("component", "other").alias("high")).distinct(), "pairs")
        fresh, _ = settle(similar(pairs, sets, share), "fresh")
        edges = edges.unionByName(fresh.select("a", "b"))
        grouped = named(grouped, fresh.select(F.col("high").alias("a"), F.col("low").alias("b")))
    # texts that a bucket still holds in several components meet again by their rarest shingles
    border = [F.min("component").alias("low"), F.max("component").alias("high")]
    mixed, _ = settle(grouped.groupBy("key").agg(*border).filter("low <> high").select("key"), "mixed")
    apart, _ = settle(grouped.join(mixed, "key").groupBy("node").agg(F.any_value("component").alias("component")), "apart")
    rare, _ = settle(rarest(sets.join(apart, "node"), share), "rare")
    several, _ = settle(rare.groupBy("gram").agg(*border).filter("low <> high").select("gram"), "several")
    meeting, _ = settle(rare.join(several, "gram"), "meeting")
    other = {"node": "b", "n": "m", "place": "at", "component": "other"} | {f"s{i}": f"o{i}" for i in range(SKETCH)}
    right = meeting.withColumnsRenamed(other)
    # the first shingle that a similar pair has in common leaves room for all that it needs
    room = 1 + F.least(F.col("n") - F.col("place"), F.col("m") - F.col("at"))
    both = F.col("n") + F.col("m")
    differ = sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"o{i}"))) for i in range(SKETCH)), F.lit(0))
    few = differ <= (1 - share) / (1 + share) * both + 1e-6  # no similar sets differ in more shingles
    able = (F.col("component") < F.col("other")) & near("n", "m") & (room >= share / (1 + share) * both - 1e-6) & few
    crossed = meeting.withColumnRenamed("node", "a").join(right, "gram").filter(able)
    pairs, _ = settle(crossed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    every, _ = session.settle(edges.unionByName(similar(pairs, sets, share)), "links")
    for path in paths:
        session.drop_scratch(texts.sparkSession, path)
    return every


def keep_first(docs: DataFrame, words: int = WORDS, share: float = SHARE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one of each group of near copies does: one of the smallest id.

    Texts are linked if their sets of shingles are at least ``share`` similar, and over any chain of links.
    Texts without words are copies of each other.  A row with a null id stays only if
    its whole group has none; of rows that share the smallest id one stays.
    """
    stem = free_name(docs, "_copy")
    rows, _ = settle(marked(docs, stem, words, text_column), "marked")
    row, node = F.col(f"{stem}_row"), F.col(f"{stem}_node")
    same = [F.any_value(f"{stem}_{c}").alias(c) for c in ("n", "fp", "keys")]  # copies have the same shingles, so the same keys
    texts, path = settle(rows.groupBy(node.alias("node")).agg(F.min(row).alias("row"), *same), "texts")

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = texts.select("node", "row").join(nodes, "node", "left_semi")
        return shingle_sets(rows.select(row.alias("row"), F.col(text_column).alias("text")).join(wanted, "row"), words)

    found, _ = settle(components(links(texts, sets_of, share)), "components")
    drop_scratch(docs.sparkSession, path)
    owned = rows.select(F.col(id_column).alias("id"), row.alias("row"), node.alias("node")).join(found, "node", "left")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    stay = owned.groupBy(F.coalesce("component", "node").alias("group")).agg(best.alias("best")).select(F.col("best.row").alias(f"{stem}_row"))
    return rows.join(stay, f"{stem}_row", "left_semi").select(*(F.col(f"`{n}`") for n in docs.columns))
