"""Nearest neighbours by multiprobe p-stable hashing.

A table has ``HASHES`` projections ``floor((a x + b) / width)`` with normal
``a``; together they name a bucket.  A query visits its own bucket and those
next to it in the order of their estimated chance of holding near vectors: the
perturbations of least summed squared distance to the slot borders come first,
in a sequence that depends on expected distances only.  What the buckets of
all tables hold is measured exactly and the nearest are merged.

The width of a slot follows the distances of the data: it is ``SLOT`` times the
distance of the last neighbour asked for, as measured for ``SAMPLE`` queries.
In how many tables a query's neighbours were met tells how many were not met in
any; queries for which that leaves less than ``RECALL`` are measured against all.

Equal vectors are searched once: a class of them stands in the index with its
smallest id.  Buckets of more than ``FULL`` classes are dealt over several
blocks, each of which their probes visit.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import map_batches
from pairloom.session import settle

TABLES = 10
HASHES = 8
#: Width of a slot in distances of the k-th neighbour, queries this distance is measured for, and the share of them within it.
SLOT = 1.9
SAMPLE = 64
WITHIN = 0.75
#: Recall below which a query goes to the exact way.
RECALL = 0.9
PROBES = 60
SEED = 5
#: Index rows in a block, and classes of one bucket that stay together.
BLOCK = 20_000
FULL = 5_000
#: Vectors measured against at once.
CHUNK = 4096


@lru_cache(maxsize=4)
def projections(size: int, tables: int, hashes: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions, shifts (shares of a slot) and odd multipliers that make a bucket's slots one long."""
    draw = np.random.default_rng([seed, size, tables, hashes])
    return (
        draw.standard_normal((size, tables * hashes)),
        draw.random(tables * hashes),
        draw.integers(0, 1 << 62, (tables, hashes)) * 2 + 1,
    )


@lru_cache(maxsize=4)
def probe_sets(hashes: int, probes: int) -> tuple[tuple[int, ...], ...]:
    """Sets of ranks of the 2 * hashes border distances, least expected sum of squares first.

    Ranks r and 2 * hashes - 1 - r are the two borders of one slot and never go together.
    """
    m = hashes
    expected = [(j * (j + 1)) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    expected += [1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1)]
    heap, found = [(expected[0], (0,))], [()]
    while heap and len(found) <= probes:
        total, ranks = heapq.heappop(heap)
        if len({min(r, 2 * m - 1 - r) for r in ranks}) == len(ranks):
            found.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - expected[last] + expected[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (total + expected[last + 1], (*ranks, last + 1)))
    return tuple(found)


def bucket_keys(vectors: np.ndarray, tables: int, hashes: int, width: float, seed: int, probes: int = 0) -> np.ndarray:
    """Keys of the buckets of each vector: (vectors, tables) or, with probes, (vectors, tables, 1 + probes)."""
    directions, shifts, multipliers = projections(vectors.shape[1], tables, hashes, seed)
    at = vectors @ directions / width + shifts
    slots = np.floor(at).astype(np.int64).reshape(len(vectors), tables, hashes)
    with np.errstate(over="ignore"):
        own = (slots * multipliers).sum(axis=2) * 2 * tables + np.arange(tables)
    if not probes:
        return own
    inside = at.reshape(slots.shape) - slots
    distances = np.concatenate([inside, 1 - inside], axis=2)  # to the lower and to the upper border
    ranked = np.argsort(distances, axis=2, kind="stable")
    sets = probe_sets(hashes, probes)
    picks = np.zeros((len(sets), 2 * hashes))
    for k, ranks in enumerate(sets):
        picks[k, list(ranks)] = 1
    # what each rank adds to the key: minus or plus the multiplier of its hash
    with np.errstate(over="ignore"):
        signed = np.concatenate([-multipliers, multipliers], axis=1) * 2 * tables
        steps = signed[np.arange(tables)[None, :, None], ranked]
        total = np.einsum("kr,vtr->vtk", picks.astype(np.int64), steps)
        return own[:, :, None] + total


def distances(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, from the differences themselves."""
    apart = vectors - query
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def hits_needed(tables: int, recall: float = RECALL) -> float:
    """Mean number of tables that met a found neighbour at which ``recall`` of all are found (binomial without its zeros)."""
    return tables * (1 - (1 - recall) ** (1 / tables)) / recall


def usable(vector: Column) -> Column:
    """Not null, not all zero, no null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def classes(vectors: DataFrame, k: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(vec_id, v, row, rep)``: of each class of equal vectors the ``k + 1`` smallest ids, numbered from 1, and the first of them.

    More of them can never be among the ``k`` nearest of anything.
    """
    found = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    found = found.filter(F.col("vec_id").isNotNull()).filter(usable(F.col("v")))
    found = found.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # -0.0 is 0.0
    # each task keeps its own first ones of a class, then the shards' meet
    ranked = found.withColumn("row", F.row_number().over(Window.partitionBy("v").orderBy("vec_id")))
    return ranked.filter(F.col("row") <= k + 1).withColumn("rep", F.min("vec_id").over(Window.partitionBy("v")))


def nearest(
    vectors: DataFrame, k: int = 10, is_query: Column | None = None, id_column: str = "vec_id", vector_column: str = "embedding",
    tables: int = TABLES, hashes: int = HASHES, width: float | None = None, probes: int = PROBES, seed: int = SEED,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of every query, nearest first, ties to the smaller id.

    ``is_query`` tells the query rows by ``id_column`` (all rows by default); a
    query is not its own neighbour but its copies are.  Vectors that are null,
    zero or hold null or non-finite components take no part; rows without id
    neither.  Neighbours have the query's own length; the buckets hold the most
    common length, and queries of others are measured against all of theirs.  A repeated id counts as one more copy.
    The search is approximate only in which vectors it looks at; a query whose
    buckets hold too few, or meet its neighbours in too few tables, is measured against all.
    ``width`` is fitted to the data if not given.
    """
    is_query = F.lit(True) if is_query is None else is_query
    known, _ = settle(classes(vectors, k, id_column, vector_column), "classes")
    lengths = known.filter("row = 1").groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    size = lengths[0]["n"] if lengths else 1
    every = known.filter(F.col("row") == 1).select("rep", "v")
    reps = every.filter(F.size("v") == size)
    asked = vectors.filter(is_query & F.col(id_column).isNotNull() & usable(F.col(vector_column)))
    asked = asked.select(F.col(id_column).cast("long").alias("query_id"), F.transform(F.col(vector_column), lambda x: x.cast("double") + F.lit(0.0)).alias("v"))
    queries, _ = settle(asked.join(every, "v").select("query_id", "rep"), "queries")
    wanted = every.join(queries.select("rep").distinct(), "rep", "left_semi")
    searched, others_searched = wanted.filter(F.size("v") == size), wanted.filter(F.size("v") != size)
    # blocks of the classes of each length
    dealt = every.groupBy(F.size("v").alias("length")).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt, _ = settle(dealt, "dealt")

    def exactly(some: DataFrame) -> DataFrame:
        """``(query_rep, rep, score)``: the nearest of each block of all classes of the query's length."""
        keys = ("length", "block")
        everywhere = every.withColumn("length", F.size("v")).join(dealt, "length")
        everywhere = everywhere.select("rep", "v", "length", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"))
        asked_all = some.select("rep", "v", F.size("v").alias("length")).join(dealt, "length")
        asked_all = asked_all.select("rep", "v", "length", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        return everywhere.groupBy(*keys).cogroup(asked_all.groupBy(*keys)).applyInPandas(measure, "query_rep long, rep long, score double")

    def measure(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_rep": [], "rep": [], "score": []})]
        matrix, ids = np.stack(held["v"].to_numpy()) if len(held) else None, held["rep"].to_numpy()
        for query, vector in zip(asking["rep"], asking["v"], strict=True) if len(held) else ():
            apart = np.concatenate([distances(vector, matrix[i : i + CHUNK]) for i in range(0, len(ids), CHUNK)])
            best = np.lexsort((ids, apart))[: k + 1]
            out.append(pd.DataFrame({"query_rep": query, "rep": ids[best], "score": apart[best]}))
        return pd.concat(out)

    if width is None:
        drawn, _ = settle(searched.orderBy(F.xxhash64(F.lit(seed), "rep"), "rep").limit(SAMPLE), "drawn")
        firsts = exactly(drawn).groupBy("query_rep").agg(F.slice(F.sort_array(F.collect_list("score")), 1, k + 1).alias("near"))
        last = [r["last"] for r in firsts.select(F.array_max("near").alias("last")).collect()]
        last = [x for x in last if 0 < x < float("inf")]
        width = SLOT * float(np.quantile(last, WITHIN)) if last else 1.0

    def keyed(extra: int):
        def make():
            def work(batch: pa.RecordBatch) -> dict:
                found = batch.column(1).values.to_numpy(zero_copy_only=False)[batch.column(1).offsets[0].as_py() : batch.column(1).offsets[-1].as_py()]
                matrix = found.reshape(-1, size)
                keys = bucket_keys(matrix, tables, hashes, width, seed, extra).reshape(len(matrix), -1)
                return {"rep": batch.column(0), "keys": list(keys)}

            return work

        return make

    schema = "rep long, keys array<long>"
    index, _ = settle(map_batches(reps, keyed(0), schema).select("rep", F.explode("keys").alias("key")), "index")
    n_blocks = max(1, -(-index.count() // BLOCK))
    full = index.groupBy("key").count().filter(F.col("count") > FULL).select("key", F.ceil(F.col("count") / FULL).alias("parts"))
    full, _ = settle(full, "full")
    parts = F.coalesce("parts", F.lit(1))
    block = F.pmod(F.xxhash64("key", "part"), F.lit(n_blocks)).cast("int")
    stored = index.join(full, "key", "left").withColumn("part", F.pmod(F.xxhash64("rep"), parts)).select("rep", "key", block.alias("block"))
    stored = stored.join(reps, "rep")
    probed = map_batches(searched, keyed(probes), schema, 64).select("rep", F.explode(F.array_distinct("keys")).alias("key"))
    probed = probed.join(full, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select("rep", "key", block.alias("block"))
    # one row a query and block: at most every key it probes
    visits = probed.groupBy("rep", "block").agg(F.collect_list("key").alias("keys")).join(reps, "rep")

    def search(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(asking):
            return pd.DataFrame({"query_rep": [], "rep": [], "score": [], "hits": []})
        order = np.argsort(held["key"].to_numpy(), kind="stable")
        keys, ids = held["key"].to_numpy()[order], held["rep"].to_numpy()[order]
        matrix = np.stack(held["v"].to_numpy())[order]
        out = []
        for query, wanted, vector in zip(asking["rep"], asking["keys"], asking["v"], strict=True):
            wanted = np.asarray(wanted)
            low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
            hit = high > low
            if not hit.any():
                continue
            rows = np.concatenate([np.arange(a, b) for a, b in zip(low[hit], high[hit], strict=True)])
            found, first, hits = np.unique(ids[rows], return_index=True, return_counts=True)
            rows = rows[first]
            apart = np.concatenate([distances(vector, matrix[rows[i : i + CHUNK]]) for i in range(0, len(rows), CHUNK)])
            best = np.lexsort((found, apart))[: k + 1]
            out.append(pd.DataFrame({"query_rep": query, "rep": found[best], "score": apart[best], "hits": hits[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_rep": [], "rep": [], "score": [], "hits": []})

    met = stored.groupBy("block").cogroup(visits.groupBy("block")).applyInPandas(search, "query_rep long, rep long, score double, hits long")
    # a class among the nearest of all blocks is among those of each block that holds it, so its hits are complete
    met = met.groupBy("query_rep", "rep").agg(F.min("score").alias("score"), F.sum("hits").alias("hits"))
    best = met.withColumn("n", F.row_number().over(Window.partitionBy("query_rep").orderBy("score", "rep"))).filter(F.col("n") <= k + 1)
    found, _ = settle(best.drop("n"), "found")
    # queries whose buckets hold fewer classes than are to be returned, or meet too few, are measured against every block
    others = F.when(F.col("rep") != F.col("query_rep"), F.col("hits"))
    seen = found.groupBy("query_rep").agg(F.count(F.lit(1)).alias("n"), F.avg(others).alias("hits")).withColumnRenamed("query_rep", "rep")
    enough = min(k + 1, reps.count())
    few = (F.coalesce("n", F.lit(0)) < enough) | (F.col("hits") < hits_needed(tables))
    # so are those of another length than most
    short = searched.join(seen, "rep", "left").filter(few).select("rep", "v").unionByName(others_searched.select("rep", "v"))
    short, _ = settle(short, "short")
    found = found.drop("hits")
    if not short.isEmpty():
        met = found.join(short.select(F.col("rep").alias("query_rep")), "query_rep", "left_anti")
        found = met.unionByName(exactly(short))
    # a query's own class is asked for too: its copies are neighbours
    merged = found.distinct().withColumn("n", F.row_number().over(Window.partitionBy("query_rep").orderBy("score", "rep")))
    members = known.groupBy("rep").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k + 1 ids at most
    near = merged.filter(F.col("n") <= k + 1).join(members, "rep").select("query_rep", "score", F.explode("ids").alias("vec_id"))
    # k + 1 classes of k + 1 ids at most
    lists = near.groupBy("query_rep").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    own = queries.join(lists, queries["rep"] == lists["query_rep"]).select(
        "query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near")
    )
    ranked = own.select("query_id", F.posexplode("near").alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
