"""Exact top-k by inner product with MaxScore.

Vectors are lists of whole-number term weights: each term has postings, the
rows where it is not zero.  In a shard of rows the most that a query's term can
add is its bound.  Terms sorted by bound split in two: the larger, essential
ones are traversed, and the smaller ones probed only for rows that can still
reach the score to beat with the bounds of what is left to probe.  A shard
where all bounds of a query together stay below that score is passed over.
The score to beat is the k-th of the query in one shard that all queries meet
first; the shards' winners are merged.

Postings lie as columns of a matrix, so the essential postings of many queries
are traversed at once, as a matrix product in which other terms weigh nothing.
All numbers are whole and below the precision of their type, so sums are exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import settle

#: Rows of a shard, and queries that meet it in one task: in the first shard and in the others.
SHARD = 8192
EARLY = 1024
QUERIES = 8192
#: Rows of a shard that are scored first where no score to beat is known.
FIRST = 512
#: Queries whose essential postings are traversed at once.
TOGETHER = 256
#: Non-essential are the smallest bounds that together stay below this share of the score to beat.
MARGIN = 0.25
#: Probed terms between two looks at which rows are still competitive.
PROBED = 4
#: Stands for no score to beat.
NEVER = -(1 << 61)

Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def exact_type(size: int, most: int) -> type:
    """The fastest type that holds every sum of ``size`` products of weights up to ``most``."""
    largest = size * most * most
    return np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64


def _best(found: Found, k: int, n: int) -> tuple[Found, np.ndarray]:
    """The ``k`` best rows of each of ``n`` queries, ties to the smaller row, and the k-th scores (``NEVER``: fewer)."""
    query, row, score = found
    order = np.lexsort((row, -score, query))
    query, row, score = query[order], row[order], score[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    last = np.full(n, NEVER)
    last[query[rank == k - 1]] = score[rank == k - 1]
    keep = rank < k
    return (query[keep], row[keep], score[keep]), last


class Shard:
    """Postings of some rows, in order of their ids.

    ``pairs`` counts the rows that queries met, ``probed`` those that were still competitive after the essential terms.
    """

    def __init__(self, ids: np.ndarray, weights: np.ndarray, kind: type = np.float64):
        order = np.argsort(ids, kind="stable")
        self.ids, self.weights = ids[order], np.ascontiguousarray(weights[order], kind)
        self.pairs = self.probed = 0
        if len(ids):
            self.most, self.least = self.weights.max(axis=0), self.weights.min(axis=0)

    def _scan(self, queries: np.ndarray, low: int, high: int, beat: np.ndarray, names: np.ndarray | None) -> Found:
        """``(query, row, score)`` of the rows from ``low`` to ``high`` that reach the queries' scores to beat."""
        self.pairs += len(queries) * (high - low)
        beat = beat.astype(queries.dtype)
        bounds = np.maximum(np.maximum(queries * self.most, queries * self.least), 0)
        live = np.flatnonzero(bounds.sum(axis=1) >= beat)  # the others cannot win here
        queries, bounds, beat = queries[live], bounds[live], beat[live]
        order = np.argsort(bounds, axis=1, kind="stable")
        below = np.cumsum(np.take_along_axis(bounds, order, axis=1), axis=1)
        split = (below < MARGIN * beat[:, None]).sum(axis=1)
        place = np.argsort(order, axis=1)
        essential = np.where(place >= split[:, None], queries, 0).astype(queries.dtype)
        rows = self.weights[low:high]
        scores = essential @ rows.T
        left = np.where(split > 0, below[np.arange(len(live)), split - 1], 0)
        query, row = np.nonzero(scores >= (beat - left)[:, None])
        score = scores[query, row]
        self.probed += len(query)
        for done in range(0, int(split.max(initial=0)), PROBED):
            for k in range(done, done + PROBED):
                at = split[query] - 1 - k
                term = order[query, np.maximum(at, 0)]
                score = score + np.where(at >= 0, queries[query, term] * rows[row, term], 0)
            at = split[query] - 1 - done - PROBED
            able = score + np.where(at >= 0, below[query, np.maximum(at, 0)], 0) >= beat[query]
            query, row, score = query[able], row[able], score[able]
        query, row = live[query], row + low
        score = score.astype(np.int64)
        if names is not None:
            other = self.ids[row] != names[query]
            query, row, score = query[other], row[other], score[other]
        return query, row, score

    def best(self, queries: np.ndarray, k: int, beat: np.ndarray | None = None, names: np.ndarray | None = None) -> Found:
        """``(query, row, score)``: each query's ``k`` best rows with other ids than its own (``names``), best first.

        Rows below ``beat``, a score that ``k`` rows are known to reach (or ``NEVER``), may be missing.
        """
        n, out = len(self.ids), []
        for at in range(0, len(queries) if n else 0, TOGETHER):
            some = queries[at : at + TOGETHER].astype(self.weights.dtype)
            own = None if names is None else names[at : at + TOGETHER]
            goal = np.full(len(some), NEVER) if beat is None else beat[at : at + TOGETHER]
            parts, start = [], 0
            if (goal == NEVER).any():
                start = min(n, max(FIRST, 2 * k))
                first, reached = _best(self._scan(some, 0, start, np.full(len(some), NEVER), own), k, len(some))
                parts, goal = [first], np.maximum(goal, reached)
            if start < n:
                parts.append(self._scan(some, start, n, goal, own))
            query, row, score = _best(tuple(map(np.concatenate, zip(*parts, strict=True))), k, len(some))[0]
            out.append((query + at, row, score))
        return tuple(map(np.concatenate, zip(*out, strict=True))) if out else (np.zeros(0, np.int64),) * 3

    def top(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows, best first, ties to the smaller id."""
        _, row, score = self.best(query[None, :], k)
        return self.ids[row], score


def weights_of(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component in double precision; null if a component is null or not finite."""
    wide = vector.cast("array<double>")
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(wide, lambda x: F.floor(x * F.lit(float(scale))).cast("long")))


def top_products(
    vectors: DataFrame, k: int = 20, is_query: Column | None = None, scale: int = 64, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of highest inner product of every query, ties to the smaller id.

    ``is_query`` tells the query rows (all by default).  A query does not find
    rows of its own id.  Null vectors, vectors with a null or non-finite
    component and rows without id take no part; shorter vectors miss the later
    terms; empty ones score 0.  Scores have to fit a long.  Repeated rows are found repeatedly.
    Rows and queries are dealt evenly, whatever their ids.
    """
    is_query = F.lit(True) if is_query is None else is_query
    usable = vectors.select(
        F.col(id_column).cast("long").alias("id"), weights_of(F.col(vector_column), scale).alias("w"), is_query.alias("asks")
    ).filter("id is not null and w is not null")
    # the place in the table spreads rows that share an id
    rows, _ = settle(usable.withColumn("spread", F.xxhash64("id", F.monotonically_increasing_id())), "weights")
    n, asking, size, high, low = rows.agg(
        F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1)), F.max(F.size("w")), F.max(F.array_max("w")), F.min(F.array_min("w"))
    ).first()
    shards, size, most = max(1, -(-n // SHARD)), max(1, size or 1), max(high or 0, -(low or 0))
    kind = exact_type(size, most)
    rows = rows.withColumn("shard", F.pmod("spread", F.lit(shards)).cast("int"))
    if most < 1 << 15:
        rows = rows.withColumn("w", F.col("w").cast("array<smallint>"))

    def matrix(lists: pd.Series) -> np.ndarray:
        if len(lists) and all(len(x) == size for x in lists):
            return np.stack(lists.to_numpy())
        out = np.zeros((len(lists), size), np.int64)
        for k_, x in enumerate(lists):
            out[k_, : len(x)] = x
        return out

    def search(held: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        shard = Shard(held["id"].to_numpy(), matrix(held["w"]), kind)
        names = queries["query_id"].to_numpy()
        query, row, score = shard.best(matrix(queries["v"]), k, queries["beat"].to_numpy(np.int64), names)
        return pd.DataFrame({"query_id": names[query], "vec_id": shard.ids[row], "score": score})

    def meet(held: DataFrame, asked: DataFrame, together: int, others: list[int]) -> DataFrame:
        """Winners of each pair of a shard and a block of queries ``(query_id, v, spread, beat)``."""
        blocks = max(1, -(-asking // together))
        held = held.select("id", "w", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        block = F.pmod(F.shiftrightunsigned("spread", 20), F.lit(blocks)).cast("int")
        asked = asked.select("query_id", "v", "beat", F.explode(F.sequence(F.lit(others[0]), F.lit(others[-1]))).alias("shard"), block.alias("block"))
        keys = ("shard", "block")
        return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    asked = rows.filter("asks").select(F.col("id").alias("query_id"), F.col("w").alias("v"), F.col("spread").alias("spread"))
    found = meet(rows.filter("shard = 0"), asked.withColumn("beat", F.lit(NEVER)), EARLY, [0])
    if shards > 1:
        early, _ = settle(found, "early")
        reached = early.withColumn("rank", rank).filter(F.col("rank") == k).select("query_id", F.col("score").alias("beat"))
        known = asked.join(reached, "query_id", "left").withColumn("beat", F.coalesce("beat", F.lit(NEVER)))
        found = early.unionByName(meet(rows.filter("shard > 0"), known, QUERIES, [1, shards - 1]))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
