"""Packing documents into fixed windows by a non-negative least squares plan.

Each document is cut into whole windows, one piece that is a multiple of
``UNIT`` tokens, and a tail shorter than that.  Shallow combinations of unit
lengths that fill a window exactly are enumerated; non-negative least squares
finds how often each is to be repeated so that together they use up the
histogram of pieces.  The counts are rounded down to what the pieces allow,
pieces take their slots by rank, and what is left over, tails included, is
packed greedily, best fit first, in groups of bounded size.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import kind_of, map_batches
from pairloom.llm.tokens import PIECES
from pairloom.session import settle

WINDOW = 2048
UNIT = 64
#: Pieces in one combination at most.
DEPTH = 5
END_ID = 1
#: Rows that are ranked together, and bound on the number of such groups.
RANKED = 1000
MOST_RANKS = 100_000
#: Left-over pieces that are packed together.
GREEDY = 8192
STRIDE = 1 << 24


@lru_cache(maxsize=2)
def encoder(path: str, special: tuple[tuple[str, int], ...] = ()):
    """A function from text to ids.  ``.tiktoken`` rank files are the fast form of the same vocabulary."""
    if path.endswith(".tiktoken"):
        import base64

        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        known = tiktoken.Encoding("pack", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=dict(special))
        return lambda text: known.encode(text, allowed_special="all")
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(path)
    return lambda text: known.encode(text, add_special_tokens=False).ids


def cut(total: int, window: int, unit: int) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces."""
    rest = total % window
    main = rest // unit * unit
    found = [(at, window) for at in range(0, total - rest, window)]
    if main:
        found.append((total - rest, main))
    if rest - main:
        found.append((total - rest + main, rest - main))
    return found


def pieces(
    docs: DataFrame, path: str, special: tuple[tuple[str, int], ...] = (), window: int = WINDOW, unit: int = UNIT,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens)`` of every piece; null text is empty, each document ends in ``END_ID``."""

    def make():
        encode = encoder(path, special)

        def work(batch: pa.RecordBatch) -> dict:
            rows: list[tuple] = []
            take: list[int] = []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                for start, length in cut(len(ids), window, unit):
                    take.append(k)
                    rows.append((start, length, zlib.crc32(ids[start : start + length]), len(ids)))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            return dict(zip(("start", "length", "ids_crc32", "doc_tokens"), map(list, columns), strict=True)) | {
                id_column: batch.column(0).take(pa.array(take, pa.int64()))
            }

        return work

    schema = f"`{id_column}` {kind_of(docs, id_column)}, start long, length long, ids_crc32 long, doc_tokens long"
    return map_batches(docs.select(id_column, text_column), make, schema)


def combinations(total: int, depth: int) -> list[tuple[int, ...]]:
    """Ways to write ``total`` as a sum of at most ``depth`` positive whole numbers, largest first."""

    def filled(rest: int, most: int, left: int) -> list[tuple[int, ...]]:
        if not rest:
            return [()]
        if not left:
            return []
        return [(n, *more) for n in range(min(rest, most), 0, -1) if n * left >= rest for more in filled(rest - n, n, left - 1)]

    return filled(total, total, depth)


def non_negative(matrix: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """``x >= 0`` that minimises the squared length of ``matrix @ x - wanted``, by active sets."""
    n = matrix.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-10 * max(1.0, np.abs(matrix.T @ wanted).max())
    for _ in range(10 * n):
        slope = matrix.T @ (wanted - matrix @ x)
        slope[free] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= tolerance:
            break
        free[best] = True
        while True:
            z = np.zeros(n)
            z[free] = np.linalg.lstsq(matrix[:, free], wanted, rcond=None)[0]
            low = free & (z <= 1e-12)
            if not low.any():
                x = z
                break
            with np.errstate(divide="ignore", invalid="ignore"):
                x = x + np.min(x[low] / (x[low] - z[low]), initial=1.0) * (z - x)
            free &= x > 1e-12
            x[~free] = 0
            if not free.any():
                break
    return x


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """``(combination, repeats)``: windows that the pieces of ``histogram`` (index: units - 1) fill exactly."""
    if not histogram.sum():
        return []
    units = len(histogram)
    ways = combinations(units, depth)
    matrix = np.zeros((units, len(ways)))
    for k, way in enumerate(ways):
        for u in way:
            matrix[u - 1, k] += 1
    weight = 0.5 + np.arange(1, units + 1) / units  # long pieces are harder to place later
    repeats = np.floor(non_negative(matrix * weight[:, None], histogram / histogram.sum() * weight) * histogram.sum() + 1e-6)
    while (over := matrix @ repeats - histogram).max() > 0:
        u = int(over.argmax())
        k = int(np.where(matrix[u] > 0, repeats, -1).argmax())
        repeats[k] -= min(repeats[k], np.ceil(over[u] / matrix[u, k]))
    return [(ways[k], int(repeats[k])) for k in np.flatnonzero(repeats)]


def slots(planned: list[tuple[tuple[int, ...], int]], unit: int) -> list[tuple[int, int, int, int, int]]:
    """``(units, low, high, first sequence, offset)``: pieces of these ranks fill this place of these sequences."""
    used: dict[int, int] = {}
    found, sequence = [], 0
    for way, repeats in planned:
        offset = 0
        for u in way:
            low = used.get(u, 0)
            used[u] = low + repeats
            found.append((u, low, low + repeats, sequence, offset))
            offset += u * unit
        sequence += repeats
    return found


def greedy(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece: longest first, each into the fullest sequence that still has room."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_, rooms, made = [[] for _ in range(window + 1)], 0, 0  # rooms: bit r is set if a sequence has r places left
    for k in np.argsort(-lengths, kind="stable"):
        length = int(lengths[k])
        if fit := rooms >> length:
            room = length + (fit & -fit).bit_length() - 1
            at = open_[room].pop()
            if not open_[room]:
                rooms ^= 1 << room
        else:
            room, at, made = window, made, made + 1
        sequence[k], offset[k] = at, window - room
        if room > length:
            open_[room - length].append(at)
            rooms |= 1 << (room - length)
    return sequence, offset


def pack(cut_pieces: DataFrame, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH, id_column: str = "doc_id") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; every row comes back once.

    Pieces longer than ``window`` are refused.  An empty table gives an empty
    table; rows that are equal in all columns are interchangeable.
    """
    if window % unit:
        raise ValueError("the window has to be a multiple of the unit")
    spark = cut_pieces.sparkSession
    units = F.when((F.col("length") % unit == 0) & (F.col("length") > 0), (F.col("length") / unit).cast("int")).otherwise(0)
    rows, _ = settle(
        cut_pieces.withColumn("_units", units).withColumn("_hash", F.xxhash64(F.col(id_column), F.col("start"), F.col("ids_crc32"))), "pieces"
    )
    if rows.filter(F.col("length") > window).limit(1).count():
        raise ValueError(f"a piece is longer than {window}")
    counted = {r["_units"]: r["n"] for r in rows.groupBy("_units").agg(F.count(F.lit(1)).alias("n")).collect()}  # window / unit rows at most
    planned = plan(np.array([counted.get(u, 0) for u in range(1, window // unit + 1)], float), depth)
    total = sum(counted.values())
    buckets = max(1, -(-total // max(RANKED, total // MOST_RANKS)))
    bucketed = rows.withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
    whole = bucketed.filter("_units > 0")
    before = Window.partitionBy("_units").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.groupBy("_units", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_units", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_units", "_bucket").orderBy("_hash", id_column, "start", "length", "ids_crc32", "doc_tokens")
    ranked = whole.withColumn("_row", F.row_number().over(inside)).join(starts, ["_units", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_start") + F.col("_row") - 1).drop("_start", "_row")
    places = spark.createDataFrame(slots(planned, unit), "_u int, _low long, _high long, _first long, _offset long")
    # a basic solution has at most one combination a unit length, so this is a table of window / unit * depth rows
    hit = (F.col("_units") == F.col("_u")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high"))
    placed, _ = settle(ranked.join(F.broadcast(places), hit, "left"), "placed")
    out = ["`" + c + "`" for c in cut_pieces.columns]
    exact = placed.filter("_u is not null").selectExpr(*out, "_first + _rank - _low as sequence_id", "_offset as offset")
    rest = placed.filter("_u is null").select(*out, "_hash").unionByName(bucketed.filter("_units = 0").select(*out, "_hash"))
    left = total - sum(len(way) * n for way, n in planned)
    groups = max(1, -(-left // GREEDY))
    first = sum(n for _, n in planned)
    names = list(cut_pieces.columns)

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_hash", "start", "length", "ids_crc32"], kind="stable", ignore_index=True)
        sequence, offset = greedy(frame["length"].to_numpy(), window)
        return frame[names].assign(sequence_id=first + frame["_group"] * STRIDE + sequence, offset=offset)

    schema = ", ".join(f"`{c}` {kind_of(cut_pieces, c)}" for c in names) + ", sequence_id long, offset long"
    grouped = rest.withColumn("_group", F.pmod(F.shiftrightunsigned("_hash", 20), F.lit(groups)))
    return exact.unionByName(grouped.groupBy("_group").applyInPandas(fill, schema))


def pack_documents(
    docs: DataFrame, path: str, special: tuple[tuple[str, int], ...] = (), window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Documents to ``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, one row a piece.

    A null or empty text is the single id ``END_ID``; null ids stay null;
    repeated rows are packed once each; other columns are not looked at.
    """
    return pack(pieces(docs, path, special, window, unit, id_column, text_column), window, unit, depth, id_column)
