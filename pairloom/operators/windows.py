"""Fixed-length training windows over a token stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.draws import hashed_long
from pairloom.operators.stream import BLOCK_SIZE, StoredStream, stream_length

MOST_BLOCKS = 100_000  # blocks whose files are looked up; with more windows the whole stream is read


def windows_at(
    blocks: DataFrame | StoredStream,
    starts: DataFrame,
    context_length: int,
    block_size: int = BLOCK_SIZE,
    key: str = "sample_id",
    on_short: str = "error",
) -> DataFrame:
    """``(key, start_pos, x, y)`` for ``starts (key, start_pos)``; y is x shifted by one.

    Each start names the blocks it touches and joins them on equality.  Only
    the part of a block that lies in the window goes on to be put together.
    Every start gives a row.  A window that reaches outside the stream raises, or
    with ``on_short='null'`` has null x and y.  ``key`` tells the starts apart.
    Of a written stream (``open_token_stream``) only the files are read whose
    blocks are touched, as long as the windows are few.
    """
    if context_length < 1:
        raise ValueError("context_length must be at least 1")
    if on_short not in ("error", "null"):
        raise ValueError("on_short must be 'error' or 'null'")
    need = context_length + 1
    touched = F.sequence(
        F.expr(f"start_pos div {block_size}"), F.expr(f"(start_pos + {context_length}) div {block_size}")
    )
    wanted = starts.select(F.col(key), F.col("start_pos").alias("begin"), F.explode(touched).alias("block_id"))
    if isinstance(blocks, StoredStream):
        rows = wanted.select("block_id").distinct().limit(MOST_BLOCKS + 1).collect()
        blocks = blocks.blocks_of([r["block_id"] for r in rows]) if len(rows) <= MOST_BLOCKS else blocks.blocks
    found = wanted.join(blocks.select("block_id", F.col("start_pos").alias("at"), "ids"), "block_id")
    skipped = F.greatest(F.col("begin") - F.col("at"), F.lit(0))
    wished = F.col("begin") + need - F.col("at") - skipped
    part = F.slice("ids", (skipped + 1).cast("int"), wished.cast("int"))
    joined = (
        found.select(key, "begin", "block_id", part.alias("part"))
        .groupBy(key, "begin")
        .agg(F.array_sort(F.collect_list(F.struct("block_id", "part"))).alias("parts"))
        .select(key, "begin", F.flatten(F.transform("parts", lambda p: p["part"])).alias("ids"))
        .filter((F.size("ids") == need) & (F.col("begin") >= 0))
    )
    every = starts.select(key, "start_pos").join(joined.select(key, F.col("begin").alias("start_pos"), "ids"), [key, "start_pos"], "left")
    if on_short == "error":
        short = F.raise_error(F.lit("a window reaches outside the stream")).cast("array<int>")
        every = every.withColumn("ids", F.coalesce("ids", short))
    return every.select(
        key,
        "start_pos",
        F.slice("ids", 1, context_length).alias("x"),
        F.slice("ids", 2, context_length).alias("y"),
    )


def sample_starts(blocks: DataFrame | StoredStream, n: int, context_length: int, seed: int) -> DataFrame:
    """``n`` uniform starts in ``[0, length - context_length)``, with replacement."""
    room = stream_length(blocks) - context_length
    if room <= 0:
        raise ValueError("the stream is not longer than the context")
    spark = (blocks.blocks if isinstance(blocks, StoredStream) else blocks).sparkSession
    ids = spark.range(n).withColumnRenamed("id", "sample_id")
    return ids.select("sample_id", F.pmod(hashed_long(seed, F.col("sample_id")), F.lit(room)).alias("start_pos"))


def sample_windows(
    blocks: DataFrame | StoredStream, n: int, context_length: int, seed: int = 0, block_size: int = BLOCK_SIZE
) -> DataFrame:
    """``n`` random windows; the draw depends on the seed and the sample number alone.

    A written stream gives its length from the manifest, and only files with drawn blocks are read.
    """
    return windows_at(blocks, sample_starts(blocks, n, context_length, seed), context_length, block_size)
