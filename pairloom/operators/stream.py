"""One global token stream in fixed-size blocks.

``blocks``: ``(block_id LONG, start_pos LONG, n_ids INT, ids ARRAY<INT>)``;
block ``b`` holds positions ``b * block_size`` onward.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pairloom.operators.running import running_total
from pairloom.session import bounded_rows, settle

BLOCK_SIZE = 4096
MOST_FILES = 1 << 20  # files of a written stream; the driver reads their block ranges


def document_positions(encoded: DataFrame, order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``(order..., n_ids, start_pos)``: where each document starts in the stream."""
    sizes = encoded.select(*order, F.size("ids").cast("long").alias("n_ids"))
    return running_total(sizes, "n_ids", [F.col(c) for c in order], out_col="start_pos")


def flatten_token_stream(
    encoded: DataFrame, order: Sequence[str] = ("doc_id",), block_size: int = BLOCK_SIZE
) -> DataFrame:
    """Blocks of the concatenated documents; ``order`` must be unique per row.

    The ids are shuffled once, into the range layout of ``lay_out``.  There each
    partition is a stretch of the stream, and its blocks are cut where it lies.  Only
    the parts of blocks that reach over the ends of a stretch, two a stretch at most,
    are shuffled to be put together.  No task holds more than a batch of documents
    and one block.
    """
    pieces, _ = settle(cut_blocks(place_stretches(lay_out(encoded, order)), block_size), "pieces")
    whole = pieces.filter(F.size("ids") == block_size)
    parts = pieces.filter(F.size("ids") < block_size)
    shown = whole.select("block_id", F.col("at").alias("start_pos"), F.size("ids").alias("n_ids"), "ids")
    return shown.unionByName(gather_blocks(parts, block_size))


def lay_out(encoded: DataFrame, order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``(part, at, n_ids, ids)``, written: documents in order, ``at`` counted from the start of their partition.

    The running sum is taken while a sorted partition streams by, as a window over
    partitions would shuffle the ids again.  Partition numbers are written with the rows, so a
    task that runs again cannot move a document.
    """
    keys = [F.col(c) for c in order]
    ranged = encoded.select(*order, "ids").repartitionByRange(*keys).sortWithinPartitions(*keys)
    ids = ranged.select(F.spark_partition_id().alias("part"), F.coalesce("ids", F.array().cast("array<int>")).cast("array<int>").alias("ids"))
    schema = T.StructType.fromDDL("part int, at long, n_ids long, ids array<int>")
    return settle(ids.mapInArrow(_number(to_arrow_schema(schema)), schema), "layout")[0]


def _number(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            sizes = pc.list_value_length(batch.column("ids")).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = before + np.cumsum(sizes)
            columns = [batch.column("part"), pa.array(ends - sizes), pa.array(sizes), batch.column("ids").cast(schema.field("ids").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
            before = int(ends[-1]) if len(ends) else before

    return run


def place_stretches(laid: DataFrame) -> DataFrame:
    """``(at, ids)`` with ``at`` counted from the start of the stream.

    Reads the sizes for one total a partition; their running sum is joined back.
    """
    totals = laid.groupBy("part").agg(F.sum("n_ids").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("begin"))
    # one row a partition of the layout
    return laid.join(F.broadcast(begins), "part").select((F.col("begin") + F.col("at")).alias("at"), "ids")


def cut_blocks(placed: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """``(block_id, at, ids)``: blocks, and parts of blocks at the ends of each run of consecutive documents.

    Rows are taken as they come, and any cut of them into runs gives the same blocks
    once their parts are put together, so a file may be read by several tasks.
    """
    schema = T.StructType.fromDDL("block_id long, at long, ids array<int>")
    return placed.mapInArrow(_cut(block_size, to_arrow_schema(schema)), schema)


def _cut(size: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pieces(first: int, ids: np.ndarray, last: bool) -> tuple[pa.RecordBatch | None, int, np.ndarray]:
        """Blocks that end within the ids, all that is left too if no more follows; what is left over."""
        borders = np.arange((first // size + 1) * size, first + len(ids) + 1, size, dtype=np.int64)
        starts = np.concatenate([[first], borders]).astype(np.int64)
        if not last or starts[-1] == first + len(ids):
            starts, rest = starts[:-1], int(starts[-1])
        else:
            rest = first + len(ids)
        if not len(starts):
            return None, first, ids
        ends = np.append(starts[1:], rest) - first
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[: int(ends[-1])]))
        batch = pa.RecordBatch.from_arrays([pa.array(starts // size), pa.array(starts), lists.cast(schema.field("ids").type)], schema=schema)
        return batch, rest, ids[rest - first :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, kept = 0, np.empty(0, np.int32)
        for batch in batches:
            lists = batch.column("ids")
            starts = batch.column("at").to_numpy()
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(sizes)])
            breaks = np.flatnonzero(starts[1:] != starts[:-1] + sizes[:-1]) + 1
            for low, high in zip(np.concatenate([[0], breaks]), np.append(breaks, len(starts))):
                if not len(starts):
                    break
                if starts[low] != first + len(kept):
                    done, _, _ = pieces(first, kept, True)
                    if done is not None:
                        yield done
                    first, kept = int(starts[low]), kept[:0]
                run_ids = np.concatenate([kept, values[upto[low] : upto[high]]]).astype(np.int32, copy=False)
                done, first, kept = pieces(first, run_ids, False)
                if done is not None:
                    yield done
        done, _, _ = pieces(first, kept, True)
        if done is not None:
            yield done

    return run


def gather_blocks(parts: DataFrame, block_size: int) -> DataFrame:
    """Blocks from their parts ``(block_id, at, ids)``."""
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "ids"))), lambda p: p["ids"]))
    return (
        parts.groupBy("block_id")
        .agg(whole.alias("ids"))
        .select(
            "block_id",
            (F.col("block_id") * block_size).alias("start_pos"),
            F.size("ids").alias("n_ids"),
            "ids",
        )
    )


@dataclass(frozen=True)
class StoredStream:
    """A written stream: its blocks and, per file, ``(file, first_block, last_block, n_blocks, n_ids)``."""

    blocks: DataFrame
    manifest: DataFrame

    def blocks_of(self, wanted: Sequence[int]) -> DataFrame:
        """Blocks from the files that may hold one of the wanted ones."""
        asked = np.unique(np.asarray(wanted, np.int64))
        if not len(asked):
            return self.blocks.limit(0)
        files = bounded_rows(self.manifest, MOST_FILES, "the manifest")
        lows = np.searchsorted(asked, [f["first_block"] for f in files], "left")
        highs = np.searchsorted(asked, [f["last_block"] for f in files], "right")
        named = [f["file"] for f, low, high in zip(files, lows, highs) if low < high]
        if not named:
            return self.blocks.limit(0)
        found = self.blocks.sparkSession.read.schema(self.blocks.schema).parquet(*named)
        return found.filter(F.col("block_id").between(int(asked[0]), int(asked[-1])))


def stream_length(blocks: DataFrame | StoredStream) -> int:
    """Number of ids in the stream; of a written one from its manifest."""
    sizes = blocks.manifest if isinstance(blocks, StoredStream) else blocks
    return sizes.agg(F.coalesce(F.sum(F.col("n_ids").cast("long")), F.lit(0))).first()[0]
