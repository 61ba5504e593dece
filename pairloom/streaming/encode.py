"""Encoding an unbounded source with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairloom.functions.patterns import lines
from pairloom.operators.encode import Tokenizer, encode_documents
from pairloom.session import settle

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def text_stream(spark: SparkSession, path: str, delimiter: str | None = None, by_line: bool = True) -> DataFrame:
    """``(text, file_path)`` rows of the files that arrive in a folder.

    Each line is a text with its own line feed, if it has one, or with
    ``by_line=False`` each file.  A file is one row at first; with ``delimiter``
    each document is, for files too large for that, and the delimiters go.  Large
    files of lines are read in splits by ``encode_files``.
    """
    if delimiter is None:
        files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).load(path)
        raw = files.select(F.make_valid_utf8(F.col("content").cast("string")).alias("value"), F.col("path").alias("file_path"))
    else:
        raw = spark.readStream.option("lineSep", delimiter).text(path).select("value", F.col("_metadata.file_path").alias("file_path"))
    text = F.explode(lines(F.col("value"))) if by_line else F.col("value")
    return raw.select(text.alias("text"), "file_path")


def line_stream(spark: SparkSession, path: str) -> DataFrame:
    """``(value, file_path, block_start, file_size)``: the lines of the files that arrive in a folder, without line feeds.

    Spark splits plain files by byte range, so a file of any size is read by as
    many tasks as it has splits, and no task holds more than a line.  Only a line
    feed ends a line.  ``with_line_feeds`` gives the lines back whole.
    """
    raw = spark.readStream.option("lineSep", "\n").text(path)
    return raw.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def with_line_feeds(lines: DataFrame) -> DataFrame:
    """``(text, file_path, block_start, line)`` of a batch of whole files from ``line_stream``.

    Every line gets its line feed but a last one that has none: the lines of such a
    file, each with one more byte, are one byte longer than the file.  The sizes are
    added up per file inside tasks; the last line is the one of the last split that
    holds any, and the last in it.  Of a compressed file the size is not known, and its
    last line counts as ended.  ``(file_path, block_start, line)`` is the order of the lines.
    """
    placed = lines.withColumn("line", F.monotonically_increasing_id())
    per_file = placed.groupBy("file_path").agg(
        F.sum(F.octet_length("value") + F.lit(1).cast("long")).alias("bytes"),
        F.max("file_size").alias("file_size"),
        F.max(F.struct("block_start", "line")).alias("last"),
    )
    open_ended, _ = settle(per_file.filter("bytes = file_size + 1").select(F.col("last.line").alias("line"), F.lit("").alias("end")), "open-ended")
    text = F.concat(F.make_valid_utf8("value"), F.coalesce("end", F.lit("\n")))
    return placed.join(open_ended, "line", "left").select(text.alias("text"), "file_path", "block_start", "line")


def encode_files(spark: SparkSession, path: str, tokenizer: Tokenizer, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Encode the lines of arriving files, however large, to ``out`` as ``(file_path, block_start, line, ids, batch)``.

    A batch holds whole files.  It is written to a folder of its own that is
    overwritten if the batch runs again, so restarts leave each line once.
    """

    def write(batch: DataFrame, number: int) -> None:
        texts = with_line_feeds(batch)
        ids = encode_documents(texts, tokenizer, keys=("file_path", "block_start", "line"))
        ids.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = line_stream(spark, path).writeStream.foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start()


def encode_stream(
    source: DataFrame,
    tokenizer: Tokenizer,
    text_col: str = "text",
    keys: Sequence[str] = ("doc_id",),
    unit: str = "document",
) -> DataFrame:
    """Streaming ``(keys..., ids)``: stateless, append-only and without a shuffle."""
    if not source.isStreaming:
        raise ValueError("encode_stream needs a streaming table")
    return encode_documents(source, tokenizer, text_col, keys, unit)


def write_encoded(encoded: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start the query into a Parquet folder; restarts continue from ``checkpoint``."""
    writer = encoded.writeStream.format("parquet").outputMode("append")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start(path)
