"""Reading corpus files."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions.patterns import END_OF_TEXT


ROWS = 256  # decoded at once; bounds Python's copies of the texts


@F.arrow_udf(T.StringType())
def _without_invalid(raw: pa.Array) -> pa.Array:
    def decoded(part: pa.Array) -> pa.Array:
        return pa.array([None if b is None else b.decode("utf-8", errors="ignore") for b in part.to_pylist()], pa.string())

    parts = [decoded(raw.slice(at, ROWS)) for at in range(0, len(raw), ROWS)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def decode_text(raw: Column, on_invalid: str = "replace", normalize_newlines: bool = False) -> Column:
    """Text of a string or binary column whose bytes may not be valid UTF-8.

    ``strict`` raises, ``replace`` puts U+FFFD and ``ignore`` drops the invalid
    bytes; for ``ignore`` only the bytes of invalid rows are sent to Python, the
    others as nulls.
    """
    text = raw.cast("string")
    if on_invalid == "strict":
        valid = F.validate_utf8(text)
    elif on_invalid == "replace":
        valid = F.make_valid_utf8(text)
    elif on_invalid == "ignore":
        good = F.is_valid_utf8(text)
        valid = F.when(good, text).otherwise(_without_invalid(F.when(~good, raw.cast("binary"))))
    else:
        raise ValueError("on_invalid must be 'strict', 'ignore' or 'replace'")
    return F.regexp_replace(valid, "\r\n?", "\n") if normalize_newlines else valid


def read_corpus(
    spark: SparkSession,
    path: str,
    delimiter: str = END_OF_TEXT,
    drop_empty: bool = True,
    on_invalid: str = "replace",
    normalize_newlines: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """``(doc_id, text, file_path, block_start)``, one row per delimited document.

    Spark splits plain files by byte range at the delimiter.  Gzip files cannot
    be split; ``partitions`` spreads what was read over so many tasks, by a
    shuffle of the texts, and is best left to folders of large gzip files.
    ``(file_path, block_start, doc_id)`` is the order of the files.
    """
    raw = spark.read.text(path, lineSep=delimiter).select(
        F.monotonically_increasing_id().alias("doc_id"),
        decode_text(F.col("value"), on_invalid, normalize_newlines).alias("text"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    docs = raw.filter(F.length("text") > 0) if drop_empty else raw
    return docs if partitions is None else docs.repartition(partitions)
