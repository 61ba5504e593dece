"""Vocabulary and merge tables.

``vocab``: ``(token_id INT, token BINARY, kind STRING)``;
``merges``: ``(rank INT, l BINARY, r BINARY)``.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

VOCAB_SCHEMA = "token_id int, token binary, kind string"
MERGES_SCHEMA = "rank int, l binary, r binary"
BYTE_TOKENS = 256


def _listed(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of listed rows, by Arrow: rows of Python objects would start a second set of Python workers, which stay on the executors."""
    fields = to_arrow_schema(T.StructType.fromDDL(schema))
    columns = [pa.array([bytes(x) if isinstance(x, bytearray) else x for x in (r[k] for r in rows)], f.type) for k, f in enumerate(fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=fields), schema)


def base_vocab(spark: SparkSession, special_tokens: Sequence[str] = ()) -> DataFrame:
    """The 256 bytes as ids 0..255, then the special tokens in the given order."""
    single = spark.range(0, BYTE_TOKENS, 1, 1).select(
        F.col("id").cast("int").alias("token_id"),
        F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("token"),
        F.lit("byte").alias("kind"),
    )
    if not special_tokens:
        return single
    rows = [(BYTE_TOKENS + i, bytearray(t.encode()), "special") for i, t in enumerate(special_tokens)]
    return single.unionByName(_listed(spark, rows, VOCAB_SCHEMA))


def merged_vocab(
    spark: SparkSession, merges: Sequence[tuple[bytes, bytes]], special_tokens: Sequence[str] = ()
) -> DataFrame:
    """Base vocabulary followed by one token per merge, in rank order."""
    base = base_vocab(spark, special_tokens)
    first = BYTE_TOKENS + len(special_tokens)
    rows = [(first + k, bytearray(l + r), "merge") for k, (l, r) in enumerate(merges)]
    return base.unionByName(_listed(spark, rows, VOCAB_SCHEMA)) if rows else base


def merges_table(spark: SparkSession, merges: Sequence[tuple[bytes, bytes]]) -> DataFrame:
    rows = [(k, bytearray(l), bytearray(r)) for k, (l, r) in enumerate(merges)]
    return _listed(spark, rows, MERGES_SCHEMA)


def with_special_tokens(vocab: DataFrame, special_tokens: Sequence[str]) -> DataFrame:
    """Append the special tokens that the vocabulary lacks, from id ``count`` on."""
    if not special_tokens:
        return vocab
    spark = vocab.sparkSession
    wanted = _listed(spark, [(i, bytearray(t.encode())) for i, t in enumerate(dict.fromkeys(special_tokens))], "place int, token binary")
    missing = wanted.join(vocab.select("token"), "token", "left_anti").orderBy("place").collect()
    if not missing:
        return vocab
    size = vocab.count()
    rows = [(size + i, r["token"], "special") for i, r in enumerate(missing)]
    return vocab.select("token_id", "token", "kind").unionByName(_listed(spark, rows, VOCAB_SCHEMA))


def vocab_lookup(vocab: DataFrame) -> DataFrame:
    """``(token, token_id)``: of equal tokens the last id counts."""
    return vocab.groupBy("token").agg(F.max("token_id").alias("token_id"))


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either table that the other lacks, with the side that has them."""
    columns = left.columns
    right = right.select(*columns)
    return (
        left.exceptAll(right)
        .withColumn("side", F.lit("left"))
        .unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
    )


def verify_tokenizer(
    vocab: DataFrame, merges: DataFrame, other_vocab: DataFrame, other_merges: DataFrame
) -> DataFrame:
    """Differences between two tokenizers as ``(part, id, l, r, side)``; empty if equal."""
    parts = []
    for name, one, two in (("vocab", vocab, other_vocab), ("merges", merges, other_merges)):
        if name == "vocab":
            shape = [F.col("token_id").alias("id"), F.hex("token").alias("l"), F.lit("").alias("r")]
        else:
            shape = [F.col("rank").alias("id"), F.hex("l").alias("l"), F.hex("r").alias("r")]
        parts.append(
            table_difference(one.select(*shape), two.select(*shape)).select(F.lit(name).alias("part"), "*")
        )
    return parts[0].unionByName(parts[1])
