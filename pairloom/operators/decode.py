"""Decoding ids back into text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.encode import MAX_TOKENS, Tokenizer, encode_documents
from pairloom.session import bounded_rows, settle


def token_table(vocab: DataFrame) -> Column:
    """Hex of every token by id, as a literal folded when the query is planned.

    It has one entry per id and an upper bound, because plans carry it.
    """
    rows = bounded_rows(vocab.select("token_id", F.hex("token").alias("token")), MAX_TOKENS, "the vocabulary")
    size = max((r["token_id"] for r in rows), default=-1) + 1
    if size > MAX_TOKENS:
        raise ValueError(f"token ids must be below {MAX_TOKENS}")
    entries = ["-"] * size
    for r in rows:
        entries[r["token_id"]] = r["token"]
    return F.split(F.lit(" ".join(entries)), " ")


def token_hex(vocab: DataFrame, token_id: Column) -> Column:
    """Hex of one token; null for an unknown id."""
    return F.nullif(F.get(token_table(vocab), token_id), F.lit("-"))


def decode(
    encoded: DataFrame, vocab: DataFrame, ids_col: str = "ids", out_col: str = "text", on_unknown: str = "error"
) -> DataFrame:
    """Text of an id array: bytes are joined first and made valid UTF-8 then.

    Row by row and without a shuffle.  An unknown id raises, or with
    ``on_unknown='null'`` makes the text null.
    """
    if on_unknown not in ("error", "null"):
        raise ValueError("on_unknown must be 'error' or 'null'")
    table = token_table(vocab)
    # one step a token; what is no hex makes the whole null
    parts = F.transform(ids_col, lambda i: F.coalesce(F.get(table, i), F.lit("-")))
    text = F.make_valid_utf8(F.unhex(F.array_join(parts, "")).cast("string"))
    unknown = F.raise_error(F.lit("id without a token")).cast("string") if on_unknown == "error" else F.lit(None).cast("string")
    return encoded.withColumn(out_col, F.when(F.col(ids_col).isNotNull(), F.coalesce(text, unknown)))


def roundtrip_audit(
    docs: DataFrame,
    tokenizer: Tokenizer,
    text_col: str = "text",
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Documents that differ after encoding and decoding: ``(keys..., text, decoded)``.

    Only a text's digest goes along with its ids.  The texts of the rows that
    differ, none unless something is wrong, are fetched afterwards.
    """
    cut = docs.select(*keys, F.col(text_col).alias("text"), F.sha2(text_col, 256).alias("_digest"))
    encoded = encode_documents(cut, tokenizer, "text", (*keys, "_digest"))
    back = decode(encoded, tokenizer.vocab, out_col="decoded")
    differ = F.col("_digest").isNotNull() & ~F.col("_digest").eqNullSafe(F.sha2("decoded", 256))
    # a written table has a size, by which Spark chooses the join
    bad, _ = settle(back.filter(differ).select(*keys, "_digest", "decoded"), "differing")
    if bad.isEmpty():
        return bad.limit(0).select(*keys, F.lit("").alias("text"), "decoded")
    bad = bad.distinct().select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_digest").alias("_of"), "decoded")
    same = F.col("_digest") == F.col("_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return cut.join(bad, same).select(*keys, "text", "decoded")
