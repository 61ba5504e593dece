"""Encoding text into token ids.

Spark cuts the text at special tokens, and whole texts pass through Arrow batches
to a small helper that cuts them into pieces and looks at each distinct piece of
a slice once.  Other patterns than the usual one are cut by Spark's regular expressions.  Encoding is a narrow map: it never shuffles, so neither the size of the
corpus nor a frequent pre-token makes any task larger, and the same function
serves batch and streaming tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions import cuts, patterns
from pairloom.functions.bpe import PieceEncoder, spread
from pairloom.operators import vocab as vocabularies
from pairloom.session import bounded_rows

MAX_TOKENS = 1 << 22  # the merge and vocabulary tables are broadcast, so they have a bound
MAX_ID = (1 << 31) - 1
MOST_PIECES = 1 << 18  # encoded at once; bounds a task's memory
MOST_BYTES = 1 << 21  # of texts, likewise


@dataclass(frozen=True)
class Tokenizer:
    """Vocabulary and merge tables with the special tokens to keep whole."""

    vocab: DataFrame
    merges: DataFrame
    special_tokens: tuple[str, ...] = ()
    pattern: str = patterns.PRETOKEN_PATTERN

    def __post_init__(self) -> None:
        full = vocabularies.with_special_tokens(self.vocab, self.special_tokens)
        object.__setattr__(self, "vocab", full)

    def merge_list(self) -> list[tuple[bytes, bytes]]:
        rows = bounded_rows(self.merges, MAX_TOKENS, "the merge table")
        return [(bytes(r["l"]), bytes(r["r"])) for r in sorted(rows, key=lambda r: r["rank"])]

    def token_ids(self) -> dict[bytes, int]:
        rows = bounded_rows(vocabularies.vocab_lookup(self.vocab), MAX_TOKENS, "the vocabulary")
        ids = {bytes(r["token"]): r["token_id"] for r in rows}
        if any(not 0 <= i <= MAX_ID for i in ids.values()):
            raise ValueError("token ids must fit a non-negative INT")
        return ids

    def id_of(self, token: str) -> int:
        """The id of a special token."""
        found = self.vocab.filter(F.col("token") == F.encode(F.lit(token), "UTF-8")).agg(F.max("token_id")).first()[0]
        if token not in self.special_tokens or found is None:
            raise ValueError(f"{token!r} is not a special token of this tokenizer")
        return found

    @classmethod
    def from_files(cls, spark: SparkSession, vocab_path: str, merges_path: str, special_tokens: Sequence[str] = ()) -> Tokenizer:
        """From vocabulary and merge files."""
        from pairloom.sources import artifacts

        return cls(artifacts.read_vocab(spark, vocab_path), artifacts.read_merges(spark, merges_path), tuple(special_tokens))

    def shipped(self) -> Broadcast:
        """What an encoding task needs, as a broadcast of bounded size."""
        context = self.vocab.sparkSession.sparkContext
        return context.broadcast((self.merge_list(), self.token_ids(), self.special_tokens))


def _encode_batch(pieces: pa.ListArray, encoder: PieceEncoder) -> pa.ListArray:
    """Ids per row; each distinct piece of the batch is encoded once."""
    offsets = pieces.offsets.to_numpy()
    return _ids(pieces.flatten(), offsets - offsets[0], encoder)


def _ids(pieces: pa.Array, offsets: np.ndarray, encoder: PieceEncoder) -> pa.ListArray:
    """Ids of the pieces of rows that begin at ``offsets``."""
    coded = pieces.dictionary_encode()
    pool, sizes = encoder.encode(coded.dictionary)
    which = coded.indices.to_numpy(zero_copy_only=False)
    counts = sizes[which]
    ends = np.concatenate(([0], np.cumsum(counts)))
    source = spread((np.cumsum(sizes) - sizes)[which], counts)
    row_ends = ends[offsets]
    return pa.ListArray.from_arrays(pa.array(row_ends, pa.int32()), pa.array(pool[source], pa.int32()))


def _shorter(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``MOST_PIECES`` pieces, one row at least."""
    offsets = batch.column(column).offsets.to_numpy()
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + MOST_PIECES, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def encode_pieces(frame: DataFrame, tokenizer: Tokenizer, pieces_col: str, out_col: str = "ids") -> DataFrame:
    """Replace an ``ARRAY<STRING>`` column of pieces by ``ARRAY<INT>`` ids, in place of order."""
    shipped = tokenizer.shipped()
    kept = [f for f in frame.schema.fields if f.name != pieces_col]
    schema = T.StructType([*kept, T.StructField(out_col, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(*shipped.value)
        for whole in batches:
            for batch in _shorter(whole, pieces_col):
                ids = _encode_batch(batch.column(pieces_col), encoder)
                columns = [batch.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, ids], [*(f.name for f in kept), out_col])

    none = F.array().cast("array<string>")
    return frame.withColumn(pieces_col, F.coalesce(pieces_col, none)).mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``MOST_BYTES`` bytes of texts, one row at least."""
    if not batch.num_rows:
        return
    lists = batch.column(column)
    offsets = lists.offsets.to_numpy()
    sizes = pc.binary_length(lists.flatten()).to_numpy(zero_copy_only=False)
    upto = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))[offsets - offsets[0]]
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + MOST_BYTES, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def encode_parts(frame: DataFrame, tokenizer: Tokenizer, parts_col: str, out_col: str = "ids") -> DataFrame:
    """Replace an ``ARRAY<STRING>`` column of special tokens and the texts between them by ``ARRAY<INT>`` ids, in place of order."""
    shipped, kinds = tokenizer.shipped(), cuts.kinds(frame.sparkSession)
    kept = [f for f in frame.schema.fields if f.name != parts_col]
    schema = T.StructType([*kept, T.StructField(out_col, T.ArrayType(T.IntegerType(), False))])
    special = pa.array(list(tokenizer.special_tokens), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, known = PieceEncoder(*shipped.value), kinds.value
        for all_rows in batches:
            for batch in _slices(all_rows, parts_col):
                lists = batch.column(parts_col)
                offsets = lists.offsets.to_numpy()
                texts = lists.flatten().cast(pa.string())
                pieces, n = cuts.cut(texts, known, pc.is_in(texts, special).to_numpy(zero_copy_only=False))
                ids = _ids(pieces, np.concatenate(([0], np.cumsum(n)))[offsets - offsets[0]], encoder)
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), ids], [*(f.name for f in kept), out_col])
                del texts, pieces, n, ids
                pa.default_memory_pool().release_unused()

    none = F.array().cast("array<string>")
    return frame.withColumn(parts_col, F.coalesce(parts_col, none)).mapInArrow(run, schema)


def encode_pretokens(counts: DataFrame, tokenizer: Tokenizer, pretoken_col: str = "pretoken") -> DataFrame:
    """Ids of distinct pre-tokens; other columns stay.  A null pre-token has no ids."""
    kept = [c for c in counts.columns if c != pretoken_col]
    frame = counts.select(*kept, pretoken_col, F.array_compact(F.array(pretoken_col)).alias("pieces"))
    return encode_pieces(frame, tokenizer, "pieces")


def encode_documents(
    docs: DataFrame,
    tokenizer: Tokenizer,
    text_col: str = "text",
    keys: Sequence[str] = ("doc_id",),
    unit: str = "document",
    end_token: str | None = None,
) -> DataFrame:
    """``(keys..., ids)``.

    ``unit='line'`` cuts each line on its own, as when a file is read line by
    line.  Null or empty text gives an empty array.  ``end_token``, one of the
    special tokens, puts its id behind every document, as the delimiter stands
    in a file that ends in one.
    """
    if tokenizer.pattern == patterns.PRETOKEN_PATTERN:
        divide = {"document": patterns.parts, "line": patterns.line_parts}[unit]
        parts = divide(F.col(text_col), tokenizer.special_tokens)
        found = encode_parts(docs.select(*keys, parts.alias("pieces")), tokenizer, "pieces")
    else:
        cut = {"document": patterns.pieces, "line": patterns.line_pieces}[unit]
        pieces = cut(F.col(text_col), tokenizer.special_tokens, tokenizer.pattern)
        found = encode_pieces(docs.select(*keys, pieces.alias("pieces")), tokenizer, "pieces")
    if end_token is None:
        return found
    return found.withColumn("ids", F.concat("ids", F.array(F.lit(tokenizer.id_of(end_token)).cast("int"))))


def encode_lines(
    docs: DataFrame, tokenizer: Tokenizer, text_col: str = "text", keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``(keys..., line_no, ids)``: one row per line, each encoded on its own."""
    rows = docs.select(*keys, F.posexplode(patterns.lines(F.col(text_col))).alias("line_no", "line"))
    if tokenizer.pattern == patterns.PRETOKEN_PATTERN:
        parts = patterns.parts(F.col("line"), tokenizer.special_tokens)
        return encode_parts(rows.select(*keys, "line_no", parts.alias("pieces")), tokenizer, "pieces")
    cut = patterns.pieces(F.col("line"), tokenizer.special_tokens, tokenizer.pattern)
    return encode_pieces(rows.select(*keys, "line_no", cut.alias("pieces")), tokenizer, "pieces")


def count_tokens(encoded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of tokens in total, or per value of the ``by`` columns."""
    return encoded.groupBy(*by).agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n_tokens"))


def segmented_words(counts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``(pretoken, symbols, cnt)``: the words as their symbols in bracketed hex."""
    from pairloom.operators.decode import token_hex

    encoded = encode_pretokens(counts.select("pretoken", "cnt"), tokenizer)
    shown = F.transform(
        "ids", lambda i: F.concat(F.lit("<"), token_hex(tokenizer.vocab, i), F.lit(">"))
    )
    return encoded.select("pretoken", F.array_join(shown, "").alias("symbols"), "cnt")
