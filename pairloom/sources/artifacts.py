"""Vocabulary, merge and token stream files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.encode import MAX_ID
from pairloom.operators.stream import StoredStream

LATIN = "ISO-8859-1"  # one character per byte
MOST_TOKENS = 1 << 22  # of a vocabulary file

_KEY_IS_TOKEN = r'(?s)^\s*\{\s*"(?:[^"\\]|\\.)*"\s*:\s*-?[0-9]'


def write_vocab(vocab: DataFrame, path: str) -> None:
    """One JSON object, id -> token with a character per byte, in order of ids, an entry a line.

    One task sorts and streams the lines, as it has to be one file; nothing is
    gathered.  Repeated ids and more than ``MOST_TOKENS`` tokens are refused.
    """
    sizes = vocab.agg(F.count(F.lit(1)), F.count_distinct("token_id"), F.min("token_id"), F.max("token_id")).first()
    n, distinct, first, last = sizes
    if n > MOST_TOKENS or distinct < n:
        raise ValueError(f"{n} tokens with {distinct} different ids, of at most {MOST_TOKENS}, make no vocabulary")
    # to_json writes an object of one entry: its braces go
    entry = F.to_json(F.create_map(F.col("token_id").cast("string"), F.decode("token", LATIN)))
    bare = F.substring(entry, F.lit(2), F.length(entry) - 2)
    line = F.concat(
        F.when(F.col("token_id") == first, "{").otherwise(""), bare, F.when(F.col("token_id") == last, "}").otherwise(",")
    )
    if n:
        lines = vocab.coalesce(1).sortWithinPartitions("token_id").select(line.alias("value"))
    else:
        lines = vocab.sparkSession.range(1).select(F.lit("{}").alias("value"))
    lines.write.mode("overwrite").text(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """Vocabulary from ``id -> token`` or ``token -> id`` JSON.

    The first value tells the direction.  Keys that are no integers are skipped.
    """
    raw = spark.read.text(path, wholetext=True)
    entries = F.map_entries(F.from_json("value", "map<string,string>"))

    def pairs(token_id: str, token: str) -> Column:
        return F.transform(entries, lambda e: F.struct(e[token_id].alias("token_id"), e[token].alias("token")))

    # the direction is told before the entries become rows, so that no row carries the whole text along
    either = F.when(F.col("value").rlike(_KEY_IS_TOKEN), pairs("value", "key")).otherwise(pairs("key", "value"))
    return (
        raw.select(F.explode(either).alias("e"))
        .select(
            F.col("e.token_id").try_cast("int").alias("token_id"),
            F.encode("e.token", LATIN).alias("token"),
            F.lit("read").alias("kind"),
        )
        .filter(F.col("token_id").isNotNull())
    )


def write_merges(merges: DataFrame, path: str) -> None:
    """One JSON pair per line, in rank order."""
    pair = F.to_json(F.array(F.decode("l", LATIN), F.decode("r", LATIN)))
    ordered = merges.coalesce(1).sortWithinPartitions("rank")
    ordered.select(pair.alias("value")).write.mode("overwrite").text(path)


def read_merges(spark: SparkSession, path: str) -> DataFrame:
    """Merges from JSON pairs or ``left right`` lines; other lines are skipped.

    Lines end in any of LF, CR LF and CR.  The rank is the line's place, so more
    than one file is refused.
    """
    lines = F.split("value", "\r\n|\r|\n")

    def sides(line: Column) -> Column:
        as_json = F.when(line.rlike(r"^\s*\[.*\]\s*$"), F.from_json(line, "array<string>"))
        return F.coalesce(as_json, F.split(line, " ", 2))

    pairs = F.filter(F.transform(lines, sides), lambda p: F.size(p) == 2)
    raw = spark.read.text(path, wholetext=True)
    if raw.limit(2).count() > 1:
        raise ValueError("merges have to be one file: ranks go on from line to line")
    return (
        raw.select(F.posexplode(pairs).alias("rank", "p"))
        .select(
            "rank",
            F.encode(F.col("p")[0], LATIN).alias("l"),
            F.encode(F.col("p")[1], LATIN).alias("r"),
        )
    )


def write_token_stream(blocks: DataFrame, path: str, max_id: int = MAX_ID) -> None:
    """Parquet blocks and their manifest; ids outside ``0..max_id`` raise.

    Blocks are written as they lie, without a shuffle: those of ``flatten_token_stream``
    are neighbours within a file.  The manifest, one row a file, is taken from the files that
    were written, of which only the block numbers and sizes are read; it marks the stream complete.
    """
    spark = blocks.sparkSession
    fits = F.forall("ids", lambda i: (i >= 0) & (i <= max_id))
    checked = F.when(fits, F.col("ids")).otherwise(
        F.raise_error(F.lit(f"token id outside 0..{max_id}")).cast("array<int>")
    )
    blocks.select("block_id", "start_pos", "n_ids", checked.alias("ids")).write.mode("overwrite").parquet(f"{path}/blocks")
    sizes = read_token_stream(spark, path).select("block_id", "n_ids", F.col("_metadata.file_path").alias("file"))
    per_file = sizes.groupBy("file").agg(
        F.min("block_id").alias("first_block"),
        F.max("block_id").alias("last_block"),
        F.count(F.lit(1)).alias("n_blocks"),
        F.sum(F.col("n_ids").cast("long")).alias("n_ids"),
    )
    per_file.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


STREAM_SCHEMA = "block_id long, start_pos long, n_ids int, ids array<int>"
MANIFEST_SCHEMA = "file string, first_block long, last_block long, n_blocks long, n_ids long"


def read_token_stream(spark: SparkSession, path: str) -> DataFrame:
    """All blocks of a written stream."""
    return spark.read.schema(STREAM_SCHEMA).parquet(f"{path}/blocks")


def open_token_stream(spark: SparkSession, path: str) -> StoredStream:
    """A written stream with its manifest, for reading parts of it."""
    return StoredStream(read_token_stream(spark, path), spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/manifest"))


def load_split(spark: SparkSession, train_path: str, valid_path: str) -> tuple[DataFrame, DataFrame]:
    """Token streams for training and validation."""
    return read_token_stream(spark, train_path), read_token_stream(spark, valid_path)
