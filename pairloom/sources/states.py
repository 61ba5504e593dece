"""Saved states of a running training: word table, settings and merge list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from pairloom.session import bounded_rows

STATE_MERGES_SCHEMA = "rank int, l binary, r binary, cnt long"
STATE_SETTINGS_SCHEMA = "special_tokens array<string>"
STATES_KEPT = 2
MOST_MERGES = 1 << 22  # the merge list goes through the driver


def words_path(path: str, n_merges: int) -> str:
    """Where the words of a state belong; they are written before the state is completed."""
    return f"{path}/step={n_merges}/words"


def is_complete(spark: SparkSession, path: str, n_merges: int) -> bool:
    return n_merges in _steps(spark, path)


def complete_state(
    spark: SparkSession,
    merges: Sequence[tuple[bytes, bytes]],
    counts: Sequence[int],
    path: str,
    special_tokens: Sequence[str] = (),
) -> None:
    """Add settings and merges to words that are there; the merges come last and mark the state complete.

    Of the complete states before it all but the last go.
    """
    done = _steps(spark, path)
    step = f"{path}/step={len(merges)}"
    settings = spark.createDataFrame([(list(special_tokens),)], STATE_SETTINGS_SCHEMA)
    settings.coalesce(1).write.mode("overwrite").parquet(f"{step}/settings")
    rows = [(k, bytearray(l), bytearray(r), c) for k, ((l, r), c) in enumerate(zip(merges, counts))]
    spark.createDataFrame(rows, STATE_MERGES_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{step}/merges")
    earlier = [n for n in done if n < len(merges)]
    for n in earlier[: max(0, len(earlier) - STATES_KEPT + 1)]:
        # the mark of a complete state goes first
        for part in ("merges", "settings", "words"):
            _delete(spark, f"{path}/step={n}/{part}")
        _delete(spark, f"{path}/step={n}")


def write_training_state(
    words: DataFrame,
    merges: Sequence[tuple[bytes, bytes]],
    counts: Sequence[int],
    path: str,
    special_tokens: Sequence[str] = (),
) -> None:
    """Write ``path/step=N``; a state that is complete already stays as it is."""
    if not is_complete(words.sparkSession, path, len(merges)):
        words.select("seq", "cnt").write.mode("overwrite").parquet(words_path(path, len(merges)))
        complete_state(words.sparkSession, merges, counts, path, special_tokens)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _steps(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete states, lowest first."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/step=*/merges/_SUCCESS"))
    names = [m.getPath().getParent().getParent().getName() for m in marks or ()]
    return sorted(int(n.removeprefix("step=")) for n in names)


def read_training_state(
    spark: SparkSession, path: str, special_tokens: Sequence[str] = ()
) -> tuple[DataFrame, list[tuple[bytes, bytes, int]]]:
    """Word table and merges of the newest complete state; other special tokens than its own are refused."""
    steps = _steps(spark, path)
    if not steps:
        raise FileNotFoundError(f"no complete training state below {path}")
    step = f"{path}/step={steps[-1]}"
    saved = spark.read.schema(STATE_SETTINGS_SCHEMA).parquet(f"{step}/settings").first()["special_tokens"]
    if saved != list(special_tokens):
        raise ValueError(f"the state was trained with the special tokens {saved}")
    merges = spark.read.schema(STATE_MERGES_SCHEMA).parquet(f"{step}/merges")
    rows = sorted(bounded_rows(merges, MOST_MERGES, "the merge list"), key=lambda r: r["rank"])
    words = spark.read.schema("seq string, cnt long").parquet(f"{step}/words")
    return words, [(bytes(r["l"]), bytes(r["r"]), r["cnt"]) for r in rows]
