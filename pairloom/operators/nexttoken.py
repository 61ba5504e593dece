"""Next-token tables: the source of logits for validation and generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.joins import split_join
from pairloom.session import settle


def count_steps(sequences: DataFrame, width: int = 1, ids_col: str = "ids", keys: Sequence[str] = ()) -> DataFrame:
    """``(keys..., context, next, cnt)`` over all sequences; ``context`` has ``width`` ids.

    Shifted slices of the ids are zipped, and plain INT columns are counted
    inside each task before the shuffle.
    """
    if width < 1:
        raise ValueError("the context needs at least one token")
    n = F.greatest(F.size(ids_col) - width, F.lit(0))
    names = [f"t{i}" for i in range(width + 1)]
    steps = F.arrays_zip(*[F.slice(ids_col, F.lit(i + 1), n).alias(name) for i, name in enumerate(names)])
    counted = sequences.select(*keys, F.inline(steps)).groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("cnt"))
    return counted.select(*keys, F.array(*names[:-1]).alias("context"), F.col(names[-1]).alias("next"), "cnt")


def next_token_table(
    sequences: DataFrame, width: int = 1, smoothing: float = 1.0, ids_col: str = "ids"
) -> DataFrame:
    """``(context, next, cnt, logit)`` with ``logit = ln(cnt + smoothing)``.

    With ``smoothing`` also given to the tokens never seen after a context, the
    softmax over a whole vocabulary is the add-k estimate.
    """
    return count_steps(sequences, width, ids_col).withColumn("logit", F.ln(F.col("cnt") + F.lit(smoothing)))


def step_losses(
    steps: DataFrame, table: DataFrame, vocab_size: int, smoothing: float = 1.0
) -> DataFrame:
    """``(context, next, cnt, loss)`` for counted steps of held-out sequences.

    Only distinct steps are joined.  A context never seen gives every token the
    same probability.
    """
    totals = table.groupBy("context").agg(F.sum("cnt").alias("total"))
    seen = table.select("context", "next", F.col("cnt").alias("seen"))
    chance = (F.coalesce("seen", F.lit(0)) + F.lit(smoothing)) / (
        F.coalesce("total", F.lit(0)) + F.lit(smoothing * vocab_size)
    )
    return (
        steps.join(seen, ["context", "next"], "left")
        .join(totals, "context", "left")
        .select("context", "next", "cnt", (-F.ln(chance)).alias("loss"))
    )


def held_out_loss(losses: DataFrame) -> DataFrame:
    """One row ``(n_tokens, loss)``: the mean over all predicted tokens."""
    return losses.agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("n_tokens"),
        (F.sum(F.col("cnt") * F.col("loss")) / F.sum("cnt")).alias("loss"),
    )


def validate_sequences(
    sequences: DataFrame,
    table: DataFrame,
    vocab_size: int,
    width: int = 1,
    smoothing: float = 1.0,
    ids_col: str = "ids",
) -> DataFrame:
    """Mean loss over every position of held-out sequences."""
    steps = count_steps(sequences, width, ids_col)
    return held_out_loss(step_losses(steps, table, vocab_size, smoothing))


def score_documents(
    sequences: DataFrame,
    table: DataFrame,
    vocab_size: int,
    width: int = 1,
    smoothing: float = 1.0,
    keys: Sequence[str] = ("doc_id",),
    ids_col: str = "ids",
) -> DataFrame:
    """``(keys..., n_tokens, loss, perplexity)``: mean loss over each sequence's predicted tokens.

    The losses are worked out once per distinct step of all sequences, and
    joined back in two parts: steps that stand in many sequences by a
    broadcast, all others by a shuffle.  A sequence too short to predict anything
    has 0 tokens and null loss.
    """
    own, _ = settle(count_steps(sequences, width, ids_col, keys), "own-steps")
    step = ["context", "next"]
    distinct, _ = settle(own.groupBy(*step).agg(F.sum("cnt").alias("cnt"), F.count(F.lit(1)).alias("n")), "distinct-steps")
    losses = step_losses(distinct, table, vocab_size, smoothing).select(*step, "loss")
    scored = split_join(own, losses, step, counts=distinct).groupBy(*keys).agg(
        F.sum("cnt").alias("n"), (F.sum(F.col("cnt") * F.col("loss")) / F.sum("cnt")).alias("loss")
    )
    every = sequences.select(*keys).distinct().join(scored, list(keys), "left")
    return every.select(*keys, F.coalesce("n", F.lit(0)).alias("n_tokens"), "loss", F.exp("loss").alias("perplexity"))


def validate_sampled(
    windows: DataFrame, table: DataFrame, vocab_size: int, width: int = 1, smoothing: float = 1.0
) -> DataFrame:
    """Mean loss on sampled windows ``(x, y)`` of a held-out stream."""
    whole = windows.select(F.concat("x", F.slice("y", -1, 1)).alias("ids"))
    return validate_sequences(whole, table, vocab_size, width, smoothing)
