"""Continuing a table of prompts token by token."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.draws import hashed_unit
from pairloom.operators.scoring import UNITS, apply_temperature, limit, softmax, temper, top_p_filter, units
from pairloom.operators.decode import decode
from pairloom.operators.encode import Tokenizer, encode_documents
from pairloom.operators.joins import split_join
from pairloom.session import settle, table_bytes

END_ID = 256
STEPS_PER_TABLE = 8  # steps between two written tables
SAMPLER_BYTES = 64 << 20  # of a written sampler that may be broadcast
UNKNOWN = "*"  # the context that stands for all contexts never seen


def sampler_table(table: DataFrame, temperature: float = 1.0, top_p: float = 0.9) -> DataFrame:
    """``(context, nexts, passes, mass)``: the nucleus of every context, in order.

    Temperature and nucleus do not change between steps, so they are worked out
    once per context.  A row holds at most one entry per token.
    """
    logits = table.select(
        F.array_join("context", " ").alias("context"), F.col("next").alias("class_id"), "logit"
    )
    probs = softmax(apply_temperature(logits, temperature), ["context"])
    return _gathered(top_p_filter(probs, top_p, ["context"]))


def _gathered(nucleus: DataFrame) -> DataFrame:
    entries = F.array_sort(
        F.collect_list(F.struct("before", "class_id", (F.col("before") + F.col("prob")).alias("passes")))
    )
    return (
        nucleus.groupBy("context")
        .agg(entries.alias("e"), F.max("mass").alias("mass"))
        .select("context", F.col("e.class_id").alias("nexts"), F.col("e.passes").alias("passes"), "mass")
    )


def smoothed_sampler(
    table: DataFrame, vocab_size: int, temperature: float = 1.0, top_p: float = 0.9, smoothing: float = 1.0
) -> DataFrame:
    """A sampler over the whole vocabulary, the distribution that ``step_losses`` measures.

    ``table`` has the logits of seen tokens with the same ``smoothing``.  The
    tokens never seen after a context are equally likely and come last, smaller
    ids first; they are kept as one entry: ``seen``, the ids that are not among
    them, ``base``, the sum before them, ``unit``, the share of each, and
    ``more``, how many belong to the nucleus.  One row, of context ``UNKNOWN``,
    gives every token the same share.  Shares below half a unit of the nucleus
    are 0.  Ids outside ``0..vocab_size - 1`` raise.
    """
    if smoothing <= 0:
        raise ValueError("unseen tokens need a positive smoothing")
    known = table.select(F.array_join("context", " ").alias("context"), F.col("next").alias("class_id"), "logit")
    ids = F.array_sort(F.collect_list("class_id"))
    each = known.groupBy("context").agg(ids.alias("seen")).withColumn("left", F.lit(vocab_size) - F.size("seen"))
    together = F.ln("left") + temper(F.lit(math.log(smoothing)), temperature)
    rest = each.filter("left > 0").select("context", F.lit(None).cast("int").alias("class_id"), together.alias("logit"))
    probs, _ = settle(softmax(apply_temperature(known, temperature).unionByName(rest), ["context"]), "chances")
    of_seen = F.col("class_id").isNotNull()
    sums = probs.groupBy("context").agg(
        F.sum(F.when(of_seen, units(F.col("prob")))).alias("base"), F.max(F.when(~of_seen, F.col("prob"))).alias("rest")
    )
    unit = F.coalesce(units(F.col("rest") / F.col("left")), F.lit(0))
    room = F.expr(f"({limit(top_p)} - base) div unit + 1")
    more = F.when((F.col("unit") > 0) & (F.col("base") <= limit(top_p)), F.least("left", room)).otherwise(0)
    outside = (F.array_max("seen") >= vocab_size) | (F.array_min("seen") < 0)
    seen = F.when(outside, F.raise_error(F.lit("id outside the vocabulary")).cast("array<int>")).otherwise(F.col("seen"))
    found = (
        _gathered(top_p_filter(probs.filter(of_seen), top_p, ["context"]))
        .join(each, "context")
        .join(sums, "context")
        .withColumn("unit", unit)
        .withColumn("more", more.cast("int"))
        .select(
            "context", "nexts", "passes", (F.col("mass") + F.col("more") * F.col("unit") / UNITS).alias("mass"),
            seen.alias("seen"), (F.col("base") / UNITS).alias("base"), (F.col("unit") / UNITS).alias("unit"), "more",
        )
    )
    even = round(UNITS / vocab_size)
    kept = min(vocab_size, limit(top_p) // even + 1)
    row = (UNKNOWN, [], [], kept * even / UNITS, [], 0.0, even / UNITS, kept)
    return found.unionByName(table.sparkSession.createDataFrame([row], found.schema))


def _unseen(draw: Column) -> Column:
    """The token that ``draw`` falls on among those never seen: the one with so many unseen ids before it."""
    index = F.least(F.floor((draw - F.col("base")) / F.col("unit")), F.col("more") - 1)
    index = F.greatest(index, F.lit(0))
    return (index + F.size(F.filter("seen", lambda s, i: s - i <= index))).cast("int")


def generate_batch(
    prompts: DataFrame,
    sampler: DataFrame,
    max_tokens: int,
    width: int = 1,
    seed: int = 0,
    end_id: int = END_ID,
    steps_per_table: int = STEPS_PER_TABLE,
) -> DataFrame:
    """``(prompt_id, ids, n_new)`` from ``prompts (prompt_id, ids)``.

    ``ids`` starts with the prompt.  A row ends at ``end_id``, which is not
    appended, at ``max_tokens``, or at a context the sampler does not know; a
    ``smoothed_sampler`` knows all, so that only prompts of under ``width`` ids
    stay as they are.
    Each step joins the rows to the sampler on their context; ended rows keep a
    context that is theirs alone, so that they match nothing and do not pile up
    on one key.  A sampler of at most ``SAMPLER_BYTES`` is sent to every task
    and the rows stay where they are.  Of a larger one, only the rows of contexts
    that many prompts stand at are; to the others the rows are shuffled.
    """
    sampler, path = settle(sampler, "sampler")
    smoothed = "seen" in sampler.columns
    unknown = sampler.filter(F.col("context") == UNKNOWN).first() if smoothed else None
    small = table_bytes(sampler.sparkSession, path) <= SAMPLER_BYTES
    steps_per_table = steps_per_table if small else 1  # each step reads its rows three times
    context = F.array_join(F.slice("ids", -width, width), " ")
    ready = F.size("ids") >= width
    idle = F.concat(F.lit("#"), F.col("prompt_id").cast("string"))
    rows = prompts.select(
        "prompt_id",
        "ids",
        F.lit(0).alias("n_new"),
        ready.alias("live"),
        F.when(ready, context).otherwise(idle).alias("context"),
    )
    for step in range(max_tokens):
        draw = hashed_unit(seed, F.col("prompt_id"), F.lit(step)) * F.col("mass")
        joined = rows.join(F.broadcast(sampler), "context", "left") if small else split_join(rows, sampler, ["context"], "left")
        if smoothed:
            none = {c: F.array().cast(sampler.schema[c].dataType) for c in ("nexts", "passes", "seen")}
            none |= {c: F.lit(unknown[c]) for c in ("mass", "base", "unit", "more")}
            joined = joined.withColumns({c: F.coalesce(c, other) for c, other in none.items()})
        joined = joined.withColumn("draw", draw)
        place = F.size(F.filter("passes", lambda p: p <= F.col("draw")))
        chosen = F.get("nexts", F.least(place, F.size("nexts") - 1))
        if smoothed:
            chosen = F.when((place < F.size("nexts")) | (F.col("more") == 0), chosen).otherwise(_unseen(F.col("draw")))
        stepped = joined.withColumn("next", chosen).withColumn(
            "live", F.col("live") & F.coalesce(F.col("next") != end_id, F.lit(False))
        )
        grown = stepped.select(
            "prompt_id",
            F.when(F.col("live"), F.concat("ids", F.array("next"))).otherwise(F.col("ids")).alias("ids"),
            (F.col("n_new") + F.col("live").cast("int")).alias("n_new"),
            "live",
        )
        rows = grown.withColumn("context", F.when(F.col("live"), context).otherwise(idle))
        if (step + 1) % steps_per_table == 0 and step + 1 < max_tokens:
            rows, _ = settle(rows, "generated")
            if rows.filter("live").isEmpty():
                break
    return rows.select("prompt_id", "ids", "n_new")


def continue_texts(
    prompts: DataFrame,
    tokenizer: Tokenizer,
    sampler: DataFrame,
    max_tokens: int,
    end_token: str | None = None,
    width: int = 1,
    seed: int = 0,
) -> DataFrame:
    """``(prompt_id, text, n_new)`` from ``prompts (prompt_id, text)``: each text with its continuation.

    A row ends at the id of ``end_token``, one of the special tokens, or without
    one at ``max_tokens`` or an unknown context only.
    """
    end_id = -1 if end_token is None else tokenizer.id_of(end_token)
    ids = encode_documents(prompts, tokenizer, keys=("prompt_id",))
    longer = generate_batch(ids, sampler, max_tokens, width, seed, end_id)
    return decode(longer, tokenizer.vocab).select("prompt_id", "text", "n_new")
