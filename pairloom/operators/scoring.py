"""Softmax, loss, nucleus and vector operators over tables.

Distributions come in two forms: an ``ARRAY<DOUBLE>`` per row, handled in the
row, and the long form ``(row_id, class_id, logit)`` for any number of classes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.binding import bind
from pairloom.functions.draws import hashed_unit
from pairloom.operators.running import running_total

# --- fixed values -----------------------------------------------------------
TEMPERATURE_EPS = 1e-8
RMS_EPS = 1e-5
# ----------------------------------------------------------------------------

UNITS = 1e12  # probabilities are added up in whole numbers of this share, so that decimal ties are exact


def units(prob: Column) -> Column:
    return F.round(prob * UNITS).cast("long")


def limit(p: float) -> int:
    return round(p * UNITS)


_STRIPE = 256.0  # width of a logit stripe: sums of exp stay far inside a double


def temper(logit: Column, temperature: float) -> Column:
    """A logit at a sampling temperature."""
    return logit / F.lit(temperature + TEMPERATURE_EPS)


def apply_temperature(logits: DataFrame, temperature: float, logit_col: str = "logit") -> DataFrame:
    return logits.withColumn(logit_col, temper(F.col(logit_col), temperature))


def array_log_sum_exp(values: Column) -> Column:
    return bind(
        F.struct(values.alias("v"), F.array_max(values).alias("top")),
        lambda b: b["top"] + F.ln(F.aggregate(b["v"], F.lit(0.0), lambda s, x: s + F.exp(x - b["top"]))),
    )


def softmax_array(values: Column) -> Column:
    """Softmax of an array column."""
    doubled = values.cast("array<double>")
    return bind(
        F.struct(doubled.alias("v"), array_log_sum_exp(doubled).alias("lse")),
        lambda b: F.transform(b["v"], lambda x: F.exp(x - b["lse"])),
    )


def cross_entropy_array(values: Column, target: Column) -> Column:
    """Loss of one row: log-sum-exp minus the target's logit, in nats.  A target without a logit raises."""
    doubled = values.cast("array<double>")
    missing = F.raise_error(F.lit("target without a logit")).cast("double")
    return F.coalesce(array_log_sum_exp(doubled) - F.get(doubled, target), F.when(values.isNotNull() & target.isNotNull(), missing))


def log_sum_exp(logits: DataFrame, row: Sequence[str] = ("row_id",)) -> DataFrame:
    """``(row..., lse)`` from long-form logits.

    A first sum per row and stripe of logits needs no maximum beforehand and is
    added up inside each task before the shuffle, so a row of any length costs
    a task a few partial sums.
    """
    stripe = F.floor(F.col("logit") / _STRIPE)
    sums = logits.groupBy(*row, stripe.alias("stripe")).agg(
        F.sum(F.exp(F.col("logit") - stripe * _STRIPE)).alias("part")
    )
    logs = sums.select(*row, (F.col("stripe") * _STRIPE + F.ln("part")).alias("log_part"))
    gathered = logs.groupBy(*row).agg(F.collect_list("log_part").alias("parts"))
    return gathered.select(*row, array_log_sum_exp(F.col("parts")).alias("lse"))


def softmax(logits: DataFrame, row: Sequence[str] = ("row_id",)) -> DataFrame:
    """Long-form logits with a ``prob`` column.

    The join carries one row per distribution, and Spark splits a hot key of it.
    """
    return logits.join(log_sum_exp(logits, row), list(row)).withColumn(
        "prob", F.exp(F.col("logit") - F.col("lse"))
    ).drop("lse")


def cross_entropy(
    logits: DataFrame, targets: DataFrame, row: Sequence[str] = ("row_id",)
) -> DataFrame:
    """``(row..., loss)`` from long-form logits and ``targets (row..., target)``.

    One row per target.  A target whose row has no such class, or no logits at
    all, raises; a null target has a null loss.
    """
    picked = targets.join(
        logits.select(*row, F.col("class_id").alias("target"), F.col("logit").alias("picked")),
        [*row, "target"],
        "left",
    )
    missing = F.raise_error(F.lit("target without a logit")).cast("double")
    loss = F.coalesce(F.col("lse") - F.col("picked"), F.when(F.col("target").isNotNull(), missing))
    return picked.join(log_sum_exp(logits, row), list(row), "left").select(*row, loss.alias("loss"))


def mean_loss(losses: DataFrame) -> DataFrame:
    return losses.agg(F.avg("loss").alias("loss"))


def top_p_filter(probs: DataFrame, p: float, row: Sequence[str] = ("row_id",)) -> DataFrame:
    """Classes of the nucleus, with their share of it in ``nucleus_prob``.

    A class stays while the probabilities sorted before it sum to at most ``p``,
    so the class that crosses ``p`` and the first class always stay.  Equal
    probabilities are ordered by class.  ``before`` is that earlier sum and
    ``mass`` the probability of the nucleus.  Probabilities are added up in whole
    units of 10^-12, so the result does not depend on how rows are partitioned.
    """
    narrow = probs.select(*row, "class_id", "prob", units(F.col("prob")).alias("units"))
    order = [F.desc("units"), F.asc("class_id")]
    kept = running_total(narrow, "units", order, row, "before").filter(F.col("before") <= limit(p))
    mass = kept.groupBy(*row).agg(F.sum("units").alias("mass"))
    shares = kept.join(mass, list(row)).withColumn("nucleus_prob", F.col("units") / F.col("mass"))
    return shares.select(*row, "class_id", "prob", *((F.col(c) / UNITS).alias(c) for c in ("before", "mass")), "nucleus_prob")


def top_p_array(probs: Column, p: float) -> Column:
    """The same within a row: ``array<struct<class_id, prob, before, passes, mass, nucleus_prob>>`` in nucleus order, without a shuffle."""
    sized = F.transform(probs, lambda x, i: F.struct((-units(x)).alias("less"), i.alias("class_id"), x.alias("prob")))
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<struct<class_id:int,prob:double,units:long,before:long>>").alias("kept"))

    def step(state: Column, x: Column) -> Column:
        entry = F.struct(x["class_id"].alias("class_id"), x["prob"].alias("prob"), (-x["less"]).alias("units"), state["sum"].alias("before"))
        kept = F.when(state["sum"] <= limit(p), F.concat(state["kept"], F.array(entry))).otherwise(state["kept"])
        return F.struct((state["sum"] - x["less"]).alias("sum"), kept.alias("kept"))

    kept = F.aggregate(F.array_sort(sized), start, step, lambda s: s["kept"])
    mass = F.aggregate(kept, F.lit(0).cast("long"), lambda s, k: s + k["units"])
    return bind(
        F.struct(kept.alias("k"), mass.alias("m")),
        lambda b: F.transform(
            b["k"],
            lambda k: F.struct(
                k["class_id"].alias("class_id"), k["prob"].alias("prob"), (k["before"] / UNITS).alias("before"),
                ((k["before"] + k["units"]) / UNITS).alias("passes"), (b["m"] / UNITS).alias("mass"), (k["units"] / b["m"]).alias("nucleus_prob"),
            ),
        ),
    )


def top_p_sample_array(nucleus: Column, seed: int, *row: Column) -> Column:
    """One seeded class from a row's nucleus of ``top_p_array``; the same draw as ``top_p_sample``."""
    draw = hashed_unit(seed, *row)
    passed = F.filter(nucleus, lambda k: k["passes"] > draw * k["mass"])
    return F.coalesce(F.get(passed, F.lit(0)), F.element_at(nucleus, -1))["class_id"]


def top_p_sample(nucleus: DataFrame, seed: int, row: Sequence[str] = ("row_id",)) -> DataFrame:
    """One seeded draw ``(row..., class_id)`` from each nucleus.

    The first class in nucleus order whose cumulative sum passes the draw; the
    draw stays below the mass, and rounding at the far end goes to the last class.
    """
    draw = hashed_unit(seed, *[F.col(r) for r in row]) * F.col("mass")
    passed = F.col("before") + F.col("nucleus_prob") * F.col("mass") > draw
    return nucleus.groupBy(*row).agg(
        F.coalesce(
            F.min_by("class_id", F.when(passed, F.struct("before", "class_id"))),
            F.max_by("class_id", F.struct("before", "class_id")),
        ).alias("class_id")
    )


MOST_BROADCAST = 256 << 20  # bytes of a vector table that goes to every task


def embedding_lookup(
    tokens: DataFrame, vectors: DataFrame, token_col: str = "token_id", on_unknown: str = "error", most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """Attach ``vectors (token_id, embedding)`` to token rows; every token row stays.

    An id without a vector raises, or with ``on_unknown='null'`` has a null
    embedding.  Vectors of up to ``most_broadcast`` bytes, by their counted
    size, are broadcast; a larger table is joined by shuffle, where Spark splits
    frequent tokens.
    """
    if on_unknown not in ("error", "null"):
        raise ValueError("on_unknown must be 'error' or 'null'")
    table = vectors.select(F.col("token_id").alias(token_col), "embedding", F.lit(True).alias("_known"))
    entries = table.agg(F.coalesce(F.sum(F.size("embedding").cast("long") + 4), F.lit(0))).first()[0]
    found = tokens.join(F.broadcast(table) if 8 * entries <= most_broadcast else table, token_col, "left")
    if on_unknown == "error":
        unknown = F.raise_error(F.lit("id without a vector")).cast(vectors.schema["embedding"].dataType)
        found = found.withColumn("embedding", F.when(F.col("_known"), F.col("embedding")).otherwise(unknown))
    return found.drop("_known")


def rms_normalize(vector: Column, weight: Column | None = None, eps: float = RMS_EPS) -> Column:
    """``x * w / sqrt(mean(x^2) + eps)``; without a weight ``w`` is one."""
    doubled = vector.cast("array<double>")
    squares = F.aggregate(doubled, F.lit(0.0), lambda s, x: s + x * x)
    unit = bind(
        F.struct(doubled.alias("v"), F.sqrt(squares / F.size(doubled) + F.lit(eps)).alias("rms")),
        lambda b: F.transform(b["v"], lambda x: x / b["rms"]),
    )
    if weight is None:
        return unit
    return F.zip_with(unit, weight.cast("array<double>"), lambda x, w: x * w)
