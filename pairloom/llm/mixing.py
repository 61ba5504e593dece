"""Mixing sources to target weights, with DataFrame functions only.

Sources hang below languages and those below domains.  The token budget is
propagated from the root: at every node it is shared out by the children's
weights, and what a child cannot use (its documents times the epochs allowed
are fewer) goes to its siblings first; only a node that is short as a whole
leaves its rest to the siblings of that node.  Each leaf then takes whole
epochs and of the next one, in an order drawn from seed and epoch, the prefix
of tokens that is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import free_name, unit_hash
from pairloom.operators.running import running_total
from pairloom.session import settle

LEVELS = ("domain", "lang", "source")
SEED = 11
#: Documents of a leaf whose order is looked at one by one, about.
CUT = 1000
#: Leaves that are sent to every task; a larger tree is joined by shuffle.
MOST_LEAVES = 50_000
NO_ID = -(1 << 63)


def word_count(text: Column | str) -> Column:
    """Tokens as this operator counts them unless told otherwise: runs without ASCII white space."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x09-\\x0D\\x20]+")), F.lit(0)).cast("long")


def share_out(nodes: DataFrame, parents: list[str], child: str, budget: str, capacity: str, weight: str, out: str) -> DataFrame:
    """Split each parent's ``budget`` over its children by weight, none above its capacity, the rest to the others.

    Children are filled in the order in which the rising water reaches their
    capacity; from the first that stays below it on all get their weight's share.
    """
    usable = F.col(weight) > 0
    kids = Window.partitionBy(*parents)
    order = kids.orderBy(F.when(usable, F.col(capacity) / F.col(weight)).otherwise(F.lit(float("inf"))), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shares = F.sum(F.when(usable, F.col(weight)).otherwise(0.0)).over(onward)
    level = F.when(shares > 0, (F.col(budget) - F.coalesce(F.sum(capacity).over(before), F.lit(0))) / shares)
    found = nodes.withColumn("_level", level)
    short = usable & (F.col(capacity) > F.col(weight) * F.col("_level"))
    found = found.withColumn("_level", F.first(F.when(short, F.col("_level")), ignorenulls=True).over(everything))
    given = F.when(~usable, 0.0).when(F.col("_level").isNull(), F.col(capacity).cast("double"))
    return found.withColumn(out, given.otherwise(F.least(F.col(capacity).cast("double"), F.col(weight) * F.col("_level")))).drop("_level")


def budgets(leaves: DataFrame, target: Column | float, weights: dict[str, Column], epochs: int) -> DataFrame:
    """``leaves`` (the levels, ``tokens``) with ``budget``: the whole tokens each leaf is to give.

    ``weights`` has a Column for each level, over the level's name and those
    above it; a weight that is not positive takes its node out of the mixture.
    """
    tree = leaves
    for level in LEVELS:
        tree = tree.withColumn(f"w_{level}", F.coalesce(weights.get(level, F.lit(1.0)).cast("double"), F.lit(0.0)))
    open_ = (F.col("w_domain") > 0) & (F.col("w_lang") > 0) & (F.col("w_source") > 0)
    tree = tree.withColumn("cap_source", F.when(open_, F.col("tokens") * epochs).otherwise(F.lit(0)).cast("long"))
    by_lang = tree.groupBy("domain", "lang").agg(F.sum("cap_source").alias("cap_lang"), F.first("w_lang").alias("w_lang"), F.first("w_domain").alias("w_domain"))
    by_domain = by_lang.groupBy("domain").agg(F.sum("cap_lang").alias("cap_domain"), F.first("w_domain").alias("w_domain"))
    total = target if isinstance(target, Column) else F.lit(float(target))
    root = by_domain.withColumn("_root", F.lit(0)).withColumn("b_root", total.cast("double"))
    top = share_out(root, ["_root"], "domain", "b_root", "cap_domain", "w_domain", "b_domain").select("domain", "b_domain")
    middle = by_lang.join(top, "domain")
    middle = share_out(middle, ["domain"], "lang", "b_domain", "cap_lang", "w_lang", "b_lang").select("domain", "lang", "b_lang")
    low = tree.join(middle, ["domain", "lang"])
    low = share_out(low, ["domain", "lang"], "source", "b_lang", "cap_source", "w_source", "b_source")
    return low.select(*LEVELS, "tokens", "n_docs", F.floor("b_source").cast("long").alias("budget"))


def _spot(epoch: Column | str, id_column: str, seed: int) -> Column:
    return unit_hash(seed, epoch, id_column)


def _known(id_column: str) -> Column:
    return F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID))


def plan(
    docs: DataFrame, share: float, weights: dict[str, Column], domain: Column, epochs: int = 1, seed: int = SEED,
    tokens: Column | None = None, id_column: str = "doc_id", text_column: str = "text",
) -> tuple[DataFrame, bool, bool]:
    """One row a leaf: its budget, its whole epochs and where it stops in the next one.

    With it, whether that is few rows, and whether a leaf stops within rows of one id.

    The budget of the root is ``share`` of all tokens of ``docs``.
    """
    counted = docs.select(
        F.coalesce(domain.cast("string"), F.lit("")).alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"), _known(id_column).alias("_id"), F.col(id_column).alias("_raw"),
        (word_count(text_column) if tokens is None else tokens).alias("n"),
    )
    rows, _ = settle(counted, "mix-docs")
    leaves, _ = settle(rows.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("n_docs")), "mix-leaves")
    total, largest, n_leaves = leaves.agg(F.sum("tokens"), F.max("n_docs"), F.count(F.lit(1))).first()
    few = n_leaves <= MOST_LEAVES
    aim = budgets(leaves, float(int((total or 0) * share)), weights, epochs)
    aim = aim.withColumn("epochs", F.when(F.col("tokens") > 0, F.least(F.floor(F.col("budget") / F.col("tokens")), F.lit(epochs))).otherwise(0).cast("long"))
    aim = aim.withColumn("rest", F.when(F.col("epochs") < epochs, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(0))
    aim, _ = settle(aim, "mix-budgets")
    # of a leaf's order only the sums of equal slices of hashes are looked at, and the slice where the budget ends
    bits = max(0, min(24, ((largest or 0) // CUT).bit_length()))
    open_ = aim.filter("rest > 0").select(*LEVELS, "epochs", "rest")
    placed = rows.join(F.broadcast(open_) if few else open_, list(LEVELS)).withColumn("h", _spot("epochs", "_raw", seed))
    placed = placed.withColumn("slice", F.shiftright("h", 60 - bits) if bits else F.lit(0).cast("long"))
    sums = placed.groupBy(*LEVELS, "slice").agg(F.sum("n").alias("n"), F.first("rest").alias("rest"))
    before = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ends = sums.filter("before < rest and before + n >= rest").select(*LEVELS, "slice", "before")
    inside = placed.join(F.broadcast(ends) if few else ends, [*LEVELS, "slice"])
    inside = inside.groupBy(*LEVELS, "h", "_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    running = Window.partitionBy(*LEVELS).orderBy("h", "_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("left", F.col("rest") - F.col("before") - F.coalesce(F.sum("n").over(running), F.lit(0)))
    stop = inside.filter("left > 0 and left <= n").select(*LEVELS, F.col("h").alias("cut_h"), F.col("_id").alias("cut_id"), F.col("left").alias("cut_tokens"), F.col("rows").alias("cut_rows"))
    found, _ = settle(aim.join(stop, list(LEVELS), "left"), "mix-plan")
    return found, few, not found.filter("cut_rows > 1").isEmpty()


def _taken(docs: DataFrame, planned: tuple[DataFrame, bool, bool], domain: Column, seed: int, n: Column, id_column: str, free: str = "") -> DataFrame:
    """``docs`` with its whole epochs and the tokens taken in the last one, under names that begin with ``free``.

    Where the budget of a leaf ends within rows of one id, those rows are put in order by their contents and
    a running total over tasks tells what is left for each; of equal rows the order does not matter.
    """
    table, few, repeated = planned
    kept = table.select(*(F.col(x).alias(f"{free}_{x}") for x in (*LEVELS, "epochs", "cut_h", "cut_id", "cut_tokens")))
    keys = (F.coalesce(domain.cast("string"), F.lit("")), F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit("")))
    on = [F.col(f"{free}_{x}") == k for x, k in zip(LEVELS, keys, strict=True)]
    both = docs.join(F.broadcast(kept) if few else kept, on)
    spot, known = _spot(f"{free}_epochs", id_column, seed), _known(id_column)
    cut_h, cut_id = F.col(f"{free}_cut_h"), F.col(f"{free}_cut_id")
    first = (spot < cut_h) | ((spot == cut_h) & (known < cut_id))
    last = (spot == cut_h) & (known == cut_id)
    if not repeated:
        rest = F.when(first, n).when(last, F.least(n, F.col(f"{free}_cut_tokens"))).otherwise(0).cast("long")
        return both.withColumn(f"{free}_rest", rest)
    last = F.coalesce(last, F.lit(False))
    whole = both.filter(~last).withColumn(f"{free}_rest", F.when(first, n).otherwise(0).cast("long"))
    cut = both.filter(last).withColumn(f"{free}_n", n).withColumn(f"{free}_order", F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns)))))
    leaf = [f"{free}_{x}" for x in LEVELS]
    summed = running_total(cut, f"{free}_n", [F.col(f"{free}_order")], leaf, f"{free}_before")
    left = F.greatest(F.least(F.col(f"{free}_n"), F.col(f"{free}_cut_tokens") - F.col(f"{free}_before")), F.lit(0))
    return whole.unionByName(summed.withColumn(f"{free}_rest", left.cast("long")).select(*(F.col(f"`{c}`") for c in whole.columns)))


def mix(
    docs: DataFrame, share: float, weights: dict[str, Column], domain: Column, epochs: int = 1, seed: int = SEED,
    tokens: Column | None = None, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``(id, domain, lang, source, n_tokens, epochs, rest_tokens, taken)`` of every row that the mixture takes.

    ``epochs`` counts the times a document is taken whole with its leaf,
    ``rest_tokens`` what the leaf's last, partial epoch takes of it (the
    document where the budget ends is cut), ``taken`` both together.  Null
    names are leaves named by the empty text; null and empty texts have no
    tokens and are taken with a whole epoch only; rows with the same id, or
    without one, follow each other in the order, and a cut takes its tokens of one of them.  An empty
    table gives an empty result; further columns are not looked at.
    """
    narrow = docs.select(
        F.col(id_column), domain.alias("domain"), F.col("lang"), F.col("source"), (word_count(text_column) if tokens is None else tokens).alias("n_tokens")
    )
    planned = plan(docs, share, weights, domain, epochs, seed, tokens, id_column, text_column)
    found = _taken(narrow, planned, F.col("domain"), seed, F.col("n_tokens"), id_column)
    found = found.withColumn("taken", F.col("_epochs") * F.col("n_tokens") + F.col("_rest")).filter((F.col("_epochs") > 0) | (F.col("_rest") > 0))
    return found.select(id_column, "domain", "lang", "source", "n_tokens", F.col("_epochs").alias("epochs"), F.col("_rest").alias("rest_tokens"), "taken")


def keep_mixed(
    docs: DataFrame, share: float, weights: dict[str, Column], domain: Column, seed: int = SEED, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that one epoch of the mixture takes, whole; texts are not shuffled unless the tree is large."""
    planned = plan(docs, share, weights, domain, 1, seed, None, id_column, text_column)
    free = free_name(docs, "_mix")
    found = _taken(docs, planned, domain, seed, word_count(text_column), id_column, free)
    kept = found.filter((F.col(f"{free}_epochs") > 0) | (F.col(f"{free}_rest") > 0))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
