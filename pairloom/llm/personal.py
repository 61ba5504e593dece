"""Personal data: fixed patterns find seeds, the words around seeds become patterns that find what has another form.

Everything is DataFrame and SQL functions; no Python runs in tasks.

1. *Seeds.*  Emails, IP addresses, card and phone numbers by regular expression, leftmost and without overlap per
   kind.  ``split`` and ``regexp_extract_all`` see the same matches, so the lengths of pieces and matches, added up
   in log2 steps inside the row, are the places; no text is shuffled.
2. *Mentions.*  Every run without blanks that holds a digit or an at sign (with the digit groups behind it) is a
   possible identifier.  Its lexical patterns are the two words before it, and the word before with the word behind.
3. *Graph.*  An edge joins a pattern and an instance (a mention's value), once however many documents are copies of
   one another.  Instances that are seeds have score 1 for their kind.  In each round a pattern's score for a kind is
   the share of its instances' scores, and an instance's score is one minus the product of what its patterns leave
   open.  Scores are whole units, so they do not depend on the order of addition.
4. *Finds.*  A mention that is no seed, has a form possible for the kind and stands in a pattern whose score and
   support reach the thresholds is a further span.  Spans of seeds always stay; a find never overlaps one.

Frequent patterns and instances are added up inside tasks before the shuffle; scores are joined back over a salt, so
the edges of one pattern spread over many tasks.  Patterns with fewer instances than the support needs are left out at
the start: they could never be accepted.

Defined cases: a null text has no spans, like an empty one; repeated rows and ids, and null ids, are rows of their
own; without seeds, or with an empty table, nothing is learnt; columns other than id and text are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.session import settle

KINDS = ("email", "ip", "card", "phone")
#: The seeds' forms.  Possessive repeats and starts at the beginning of a run (or where the last match ended) give
#: the same matches as plain repeats do, in time linear in the text and without deep recursion.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character that every match of a kind holds: texts without it are not searched.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
MENTION = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\x20(?=[0-9(])[0-9().-]++(?!\S))*+"
OPENING, CLOSING = "\"'`<>[]{}*_#=:;,!?|~", "\"'`<>[]{}*_#=:;,.!?|~"  # not part of a mention at its ends
#: Forms that a find of a kind may have; wider than the seeds'.
POSSIBLE = {
    "email": r"^[^@\s]+@[^@\s]+$",
    "ip": r"^[0-9A-Fa-f]{1,4}(?:[.:][0-9A-Fa-f]{0,4}){3,7}$",
    "card": r"^[0-9][0-9\x20-]*[0-9]$",
    "phone": r"^[+(]?[0-9][0-9\x20().-]*[0-9]$",
}
DIGITS = {"card": (12, 19), "phone": (7, 15)}
WINDOW = 40  # characters before and behind a mention that are looked at for words
ROUNDS = 3
SUPPORT = 3  # different instances of a kind that a pattern must hold
CONFIDENCE = 0.6
UNIT = 1_000_000  # scores are whole units of one millionth
SALTS = 16


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    weighted = F.transform(F.split(F.reverse(digits), ""), lambda c, i: c.cast("int") * (1 + i % 2))
    total = F.aggregate(weighted, F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(_digits(value)).between(12, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _running(sizes: Column) -> Column:
    """Inclusive running sums of an array in log2(size) passes over it."""
    steps = F.when(F.size(sizes) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(sizes).cast("double"))).cast("int") - 1)).otherwise(F.expr("array()").cast("array<int>"))
    return F.aggregate(
        steps, sizes, lambda done, j: F.transform(done, lambda x, i: x + F.coalesce(F.get(done, i - F.call_function("shiftleft", F.lit(1), j)), F.lit(0)))
    )


def _placed(frame: DataFrame, text: str, pattern: str, needs: str, out: str) -> DataFrame:
    """Add ``out``: the matches with their places, ``array<struct<start, end, value, before, after>>``.

    ``before`` and ``after`` are the ends of the pieces next to the match.
    """
    searched = F.when(F.contains(F.col(text), F.lit(needs)), F.col(text)).otherwise("") if needs else F.col(text)
    # an empty array for texts without a match, before anything is split
    found = frame.withColumn(f"{out}_m", F.regexp_extract_all(searched, F.lit(pattern), F.lit(0)))
    cut = F.when(F.size(f"{out}_m") > 0, F.split(F.col(text), pattern, -1)).otherwise(F.expr("array()").cast("array<string>"))
    found = found.withColumn(f"{out}_p", cut)
    sizes = F.transform(f"{out}_m", lambda m, i: F.length(m) + F.length(F.get(f"{out}_p", i)))
    found = found.withColumn(f"{out}_s", F.when(F.size(f"{out}_m") > 0, _running(sizes)).otherwise(F.expr("array()").cast("array<int>")))

    def one(m: Column, i: Column) -> Column:
        end = F.get(f"{out}_s", i)
        return F.struct(
            (end - F.length(m)).cast("long").alias("start"),
            end.cast("long").alias("end"),
            m.alias("value"),
            F.right(F.get(f"{out}_p", i), F.lit(WINDOW)).alias("before"),
            F.left(F.get(f"{out}_p", i + 1), F.lit(WINDOW)).alias("after"),
        )

    return found.withColumn(out, F.transform(f"{out}_m", one)).drop(f"{out}_m", f"{out}_p", f"{out}_s")


def seed_spans(texts: DataFrame, text: str = "text") -> DataFrame:
    """Add ``seeds``: ``array<struct<start, rank, end, kind>>`` in order of start and kind."""
    found = texts
    for kind in KINDS:
        found = _placed(found, text, FORMS[kind], NEEDS[kind], f"_{kind}")

    def spans(rank: int, kind: str) -> Column:
        good = F.filter(f"_{kind}", lambda m: _valid(kind, m["value"]))
        return F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))

    return found.withColumn("seeds", F.array_sort(F.concat(*(spans(*k) for k in enumerate(KINDS))))).drop(*(f"_{k}" for k in KINDS))


def _possible(kind: str, value: Column) -> Column:
    fits = value.rlike(POSSIBLE[kind])
    return fits & F.length(_digits(value)).between(*DIGITS[kind]) if kind in DIGITS else fits


def _label(value: Column) -> Column:
    """The kind of a value that holds a seed, or null."""

    def holds(kind: str) -> Column:
        return F.exists(F.regexp_extract_all(value, F.lit(FORMS[kind]), F.lit(0)), lambda m: _valid(kind, m))

    return F.coalesce(*(F.when(holds(k), k) for k in ("email", "ip", "phone", "card")))


def mentions(placed: DataFrame) -> DataFrame:
    """``(row, start, end, value, label, pattern)`` of every possible identifier; two patterns at most for each."""
    rows = placed.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    inner = F.ltrim("value", F.lit(OPENING))
    start = F.col("start") + F.length("value") - F.length(inner)
    value = F.rtrim(inner, F.lit(CLOSING))
    words = F.regexp_extract_all(F.lower("before"), F.lit(r"\p{L}+"), F.lit(0))
    trimmed = rows.select(
        "row",
        start.alias("start"),
        (start + F.length(value)).alias("end"),
        value.alias("value"),
        F.try_element_at(words, F.lit(-2)).alias("l2"),
        F.try_element_at(words, F.lit(-1)).alias("l1"),
        F.nullif(F.regexp_extract(F.lower("after"), r"\p{L}+", 0), F.lit("")).alias("r1"),
    ).filter("value <> ''")
    patterns = F.array_compact(F.array(F.concat("l2", F.lit(" "), "l1", F.lit(" *")), F.concat("l1", F.lit(" * "), "r1")))
    return trimmed.withColumn("label", _label(F.col("value"))).select("row", "start", "end", "value", "label", F.explode(patterns).alias("pattern"))


def _score(kind: str) -> str:
    return f"s_{kind}"


def _confidence(kind: str) -> str:
    return f"c_{kind}"


def graph(found: DataFrame, support: int = SUPPORT) -> DataFrame:
    """Edges ``(pattern, value, label, s_<kind>...)`` of patterns with enough instances to be accepted at all."""
    edges = found.groupBy("pattern", "value").agg(F.max("label").alias("label"))
    wide = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"))
    wide = wide.filter((F.col("n") >= support) & (F.col("labelled") > 0)).select("pattern")
    kept = _salted(edges, wide, "pattern", "value")
    scores = [F.when(F.col("label") == k, UNIT).otherwise(0).cast("long").alias(_score(k)) for k in KINDS]
    return kept.select("pattern", "value", "label", *scores)


def _salted(edges: DataFrame, rows: DataFrame, key: str, other: str) -> DataFrame:
    """Edges joined with at most one row a ``key``; a key's edges are dealt to tasks by their other end."""
    dealt = edges.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)))
    copies = rows.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return dealt.join(copies, [key, "salt"]).drop("salt")


def pattern_scores(edges: DataFrame, support: int = SUPPORT) -> DataFrame:
    """``(pattern, c_<kind>...)``: units of confidence, zero without enough instances of the kind."""
    sums = edges.groupBy("pattern").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.sum(_score(k)).alias(_score(k)) for k in KINDS),
        *(F.sum(F.when(F.col(_score(k)) * 2 >= UNIT, 1).otherwise(0)).alias(f"n_{k}") for k in KINDS),
    )
    cut = [F.when(F.col(f"n_{k}") >= support, F.expr(f"{_score(k)} div (n + 1)")).otherwise(0).cast("long").alias(_confidence(k)) for k in KINDS]
    return sums.select("pattern", *cut)


def _instance_scores(edges: DataFrame) -> DataFrame:
    """``(value, s_<kind>...)`` from the confidence of the patterns around each value."""
    open_ = [
        F.sum(F.round(-F.log(1 - F.least(F.col(_confidence(k)), F.lit(UNIT - 1)) / UNIT) * UNIT).cast("long")).alias(_confidence(k)) for k in KINDS
    ]
    met = edges.groupBy("value").agg(F.max("label").alias("label"), *open_)
    scores = [
        F.when(F.col("label") == k, UNIT)
        .when(F.col("label").isNotNull() | ~_possible(k, F.col("value")), 0)
        .otherwise(F.round((1 - F.exp(-F.col(_confidence(k)) / UNIT)) * UNIT))
        .cast("long")
        .alias(_score(k))
        for k in KINDS
    ]
    return met.select("value", *scores)


def learn(edges: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT) -> DataFrame:
    """Scores of all patterns after so many rounds over the graph, ``(pattern, c_<kind>...)``, written."""
    edges, _ = settle(edges, "edges")
    for _ in range(rounds - 1):
        met = _salted(edges.select("pattern", "value", "label"), pattern_scores(edges, support), "pattern", "value")
        values = _instance_scores(met)
        edges, _ = settle(_salted(edges.select("pattern", "value", "label"), values, "value", "pattern"), "edges")
    return settle(pattern_scores(edges, support), "patterns")[0]


def finds(found: DataFrame, scores: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    """``(row, start, rank, end, kind)`` of mentions that are no seeds, in patterns of enough confidence."""
    least = int(confidence * UNIT)
    good = scores.filter(reduce(lambda a, b: a | b, [F.col(_confidence(k)) >= least for k in KINDS]))
    met = _salted(found.filter("label is null"), good, "pattern", "row")
    fits = [
        F.when(
            (F.col(_confidence(k)) >= least) & _possible(k, F.col("value")),
            F.struct((-F.col(_confidence(k))).alias("minus"), F.lit(rank).alias("rank"), F.lit(k).alias("kind")),
        )
        for rank, k in enumerate(KINDS)
    ]
    best = met.select("row", "start", "end", F.explode(F.array_compact(F.array(*fits))).alias("f"))
    chosen = best.groupBy("row", "start", "end").agg(F.min("f").alias("f"))
    return chosen.select("row", "start", "f.rank", "end", "f.kind")


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """``(id, seeds, spans)`` for every row: arrays of ``(start, rank, end, kind)`` in order; ``spans`` holds the seeds too."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = _placed(seed_spans(texts), "text", MENTION, "", "mentions").drop("text")
    placed, _ = settle(placed.withColumn("row", F.monotonically_increasing_id()), "mentions")
    found, _ = settle(mentions(placed), "patterns-met")
    more = finds(found, learn(graph(found, support), rounds, support), confidence)
    per_row = more.groupBy("row").agg(F.collect_list(F.struct("start", "rank", "end", "kind")).alias("finds"))
    joined = placed.select("row", "id", "seeds").join(per_row, "row", "left")
    free = F.filter("finds", lambda f: ~F.exists("seeds", lambda s: (s["start"] < f["end"]) & (s["end"] > f["start"])))
    spans = F.when(F.col("finds").isNull(), F.col("seeds")).otherwise(F.array_sort(F.concat("seeds", free)))
    return joined.select(F.col("id").alias(id_col), "seeds", spans.alias("spans"))


def shown(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
