"""Language of a text by prediction by partial matching over bytes.

Each language has a tree of byte contexts up to ``ORDER`` bytes, counted on a
bounded sample of labelled texts and then frozen.  A byte costs the escapes of
the longer contexts that have been seen but not with this byte, and then its
share in the first one that has (escape method C; below the empty context all
256 bytes cost the same).  Contexts begin at the white space before a word, so
the code length of a text is the exact sum of those of its words.
"""

from __future__ import annotations

import uuid
from collections import Counter
from math import log2

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import kind_of, map_batches, unit_hash
from pairloom.session import bounded_rows

ORDER = 4
#: Labelled texts a language is learnt from, and languages, at most.
SAMPLE = 600
MOST_LANGUAGES = 256
#: Contexts that all languages have together, at most; more are refused.
MOST_NODES = 8_000_000
#: Words and byte windows remembered in a Python worker; beyond it the memory starts anew.
REMEMBERED = 1_000_000
#: Words of a text looked up at once.
CHUNK = 1 << 15
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def words_of(text: str) -> list[str]:
    return text.lower().split()


def context_counts(docs: DataFrame, lang: str, text: str, order: int = ORDER) -> DataFrame:
    """``(lang, gram, n)``: how often a byte (the last of ``gram``) follows a context (the rest)."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            grams: Counter = Counter()
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in Counter(words_of(value)).items():
                    shown = b" " + word.encode("utf-8") + b" "
                    for at in range(1, len(shown)):
                        for begin in range(max(0, at - order), at + 1):
                            grams[language, shown[begin : at + 1]] += n
            keys = list(grams)
            return {"lang": [k[0] for k in keys], "gram": [k[1] for k in keys], "n": list(grams.values())}

        return work

    counted = map_batches(docs.select(lang, text), make, "lang string, gram binary, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Trees:
    """The frozen statistics: bits of a known step and bits of an escape, by language and context."""

    def __init__(self, rows: list, order: int = ORDER):
        self.order = order
        self.name = uuid.uuid4().hex
        self.languages = sorted({r[0] for r in rows})
        self.step: list[dict[bytes, float]] = [{} for _ in self.languages]
        self.escape: list[dict[bytes, float]] = [{} for _ in self.languages]
        place = {x: k for k, x in enumerate(self.languages)}
        totals: list[dict[bytes, list[int]]] = [{} for _ in self.languages]
        for language, gram, n in rows:
            node = totals[place[language]].setdefault(bytes(gram[:-1]), [0, 0])
            node[0] += n
            node[1] += 1
        for language, gram, n in rows:
            k = place[language]
            seen, kinds = totals[k][bytes(gram[:-1])]
            self.step[k][bytes(gram)] = log2((seen + kinds) / n)
        for k, nodes in enumerate(totals):
            self.escape[k] = {c: log2((seen + kinds) / kinds) for c, (seen, kinds) in nodes.items()}

    def bits(self, language: int, context: bytes, byte: bytes) -> float:
        """Exact code length of ``byte`` after ``context``."""
        step, escape = self.step[language], self.escape[language]
        total = 0.0
        for begin in range(max(0, len(context) - self.order), len(context) + 1):
            part = context[begin:]
            known = step.get(part + byte)
            if known is not None:
                return total + known
            total += escape.get(part, 0.0)
        return total + 8.0


class Words(dict):
    """Maps a word to the row of its code lengths in ``costs``."""

    def __init__(self, trees: Trees):
        super().__init__()
        self.trees = trees
        self.windows: dict[bytes, tuple[float, ...]] = {}
        self.costs = np.zeros((max(2 * CHUNK, min(REMEMBERED, (1 << 23) // max(1, len(trees.languages)))), len(trees.languages)))

    def __missing__(self, word: str) -> int:
        order, windows = self.trees.order, self.windows
        shown = b" " + word.encode("utf-8") + b" "
        rows = []
        for at in range(1, len(shown)):
            window = shown[at - order if at > order else 0 : at + 1]
            found = windows.get(window)
            if found is None:
                if len(windows) >= REMEMBERED:
                    windows.clear()
                found = windows[window] = tuple(
                    self.trees.bits(k, window[:-1], window[-1:]) for k in range(len(self.trees.languages))
                )
            rows.append(found)
        self[word] = row = len(self)
        self.costs[row] = list(map(sum, zip(*rows, strict=True)))
        return row


class Scorer:
    """Code lengths of whole texts, with remembered words."""

    def __init__(self, trees: Trees):
        self.trees = trees
        self.words = Words(trees)

    def lengths(self, text: str) -> np.ndarray:
        """Bits of the text in each language."""
        words, known = words_of(text), self.words
        total = np.zeros(len(self.trees.languages))
        for begin in range(0, len(words), CHUNK):
            part = words[begin : begin + CHUNK]
            if len(known) + len(part) > len(known.costs):
                known.clear()
            total += known.costs[np.fromiter(map(known.__getitem__, part), np.int64, len(part))].sum(axis=0)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.trees.languages or not LETTER.search(text):
            return UNKNOWN, 0.0
        bits = self.lengths(text)
        best = int(bits.argmin())
        return self.trees.languages[best], float(1.0 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum())


_scorers: dict[str, Scorer] = {}


def _scorer(shared: Broadcast) -> Scorer:
    """One scorer a Python worker and model."""
    trees = shared.value
    if trees.name not in _scorers:
        _scorers.clear()
        _scorers[trees.name] = Scorer(trees)
    return _scorers[trees.name]


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", sample: int = SAMPLE, order: int = ORDER, seed: int = 17) -> Trees:
    """Learn from at most ``sample`` different texts a language, chosen by hash; copies teach once.

    Rows without text or language teach nothing; no rows at all give trees
    without languages, which predict ``und``.
    """
    spark = docs.sparkSession
    usable = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and length(text) > 0")
    kinds = usable.select("lang", F.xxhash64("text").alias("h")).distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = bounded_rows(kinds, MOST_LANGUAGES, "the languages")
    # a hash below sample / n keeps about twice the sample of each language's different texts; the rank then keeps it exactly
    share = spark.createDataFrame([(r["lang"], min(1.0, 2.0 * sample / r["n"])) for r in sizes], "lang string, share double")
    drawn = usable.join(F.broadcast(share), "lang").withColumn("_hash", unit_hash(seed, F.xxhash64("text")))
    drawn = drawn.filter(F.col("_hash") <= F.col("share") * float(1 << 60)).dropDuplicates(["lang", "_hash"])
    ranked = drawn.withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy("_hash", "text"))).filter(F.col("_rank") <= sample)
    rows = bounded_rows(context_counts(ranked.select("lang", "text"), "lang", "text", order), MOST_NODES, "the context trees")
    return Trees([tuple(r) for r in rows], order)


def predict(docs: DataFrame, trees: Trees, keep: list[Column] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` of every row.

    The language with the shortest code wins, ties by name; the score is its
    share when all learnt languages are as likely beforehand.  Null texts and
    texts without a letter are ``und`` with score 0.  Only id and text are looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def make():
        scorer = _scorer(shared)

        def work(batch: pa.RecordBatch) -> dict:
            found = [scorer.predict(t) for t in batch.column(1).to_pylist()]
            return {id_column: batch.column(0), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

        return work

    return map_batches(docs.select(id_column, text_column), make, f"`{id_column}` {kind_of(docs, id_column)}, lang_pred string, score double")
