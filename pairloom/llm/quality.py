"""Quality of texts from weak labels.

Heuristic labellers vote good, bad or abstain on every document.  Their votes
overlap; expectation-maximisation over the counts of vote patterns estimates
how accurate each one is on good and on bad documents, without any true label.
The posterior of each document's pattern is the soft label from which a linear
scorer on hashed word features is trained, and that scorer judges all texts.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field
from itertools import islice
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import free_name, kind_of, map_batches, unit_hash
from pairloom.session import bounded_rows

GOOD, BAD, ABSTAIN = 1, 0, -1
LABELLERS = 9
#: Buckets of the hashed features.
BUCKETS = 1 << 15
#: Documents the linear scorer is trained on, about.
SAMPLE = 4000
ROUNDS = 50
STEPS = 150
SEED = 29
REMEMBERED = 1_000_000
THRESHOLD = 0.25

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_OTHER_THAN_UPPER = bytes(b for b in range(256) if b not in _UPPER)
_OTHER_THAN_LOWER = bytes(b for b in range(256) if b not in _LOWER)
_OTHER_THAN_SYMBOLS = bytes(b for b in range(256) if b not in b"#$%&*!|<>{}~^=_\\@")
_PLAIN = re.compile(r"(?<!\S)[(\"']?[^\W\d_][^\W_]*(?:['-]\w+)*[.,;:?!)\"']?(?!\S)")
_ENDS = re.compile(r"\w[.!?]+(?=\s|$)")


def _split(value: float, good: float, bad: float) -> int:
    return GOOD if value <= good else BAD if value >= bad else ABSTAIN


def repeats(words: list[str]) -> int:
    """Words that equal the one before."""
    return sum(map(eq, words, islice(words, 1, None)))


def votes(text: str) -> list[int]:
    """One vote of each labeller.

    Three judge the text as a whole and abstain in between; the others know one
    defect each.  Texts of under 20 words are faulted for what they show, but not praised.
    """
    raw, words = text.encode("utf-8"), text.split()
    n = len(words)
    if not n:
        return [ABSTAIN] * LABELLERS
    upper, lower = len(raw.translate(None, _OTHER_THAN_UPPER)), len(raw.translate(None, _OTHER_THAN_LOWER))
    lines = [x for x in text.split("\n") if x]
    pairs = len(set(zip(words, islice(words, 1, None), strict=False))) / (n - 1) if n > 20 else None
    per_end = n / max(1, len(_ENDS.findall(text)))
    defects = (
        upper > 0.35 * (upper + lower) >= 7,  # shouting
        len(raw.translate(None, _OTHER_THAN_SYMBOLS)) > 0.3 * n,  # symbols
        text.count(" | ") > 0.1 * n,  # cells of a table
        repeats(words) > 0.1 * n,  # repeated words
        not 2 <= sum(map(len, words)) / n <= 12,  # length of words
        len(lines) >= 4 and len(set(lines)) < 0.5 * len(lines),  # repeated lines
    )
    return [
        ABSTAIN if n < 20 else _split(1 - len(_PLAIN.findall(text)) / n, 0.1, 0.25),  # words of letters only
        ABSTAIN if pairs is None else _split(1 - pairs, 0.3, 0.5),  # different pairs of words
        ABSTAIN if n < 20 else GOOD if 2 <= per_end <= 60 else BAD,  # sentences
        *(BAD if defect else ABSTAIN if n < 20 else GOOD for defect in defects),
    ]


def vote_table(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, votes)`` of every row; texts without words get abstentions only."""

    def make():
        return lambda batch: {id_column: batch.column(0), "votes": [votes(t or "") for t in batch.column(1).to_pylist()]}

    return map_batches(docs.select(id_column, text_column), make, f"`{id_column}` {kind_of(docs, id_column)}, votes array<tinyint>")


@dataclass
class Labellers:
    """``accuracies[y][j]``: share of right votes of labeller j on documents of class y; ``prior``: share of good ones."""

    prior: float
    accuracies: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good of each vote pattern; an abstention says nothing."""
        on_bad, on_good = self.accuracies
        odds = (patterns == GOOD) @ np.log(on_good / (1 - on_bad)) + (patterns == BAD) @ np.log((1 - on_good) / on_bad)
        return 1 / (1 + np.exp(-np.clip(odds + np.log(self.prior / (1 - self.prior)), -500, 500)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> Labellers:
    """Expectation-maximisation; ``patterns`` (rows of votes) with their document counts.

    At first a document is believed good unless a labeller faults it, and less for each one that does.
    """
    believed = 0.9 * 0.3 ** (patterns == BAD).sum(axis=1)
    for _ in range(rounds):
        accuracies = np.empty((2, patterns.shape[1]))
        for y, weight in ((GOOD, believed * counts), (BAD, (1 - believed) * counts)):
            right, given = ((patterns == y) * weight[:, None]).sum(axis=0), ((patterns != ABSTAIN) * weight[:, None]).sum(axis=0)
            accuracies[y] = (right + 0.5) / (given + 1.0)
        prior = float(np.clip((believed * counts).sum() / max(1, counts.sum()), 0.01, 0.99))
        model = Labellers(prior, accuracies)
        believed = model.posterior(patterns)
    return model


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float
    labellers: Labellers | None = None
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


_CLASSES = str.maketrans(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "A" * 26 + "a" * 26 + "0" * 10
)
_RUNS = re.compile(r"(.)\1+")


class Features(dict):
    """Maps a word to the buckets of its shape and of its ending."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= REMEMBERED:
            self.clear()
        shape = _RUNS.sub(r"\1\1", word.translate(_CLASSES))
        found = crc32(b"s" + shape.encode("utf-8")) % BUCKETS, crc32(b"e" + word[-2:].encode("utf-8")) % BUCKETS
        self[word] = found
        return found

    def of(self, text: str) -> np.ndarray:
        """Buckets of a text's words, each as often as it occurs, and one for words that follow themselves."""
        words = text.split()
        found = np.array(list(map(self.__getitem__, words)), np.int32).ravel()
        again = repeats(words)
        return np.append(found, np.full(2 * again, REPEATED, np.int32)) if again else found


REPEATED = crc32(b"repeated") % BUCKETS
_features = Features()


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = STEPS) -> Scorer:
    """Logistic regression of soft labels on feature shares, by full-batch adaptive steps."""
    if not rows:
        return Scorer(np.zeros(BUCKETS, np.float32), 0.0)
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    index = np.concatenate([r[0] for r in rows]).astype(np.int64)
    share = np.concatenate([np.asarray(r[1], float) / max(1.0, np.sum(r[1])) for r in rows])
    weights, bias = np.zeros(BUCKETS), 0.0
    mean, square = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for t in range(1, steps + 1):
        score = np.bincount(row, share * weights[index], len(rows)) + bias
        miss = (1 / (1 + np.exp(-np.clip(score, -500, 500))) - labels) / len(rows)
        slope = np.append(np.bincount(index, share * miss[row], BUCKETS), miss.sum())
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        change = 0.5 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
        weights -= change[:-1]
        bias -= float(change[-1])
    return Scorer(weights.astype(np.float32), bias)


def fit(docs: DataFrame, sample: int = SAMPLE, seed: int = SEED, id_column: str = "doc_id", text_column: str = "text") -> Scorer:
    """Labeller accuracies from the votes on all documents, then a scorer trained on at most ``sample`` of them.

    The sample is of different texts, those of smallest hash; copies teach once.

    The driver sees one row a vote pattern (3 to the power of the labellers at
    most) and the hashed features of the sample.  An empty table gives a scorer
    that finds every text even.
    """
    patterns = bounded_rows(
        vote_table(docs, id_column, text_column).groupBy("votes").agg(F.count(F.lit(1)).alias("n")), 3**LABELLERS, "the vote patterns"
    )
    if not patterns:
        return train([], np.zeros(0))
    counts = np.array([r["n"] for r in patterns], float)
    model = estimate(np.array([r["votes"] for r in patterns]), counts)
    # a hash below this keeps about twice the sample of texts that differ; the last of the sample by hash is then the border
    place = unit_hash(seed, F.xxhash64(text_column))
    below = int(min(1.0, 2 * sample / counts.sum()) * (1 << 60))
    border = docs.select(place.alias("h")).filter(F.col("h") <= below).distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    drawn = docs.select(place.alias("h"), F.col(text_column).alias("text")).filter(F.col("h") <= F.lit(-1 if border is None else border))
    drawn = drawn.groupBy("h").agg(F.any_value("text").alias("text"))

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = [np.unique(_features.of(t), return_counts=True) for t in texts]
            return {"h": batch.column(0), "votes": [votes(t) for t in texts], "at": [f[0] for f in found], "n": [f[1] for f in found]}

        return work

    rows = map_batches(drawn, make, "h long, votes array<tinyint>, at array<int>, n array<int>").filter(F.size("at") > 0).orderBy("h").collect()  # the sample
    if not rows:
        return train([], np.zeros(0))
    labels = model.posterior(np.array([r["votes"] for r in rows]))
    scorer = train([(np.array(r["at"]), np.array(r["n"])) for r in rows], labels)
    scorer.labellers = model
    return scorer


def score(docs: DataFrame, scorer: Scorer, id_column: str = "doc_id", text_column: str = "text", carry: bool = False,
          name: str = "quality_score") -> DataFrame:
    """``(id, quality_score)`` of every row, or all columns and the score (``carry``), which ``name`` names.

    The score is the probability of good; texts without words, null ones too, get 0.
    """
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast((scorer.weights, scorer.bias))
    names = docs.columns if carry else [id_column, text_column]
    at = names.index(text_column)

    def make():
        weights, bias = shared.value

        def one(text: str | None) -> float:
            found = _features.of(text) if text else ()
            if not len(found):
                return 0.0
            total = float(weights[found].sum(dtype=np.float64)) / len(found) + bias
            return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))

        def work(batch: pa.RecordBatch) -> dict:
            kept = {n: batch.column(k) for k, n in enumerate(names) if carry or n == id_column}
            return kept | {name: [one(t) for t in batch.column(at).to_pylist()]}

        return work

    kept = names if carry else [id_column]
    schema = ", ".join(f"`{n}` {kind_of(docs, n)}" for n in kept) + f", `{name}` double"
    return map_batches(docs.select(*[f"`{n}`" for n in names]), make, schema)


def keep_good(docs: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the scorer, fitted on ``docs``, does not reject."""
    name = free_name(docs, "quality_score")
    found = score(docs, fit(docs, id_column=id_column, text_column=text_column), id_column, text_column, carry=True, name=name)
    return found.filter(F.col(name) >= threshold).drop(name)
