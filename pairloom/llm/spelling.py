"""Spelling variants: words one edit apart, found by composing finite-state machines.

Two words are near when one inserted, deleted or replaced code point turns one into the other: the pairs accepted by
``A o E o A``, where ``A`` is the minimised acceptor of the vocabulary and ``E`` the transducer that copies, makes one
edit at the first difference, and copies again.  ``E`` edits at the first difference only, so a pair has one path.

*Partitions by initial state.*  The composition is never built whole.  Cut the shorter word at a place ``[a, b)``: if
the edit lies there, both words agree outside of it.  Words that agree outside are those that bring the acceptor (or
the reversed one) into one state; that state is the initial state of one partition, and a task composes
the minimised acceptor of the insides with ``E`` and itself.  Every word is filed for the two halves of its own
length and of the length below.  A partition with too many words is filed again for the halves of its place, until it
is small or its place is one code point wide, where it holds at most one word for every one or two letters.

Defined cases: null texts have no words, a null document id counts as an empty string; a word in many copies counts
with all of them; an empty table or vocabulary gives an empty result; columns other than the id and the text are not
looked at.  Words of any length are whole.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from math import ceil, log, log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import map_batches
from pairloom.session import settle

RUN = "[A-Za-zÀ-ÿ]+"
SHORTEST, FEWEST = 6, 5  # code points and occurrences of a word
TIMES = 5  # a form is so many times as frequent as its variant
MOST_WORDS = 20_000  # words of a partition that may still be cut
MISTYPED = 199  # one in so many runs of the sample query loses a code point


def mistyped_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = MISTYPED) -> DataFrame:
    """``(word)``, one row an occurrence; a checksum of id and run decides which runs lose a code point."""
    lower = F.translate(F.col(text_col), string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
    drawn = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    return drawn.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """``(word, n)``: the distinct words that are long and frequent enough."""
    counted = words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= fewest)


def _filed(words: DataFrame) -> DataFrame:
    """Rows ``(word, n, size, a, b, rest)``: a place of the shorter word's ``size``, and what is outside of it."""
    size, longer = F.col("size"), F.length("word") - F.col("size")
    tail = F.substring("word", F.col("b") + longer + 1, F.length("word"))
    return words.select("word", "n", "size", "a", "b", F.concat(F.substring("word", F.lit(1), F.col("a")), tail).alias("rest"))


def _halves(words: DataFrame) -> DataFrame:
    """Each word for the halves of its own length and, as the longer of two, of the length below."""
    sizes = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size")).filter("size > 0")
    half = F.expr("size div 2")
    places = F.array(F.struct(F.lit(0).alias("a"), half.alias("b")), F.struct(half.alias("a"), F.col("size").alias("b")))
    return _filed(sizes.select("word", "n", "size", F.explode(places).alias("p")).select("word", "n", "size", "p.a", "p.b"))


def _cut_again(filed: DataFrame) -> DataFrame:
    middle = F.expr("(a + b) div 2")
    places = F.array(F.struct("a", middle.alias("b")), F.struct(middle.alias("a"), F.col("b")))
    return _filed(filed.select("word", "n", "size", F.explode(places).alias("p")).select("word", "n", "size", "p.a", "p.b"))


PLACE = ("size", "a", "b", "rest")


def partitions(vocab: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """``(size, a, b, rest, words)``: the partitions with two words or more, one of them of the shorter size.

    Sizes are counted before words are gathered, so no partition above ``most_words`` is gathered unless its place
    is one code point wide.
    """
    filed, found = _halves(vocab), None
    while True:
        counted = filed.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("words"))
        large, _ = settle(counted.filter((F.col("words") > most_words) & (F.col("b") - F.col("a") > 1)).drop("words"), "large")
        last = large.isEmpty()
        small = filed if last else filed.join(large, list(PLACE), "left_anti")
        gathered = small.groupBy(*PLACE).agg(F.collect_list(F.struct("word", "n")).alias("words"), F.min(F.length("word")).alias("least"))
        gathered = gathered.filter((F.size("words") > 1) & (F.col("least") == F.col("size"))).drop("least")
        found = gathered if found is None else found.unionByName(gathered)
        if last:
            return found
        filed, _ = settle(_cut_again(filed.join(large, list(PLACE), "left_semi")), "filed")


State = tuple[bool, tuple[tuple[str, int], ...]]


def minimised(words: list[str]) -> tuple[list[State], int]:
    """States of the smallest acceptor of sorted distinct words, and its start; equal states are shared."""
    register: dict[State, int] = {}
    path: list[tuple[bool, list[tuple[str, int]]]] = [(False, [])]
    before = ""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            state = register.setdefault((final, tuple(arcs)), len(register))
            path[-1][1].append((before[len(path) - 1], state))

    for word in words:
        shared = 0
        while shared < min(len(word), len(before)) and word[shared] == before[shared]:
            shared += 1
        close(shared)
        while len(path) <= len(word):
            path.append((len(path) == len(word), []))
        if not word:
            path[0] = (True, path[0][1])
        before = word
    close(0)
    start = register.setdefault((path[0][0], tuple(path[0][1])), len(register))
    return list(register), start


class Composition:
    """Accepted pairs of ``A o E o A`` for an acceptor ``A``; as long as an edit has not been made, both sides are in one state."""

    def __init__(self, words: list[str]) -> None:
        self.states, self.start = minimised(words)
        self.arcs = [dict(arcs) for _, arcs in self.states]
        self._edits: dict[int, list[tuple[str, str]]] = {}

    def _common(self, left: int, right: int) -> Iterator[str]:
        """Words accepted from both states: the part of the composition after the edit."""
        stack = [(left, right, "")]
        while stack:
            p, q, read = stack.pop()
            if self.states[p][0] and self.states[q][0]:
                yield read
            mine, other = self.arcs[p], self.arcs[q]
            if len(mine) > len(other):
                mine, other = other, mine
            for c in mine:
                if c in other:
                    stack.append((self.arcs[p][c], self.arcs[q][c], read + c))

    def edits_at(self, state: int) -> list[tuple[str, str]]:
        """Pairs (not shorter, not longer) of endings that differ by an edit of their first code point."""
        found = self._edits.get(state)
        if found is None:
            found, arcs = [], list(self.arcs[state].items())
            for i, (x, p) in enumerate(arcs):
                found += [(x + rest, y + rest) for y, q in arcs[i + 1 :] for rest in self._common(p, q)]
                found += [(x + rest, rest) for rest in self._common(p, state) if rest[:1] != x]
            self._edits[state] = found
        return found

    def pairs(self) -> Iterator[tuple[str, str]]:
        stack = [(self.start, "")]
        while stack:
            state, read = stack.pop()
            for longer, shorter in self.edits_at(state):
                yield read + longer, read + shorter
            stack += [(p, read + c) for c, p in self.arcs[state].items()]


def near_words(vocab: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """``(word, near, near_n)``, both directions of every near pair, each once."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"word": [], "near": [], "near_n": []}
            places = (batch.column(c).to_pylist() for c in ("size", "a", "b", "words"))
            for size, a, b, words in zip(*places):
                inside = {w["word"][a : b + len(w["word"]) - size]: (w["word"], w["n"]) for w in words}
                for longer, shorter in Composition(sorted(inside)).pairs():
                    # two longer words meet in the partitions of their own length, and an
                    # edit behind the place in that of the next place
                    if len(shorter) != b - a or (b < size and longer.startswith(shorter)):
                        continue
                    one, two = inside[longer], inside[shorter]
                    for (word, _), (near, n) in ((one, two), (two, one)):
                        out["word"].append(word)
                        out["near"].append(near)
                        out["near_n"].append(n)
            return out

        return work

    return map_batches(partitions(vocab, most_words), make, "word string, near string, near_n long", step=64)


def variants(vocab: DataFrame, times: int = TIMES, most_words: int = MOST_WORDS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the vocabulary ``(word, n)``.

    ``form`` is the near word of the largest ``n`` (of equal ones the smallest), if it is at least ``times`` the
    word's.  Along forms ``n`` grows by that factor, so a chain is short; roots are found by doubling.
    """
    vocab, _ = settle(vocab, "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near"))).alias("best")
    near = near_words(vocab, most_words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    frequent = -F.col("best.minus_n")
    has_form: Column = frequent >= times * F.col("n")
    found, _ = settle(
        vocab.join(near, "word", "left").select(
            "word",
            F.when(has_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, frequent).alias("form_n"),
        ),
        "forms",
    )
    most, least = found.agg(F.max("n"), F.min("n")).first()
    hops = 0 if not most else int(log(most / least) / log(times) + 1e-9)
    links = found.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(hops)) if hops > 1 else 0):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        links, _ = settle(links.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "roots")
    return found.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
