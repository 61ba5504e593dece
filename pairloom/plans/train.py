"""Byte-pair training as a sequence of Spark rounds.

One round takes the most frequent pairs and merges as many of them at once as
provably give the same merge list as one merge at a time would.

State:

* ``words`` - a written table of the distinct words with more than one symbol,
  ``(seq, cnt)``, as they were a number of rounds ago ("base words");
* ``since`` - the merges learned after that table was written;
* an inverted index over the base words, ``(rank, pair, seq, cnt)``: each word
  under each of its tracked pairs, sorted by the pair's rank and cached;
* the tracked pairs with their present counts, the greatest of all pairs and at
  most ``MOST_TRACKED``, in the driver.

A pair with new symbols stands in words that hold every pair of neighbours of its
symbols' parts among the base symbols.  So a round looks its pairs up under the
rarest such base pair, brings the words found there up to date by the merges
since, and goes no further: batches of the cached index whose ranks are not
asked for are skipped by their statistics.  All words are read only when they
are written anew, which cuts the lineage and starts a new index, and when the
tracked pairs run dry.  With a state folder, the words in a saved state are that
table; they are written once.

While most words hold one of the next pairs, as in the first rounds, an index saves
nothing: the base words are then cached and read as a whole, and each task applies the merges since.
The choice is made when words are written, by the measured share, and changes no result.

Counts of existing pairs only fall, and a new pair starts with its full count,
so a pair below the cutoff of the tracked ones never comes back above it.  (A merge
whose bytes are already a symbol is the exception and forces a full count.)

The driver holds the merge list, the tracked pairs, and what stands next to at
most ``MOST_CANDIDATES`` pairs per round.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import runs
from pairloom.functions.symbols import Alphabet, first_of, holds_any, neighbours, string_array
from pairloom.operators.counts import to_byte_symbols, with_sides
from pairloom.operators.merges import PackedMerge
from pairloom.operators.vocab import BYTE_TOKENS, merged_vocab, merges_table
from pairloom.session import bounded_rows, drop_scratch, settle
from pairloom.sources import states

FEWEST_CANDIDATES, MOST_CANDIDATES = 32, 256  # pairs looked at per round
ROUNDS_PER_TABLE = 8  # rounds, and merges, between two written word tables
MERGES_PER_TABLE = 128
INDEX_LASTS = 4  # an index is good for so many times the rounds
INDEXED_SHARE = 0.3  # index the words if less than this share of them holds one of the next pairs
NEXT_PAIRS = 64
PAIRS_KEPT = 5_000  # so many pairs at least are tracked from a full count on
MOST_PAIRS = 1 << 15  # and so many at most
MOST_TRACKED = 2 * MOST_PAIRS  # pairs that are tracked before the lowest are let go
MOST_RANGES = 8  # ranges of ranks that one round asks the index for

Key = tuple[int, bytes, bytes]


@dataclass(frozen=True)
class Candidate:
    left: bytes
    right: bytes
    pair: str
    cnt: int

    @property
    def result(self) -> bytes:
        return self.left + self.right

    @property
    def key(self) -> Key:
        """Order of choice: greatest count, then greatest pair."""
        return self.cnt, self.left, self.right


@dataclass(frozen=True)
class Surroundings:
    """What stands next to the candidates at the start of a round.

    ``before`` and ``after`` hold per pair ``ab`` the greatest count of a run
    ``xab`` and of a run ``aby``: bounds on the pairs that merging ``ab``
    creates.  ``overlaps`` holds the counts of runs whose two halves are both
    candidates.
    """

    before: dict[str, int]
    after: dict[str, int]
    overlaps: dict[str, int]


@dataclass
class Training:
    """Merges learned so far, in rank order, with their counts."""

    spark: SparkSession
    special_tokens: tuple[str, ...]
    merges: list[tuple[bytes, bytes]] = field(default_factory=list)
    merge_counts: list[int] = field(default_factory=list)
    rounds: int = 0

    def vocab(self) -> DataFrame:
        return merged_vocab(self.spark, self.merges, self.special_tokens)

    def merges_table(self) -> DataFrame:
        return merges_table(self.spark, self.merges)


def merge_budget(vocab_size: int, special_tokens: Sequence[str]) -> int:
    budget = vocab_size - BYTE_TOKENS - len(special_tokens)
    if budget < 0:
        raise ValueError(f"a vocabulary of {vocab_size} has no room for the bytes and special tokens")
    return budget


def surroundings(words: DataFrame, candidates: Sequence[Candidate], since: Sequence[PackedMerge] = ()) -> Surroundings:
    """One pass over words that may hold a candidate after the merges ``since``; returns two rows a candidate and one for each run of two."""
    wanted = string_array([c.pair for c in candidates])
    head, tail = F.substring("run", 1, 2), F.substring("run", 2, 2)
    counted = runs.counter(3, steps(since), [c.pair for c in candidates])
    threes = (
        words.select("seq", "cnt")
        .mapInArrow(counted, "run string, cnt long")
        .groupBy("run")
        .agg(F.sum("cnt").alias("cnt"))
        .withColumn("head", F.array_contains(wanted, head))
        .withColumn("tail", F.array_contains(wanted, tail))
    )
    # one key a candidate's side, and one a run of two candidates
    sides = F.array(
        F.when(F.col("head"), F.concat(F.lit(">"), head)),
        F.when(F.col("tail"), F.concat(F.lit("<"), tail)),
        F.when(F.col("head") & F.col("tail"), F.concat(F.lit("="), F.col("run"))),
    )
    per_key = (
        threes.filter(F.col("head") | F.col("tail"))
        .select("cnt", F.explode(F.array_compact(sides)).alias("key"))
        .groupBy("key")
        .agg(F.max("cnt").alias("cnt"))
    )
    found: dict[str, dict[str, int]] = {"<": {}, ">": {}, "=": {}}
    for r in per_key.collect():
        found[r["key"][0]][r["key"][1:]] = r["cnt"]
    return Surroundings(found["<"], found[">"], found["="])


def steps(merges: Sequence[PackedMerge]) -> list[tuple[str, str]]:
    return [(m.pair, m.result) for m in merges]


def counted_pairs(words: DataFrame) -> DataFrame:
    """``(pair, cnt)`` of ``(seq, cnt)``."""
    found = words.select("seq", "cnt").mapInArrow(runs.counter(2), "run string, cnt long")
    return found.groupBy(F.col("run").alias("pair")).agg(F.sum("cnt").alias("cnt"))


def choose_batch(
    candidates: Sequence[Candidate],
    around: Callable[[Sequence[Candidate]], Surroundings],
    alphabet: Alphabet,
    limit: int,
    complete: bool,
) -> list[Candidate]:
    """Merges that one-at-a-time training would make next, in order, as many as are certain.

    ``candidates`` are the best pairs in order; ``complete`` says that there
    are no others.  After each choice the counts of the remaining candidates
    are brought up to date:

    * choosing ``ab`` takes from ``bd`` the runs ``abd``, and from ``ca`` the
      runs ``cab``; other candidates keep their counts;
    * where that is not exactly known - the choice's own count was already
      reduced, or a candidate loses on both sides - the candidate is blurred:
      its count is now an upper bound.

    Self-pairs and pairs that make known bytes are blurred from the start.  The
    next choice must be exact and outrank every blurred candidate, every pair
    outside the list, and every pair that the choices so far create.  Of the
    created pairs, ``(x, ab)`` must have a lower count; for ``(ab, y)`` an
    equal count is enough if the choice's left side is above ``ab``.
    """
    first = candidates[0]
    if limit == 1 or first.left == first.right or first.result in alphabet:
        return [first]
    around_them = around(candidates)
    last_key = (0, b"", b"") if complete else candidates[-1].key
    exact = {c.pair: c for c in candidates if c.left != c.right and c.result not in alphabet}
    blurred = {c.pair: c for c in candidates if c.pair not in exact}
    reduced: dict[str, str] = {}  # pair -> side on which it has lost runs
    chosen: list[Candidate] = []
    while exact and len(chosen) < limit:
        best = max(exact.values(), key=lambda c: c.key)
        if best.key < last_key or any(b.key > best.key for b in blurred.values()):
            break
        for made in chosen:
            before, after = around_them.before.get(made.pair, 0), around_them.after.get(made.pair, 0)
            if best.cnt <= before or best.cnt < after or (best.cnt == after and best.left <= made.result):
                return chosen
        chosen.append(best)
        del exact[best.pair]
        for c in list(exact.values()):
            after_best, before_best = c.left == best.right, c.right == best.left
            if c.result == best.result:
                blurred[c.pair] = exact.pop(c.pair)
            elif after_best or before_best:
                side = "left" if after_best else "right"
                both = (after_best and before_best) or reduced.get(c.pair, side) != side
                if both or best.pair in reduced:
                    blurred[c.pair] = exact.pop(c.pair)
                else:
                    run = best.pair[0] + c.pair if after_best else c.pair + best.pair[1]
                    exact[c.pair] = replace(c, cnt=c.cnt - around_them.overlaps.get(run, 0))
                    reduced[c.pair] = side
    return chosen


def choose_floor(pairs: DataFrame) -> tuple[int, int]:
    """Greatest power of two with at least ``PAIRS_KEPT`` pairs at or above it, and how many there are.

    Reads one row per power of two, so at most 63.
    """
    power = F.length(F.bin("cnt")) - 1
    sizes = {
        r["power"]: r["n"]
        for r in pairs.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    kept = 0
    for step in sorted(sizes, reverse=True):
        kept += sizes[step]
        if kept >= PAIRS_KEPT:
            return 1 << step, kept
    return 1, kept


class _Tracked:
    """The greatest pairs in order of choice; every other pair is below ``cutoff``."""

    def __init__(self, pairs: DataFrame, alphabet: Alphabet) -> None:
        self.alphabet = alphabet
        pairs = pairs.persist()
        floor, above = choose_floor(pairs)
        rows = pairs.filter(F.col("cnt") >= floor)
        self.complete = floor == 1 and above <= MOST_PAIRS
        self.cutoff: Key = (floor, b"", b"")
        if above > MOST_PAIRS:
            # many equal counts: the order of choice decides, in a written table, as a
            # collected limit would send so many rows of every task to the driver
            sides = with_sides(rows, alphabet, "pair", "cnt")
            rows, path = settle(sides.orderBy(F.desc("cnt"), F.desc("l"), F.desc("r")).limit(MOST_PAIRS), "pairs")
        self.counts: dict[str, int] = {r["pair"]: r["cnt"] for r in bounded_rows(rows.select("pair", "cnt"), MOST_PAIRS, "tracked pairs")}
        if above > MOST_PAIRS:
            self.cutoff = min(self.key(p) for p in self.counts)
            drop_scratch(pairs.sparkSession, path)
        pairs.unpersist()

    def key(self, pair: str) -> Key:
        return self.counts[pair], self.alphabet.bytes_of(pair[0]), self.alphabet.bytes_of(pair[1])

    def best(self, k: int) -> list[Candidate]:
        ranked = heapq.nlargest(k, self.counts, key=self.key)
        found = [self.key(p) + (p,) for p in ranked]
        return [Candidate(left, right, pair, cnt) for cnt, left, right, pair in found]

    def beside(self, merges: Sequence[PackedMerge]) -> list[str]:
        """Tracked pairs that may lose occurrences to the merges."""
        lefts, rights = {m.pair[0] for m in merges}, {m.pair[1] for m in merges}
        return [p for p in self.counts if p[1] in lefts or p[0] in rights or p[0] in lefts and p[1] in rights]

    def change(self, deltas: Mapping[str, int]) -> None:
        for pair, delta in deltas.items():
            self.counts[pair] = self.counts.get(pair, 0) + delta
            if self.counts[pair] <= 0 or self.key(pair) < self.cutoff:
                del self.counts[pair]
        if len(self.counts) > MOST_TRACKED:
            kept = heapq.nlargest(MOST_PAIRS, self.counts, key=self.key)
            self.cutoff, self.complete = self.key(kept[-1]), False
            self.counts = {p: self.counts[p] for p in kept}


class _Tables:
    """Words, their index and the tracked pairs of a running training."""

    def __init__(self, words: DataFrame, alphabet: Alphabet, written: bool = False) -> None:
        self.spark = words.sparkSession
        self.alphabet = alphabet
        self.index: DataFrame | None = None
        self.live: DataFrame | None = None  # the base words, cached, where there is no index
        self._scratch: str | None = None
        if written:  # a saved state's words
            self.words = words
        else:
            # spread evenly, as every round's tasks work on these partitions
            parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self._write(words.repartition(parts, "seq"), None)
        self._begin()
        self.count_again()

    def _write(self, words: DataFrame, path: str | None) -> None:
        """Write the words that still have a pair, to ``path`` or the shared folder."""
        live = words.filter(F.length("seq") > 1).select("seq", "cnt")
        before, self._scratch = self._scratch, None
        if path is None:
            self.words, self._scratch = settle(live, "words")
        else:
            live.write.mode("overwrite").parquet(path)
            self.words = self.spark.read.schema(live.schema).parquet(path)
        if before is not None:
            drop_scratch(self.spark, before)

    def _begin(self) -> None:
        self.since: list[PackedMerge] = []
        self.parts: dict[str, str] = {}  # base symbols that a newer symbol is made of
        self.age = 0

    def _prepare(self) -> None:
        """Index the words, or cache them where the index would hold most of them for the next pairs."""
        self._forget()
        ranked = sorted(self.tracked.counts, key=self.tracked.key, reverse=True)
        self.ranks = {pair: rank for rank, pair in enumerate(ranked)}
        if not ranked:
            return
        held = F.avg(holds_any(F.col("seq"), ranked[:NEXT_PAIRS]).cast("int"))
        if (self.words.agg(held).first()[0] or 0) < INDEXED_SHARE:
            self._make_index(ranked)
        else:
            self.live = self.words.persist()

    def _make_index(self, ranked: list[str]) -> None:
        """Each word under its tracked pairs, in order of rank within every partition; nothing is shuffled.

        Ranks travel in one literal of at most ``MOST_TRACKED`` pairs.  They are strings, as generated code
        holds no string literals and so stays the same from round to round.
        """
        ranks = self.spark.range(1).select(F.posexplode(string_array(ranked)).alias("rank", "pair"))
        named = ranks.select(rank_name(F.col("rank")).alias("rank"), "pair")
        held = self.words.select(F.explode(F.array_distinct(neighbours(F.col("seq")))).alias("pair"), "seq", "cnt")
        self.index = held.join(F.broadcast(named), "pair").select("rank", "pair", "seq", "cnt").sortWithinPartitions("rank").persist()

    def _forget(self) -> None:
        for frame in (self.index, self.live):
            if frame is not None:
                frame.unpersist()
        self.index = self.live = None

    def _all_present(self) -> DataFrame:
        words = (self.words if self.live is None else self.live).select("seq", "cnt")
        return words.mapInArrow(runs.merger(steps(self.since)), "seq string, cnt long") if self.since else words

    def base_pair(self, pair: str) -> str | None:
        """The rarest base pair that every word with ``pair`` holds, or None if none was tracked."""
        symbols = "".join(self.parts.get(c, c) for c in pair)
        known = [p for p in map("".join, zip(symbols, symbols[1:])) if p in self.ranks]
        return max(known, key=self.ranks.__getitem__, default=None)

    def can_find(self, pairs: Iterable[str]) -> bool:
        return self.index is None or all(self.base_pair(p) is not None for p in pairs)

    def touched(self, pairs: Iterable[str]) -> DataFrame:
        """``(seq, cnt)``: the base words that may hold one of the pairs after the merges ``since``, each once.

        Where there is no index, these are all.
        """
        if self.live is not None:
            return self.live.select("seq", "cnt")
        wanted = sorted({self.base_pair(p) for p in pairs}, key=self.ranks.__getitem__)
        ranges = rank_ranges([self.ranks[p] for p in wanted])
        ranges += ranges[-1:] * (MOST_RANGES - len(ranges))  # the same plan for any number of them
        asked = reduce(lambda a, b: a | b, (F.col("rank").between(f"{low:08d}", f"{high:08d}") for low, high in ranges))
        # a word may stand under several of the pairs: it counts under the one that comes first in it
        return self.index.filter(asked & (first_of(F.col("seq"), wanted) == F.col("pair"))).select("seq", "cnt")

    def merge(self, merges: Sequence[PackedMerge]) -> None:
        """Apply merges to the pair counts; indexed words follow when they are read."""
        changer = runs.changer(steps(self.since), steps(merges))
        changes = self.touched([m.pair for m in merges]).mapInArrow(changer, "pair string, cnt long")
        deltas = changes.groupBy("pair").agg(F.sum("cnt").alias("cnt"))
        # of the pairs that were there before only the tracked ones come back to the driver,
        # of the new ones only those that reach the cutoff
        beside = self.spark.range(1).select(F.explode(string_array(self.tracked.beside(merges))).alias("pair"), F.lit(True).alias("known"))
        asked = deltas.join(F.broadcast(beside), "pair", "left").filter(F.col("known") | (F.col("cnt") >= self.tracked.cutoff[0]))
        self.tracked.change({r["pair"]: r["cnt"] for r in asked.select("pair", "cnt").collect()})
        for m in merges:
            self.parts[m.result] = "".join(self.parts.get(c, c) for c in m.pair)
        self.since += merges
        self.age += 1

    def rewrite_words(self, path: str | None = None) -> None:
        """Write the words as they are now, which cuts their lineage, and index them."""
        self._write(self._all_present(), path)
        self._begin()
        self._prepare()

    def count_again(self) -> None:
        """Count the pairs of all words, choose the tracked ones and index the words under them."""
        if self.since:
            self._write(self._all_present(), None)
            self._begin()
        self.tracked = _Tracked(counted_pairs(self.words), self.alphabet)
        self._prepare()

    def is_old(self) -> bool:
        rounds = ROUNDS_PER_TABLE * (1 if self.index is None else INDEX_LASTS)
        return self.age >= rounds or len(self.since) >= MERGES_PER_TABLE

    def close(self) -> None:
        self._forget()
        if self._scratch is not None:
            drop_scratch(self.spark, self._scratch)


def rank_name(rank: Column) -> Column:
    return F.lpad(rank.cast("string"), 8, "0")


def rank_ranges(ranks: Sequence[int], most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges that hold all of the sorted ranks, cut at the widest gaps."""
    gaps = sorted(range(1, len(ranks)), key=lambda i: ranks[i] - ranks[i - 1], reverse=True)[: most - 1]
    starts = [0, *sorted(gaps)]
    return [(ranks[a], ranks[b - 1]) for a, b in zip(starts, [*starts[1:], len(ranks)])]


def train_bpe(
    counts: DataFrame,
    vocab_size: int,
    special_tokens: Sequence[str] = (),
    state_path: str | None = None,
) -> Training:
    """Learn merges from ``(pretoken, cnt)`` until the vocabulary is full.

    Training ends early when no pair is left.  With ``state_path`` the state is
    written there every few rounds, for ``resume_training``.
    """
    merge_budget(vocab_size, special_tokens)
    training = Training(counts.sparkSession, tuple(special_tokens))
    return _run(training, to_byte_symbols(counts), vocab_size, state_path)


def resume_training(
    spark: SparkSession, state_path: str, vocab_size: int, special_tokens: Sequence[str] = ()
) -> Training:
    """Continue from the newest complete state below ``state_path``."""
    merge_budget(vocab_size, special_tokens)
    words, merges = states.read_training_state(spark, state_path, special_tokens)
    training = Training(spark, tuple(special_tokens))
    budget = merge_budget(vocab_size, special_tokens)
    training.merges = [(l, r) for l, r, _ in merges[:budget]]  # a smaller vocabulary is a shorter list
    training.merge_counts = [cnt for _, _, cnt in merges[:budget]]
    return _run(training, words, vocab_size, state_path, written=True)


def _run(training: Training, words: DataFrame, vocab_size: int, state_path: str | None, written: bool = False) -> Training:
    budget = merge_budget(vocab_size, training.special_tokens)
    if len(training.merges) >= budget:
        return training
    alphabet = Alphabet(l + r for l, r in training.merges)
    tables = _Tables(words, alphabet, written)
    k = FEWEST_CANDIDATES
    counted = True  # whether the tracked pairs are as many as a full count makes them

    def around(some: Sequence[Candidate]) -> Surroundings:
        return surroundings(tables.touched([c.pair for c in some]), some, tables.since)

    def save() -> None:
        """New base words; in a state folder they are the state's."""
        spark, done = training.spark, len(training.merges)
        path = None if state_path is None or states.is_complete(spark, state_path, done) else states.words_path(state_path, done)
        tables.rewrite_words(path)
        if path is not None:
            states.complete_state(spark, training.merges, training.merge_counts, state_path, training.special_tokens)

    try:
        while len(training.merges) < budget:
            candidates = tables.tracked.best(k)
            if len(candidates) < k and not tables.tracked.complete and not counted:
                tables.count_again()  # before the batches run short
                counted = True
                continue
            if not candidates:
                break
            if not tables.can_find(c.pair for c in candidates):
                tables.rewrite_words()  # every tracked pair is then one of the index
            batch = choose_batch(
                candidates,
                around,
                alphabet,
                budget - len(training.merges),
                complete=tables.tracked.complete and len(candidates) < k,
            )
            known_bytes = batch[0].result in alphabet
            tables.merge([PackedMerge(c.pair, alphabet.add(c.result)) for c in batch])
            training.merges += [(c.left, c.right) for c in batch]
            training.merge_counts += [c.cnt for c in batch]
            training.rounds += 1
            counted = False
            k = min(max(FEWEST_CANDIDATES, 4 * len(batch)), MOST_CANDIDATES)
            if known_bytes:
                tables.count_again()
            if tables.is_old():
                save()
        if state_path is not None and tables.since:
            save()
    finally:
        tables.close()
    return training
