"""Batched merging gives the merge list of one merge at a time."""

import random
from collections import Counter

import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.functions.symbols import Alphabet
from pairloom.plans.train import Candidate, Surroundings, choose_batch


def batched(counts, n, k):
    """The training loop over plain dictionaries."""
    words = Counter()
    for text, cnt in counts.items():
        words[plain.split_bytes(text)] += cnt
    alphabet, merges, rounds = Alphabet(), [], 0
    while len(merges) < n:
        pairs = +plain.count_pairs(words)
        best = sorted(pairs.items(), key=lambda kv: (kv[1], kv[0]), reverse=True)[:k]
        if not best:
            break
        candidates = [Candidate(l, r, alphabet.char(l) + alphabet.char(r), c) for (l, r), c in best]

        def around(some):
            before, after, overlaps = Counter(), Counter(), {}
            runs = Counter()
            for word, cnt in words.items():
                for run in zip(word, word[1:], word[2:]):
                    runs["".join(map(alphabet.char, run))] += cnt
            names = {c.pair for c in some}
            for run, cnt in runs.items():
                if run[:2] in names:
                    after[run[:2]] = max(after[run[:2]], cnt)
                if run[1:] in names:
                    before[run[1:]] = max(before[run[1:]], cnt)
                if run[:2] in names and run[1:] in names:
                    overlaps[run] = cnt
            return Surroundings(before, after, overlaps)

        batch = choose_batch(candidates, around, alphabet, n - len(merges), len(pairs) <= k)
        assert batch
        for c in batch:
            alphabet.add(c.result)
            merges.append((c.left, c.right, c.cnt))
            merged = Counter()
            for word, cnt in words.items():
                merged[plain.merge_word(word, c.left, c.right)] += cnt
            words = merged
        rounds += 1
    return merges, rounds


@settings(max_examples=400, deadline=None)
@given(
    st.dictionaries(st.text("abcd", min_size=1, max_size=9), st.integers(1, 6), min_size=1, max_size=12),
    st.integers(1, 25),
    st.integers(1, 12),
)
def test_random_small_alphabets(counts, n, k):
    assert batched(counts, n, k)[0] == plain.train(counts, n)


@pytest.mark.parametrize("seed", range(40))
def test_random_words(seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 4))) for _ in range(12)]
    counts = Counter("".join(rng.choices(stems, k=rng.randint(1, 4))) for _ in range(150))
    assert batched(counts, 60, 32)[0] == plain.train(counts, 60)


def test_batches_are_larger_than_one():
    rng = random.Random(1)
    counts = {"".join(rng.choices("etaoinshrdlu", weights=range(12, 0, -1), k=6)): rng.randint(1, 99) for _ in range(400)}
    merges, rounds = batched(counts, 60, 64)
    assert merges == plain.train(counts, 60)
    assert rounds < 40
