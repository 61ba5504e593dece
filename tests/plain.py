"""Slow single-machine counterparts that tests compare with."""

from __future__ import annotations

from collections import Counter
from itertools import accumulate, pairwise

import regex

# fixed value
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def cut_text(text, specials=()):
    """Pre-tokens and special tokens in order."""
    if not specials:
        return regex.findall(PATTERN, text)
    either = "|".join(regex.escape(t) for t in sorted(specials, key=len, reverse=True))
    out = []
    for part in regex.split(f"({either})", text):
        out += [part] if part in specials else regex.findall(PATTERN, part)
    return out


def merge_word(word, left, right):
    """A word is its bytes and the places where symbols end; a merge takes away the place inside each chosen pair."""
    gone = set()
    for k, pair in enumerate(pairwise(word)):
        if pair == (left, right) and k - 1 not in gone:
            gone.add(k)
    ends = [end for k, end in enumerate(accumulate(map(len, word))) if k not in gone]
    whole = b"".join(word)
    return tuple(whole[a:b] for a, b in pairwise([0, *ends]))


def count_pairs(words):
    return Counter(pair for word, n in words.items() for pair in pairwise(word) for _ in range(n))


def split_bytes(text):
    return tuple(map(bytes, zip(text.encode())))


def train(counts, n):
    """One merge at a time: (left, right, count) in order."""
    words = Counter()
    for text, cnt in counts.items():
        words[split_bytes(text)] += cnt
    merges = []
    for _ in range(n):
        pairs = +count_pairs(words)
        if not pairs:
            break
        (left, right), cnt = max(pairs.items(), key=lambda kv: (kv[1], kv[0]))
        merges.append((left, right, cnt))
        merged = Counter()
        for word, k in words.items():
            merged[merge_word(word, left, right)] += k
        words = merged
    return merges


def encode_piece(piece, ranks):
    """Symbols once no ranked pair is left, always merging the one of lowest rank."""
    word = split_bytes(piece)
    while present := ranks.keys() & set(pairwise(word)):
        word = merge_word(word, *min(present, key=ranks.get))
    return list(word)
