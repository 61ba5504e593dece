"""Words as flat arrays: counts, merges and cuts of many words at once against one word at a time."""

import random

import numpy as np
import pyarrow as pa

from pairloom.functions import runs
from pairloom.functions.bpe import MergeRanks, MergeTable, PieceEncoder
from pairloom.operators.encode import _encode_batch, _shorter
from pairloom.operators import encode

WORDS = ["", "a", "aa", "aaa", "aaaaaaa", "abab", "bab", "äöä", "āaā", "\U0001f600\U0001f600x", "abcabc" * 50]


def batches(words, counts, step=3):
    for at in range(0, len(words), step):
        yield pa.RecordBatch.from_arrays([pa.array(words[at : at + step], pa.string()), pa.array(counts[at : at + step], pa.int64())], ["seq", "cnt"])


def added(found, key):
    out = {}
    for batch in found:
        for k, n in zip(batch.column(key).to_pylist(), batch.column("cnt").to_pylist()):
            out[k] = out.get(k, 0) + n
    return {k: n for k, n in out.items() if n}


def by_hand(words, counts, width, sign=1):
    out = {}
    for w, n in zip(words, counts):
        for i in range(len(w) - width + 1):
            out[w[i : i + width]] = out.get(w[i : i + width], 0) + sign * n
    return out


def test_counts_and_changes_by_hand():
    counts = [10**15 + 7 * k for k in range(len(WORDS))]  # beyond what a double holds once added up
    assert added(runs.counter(2)(batches(WORDS, counts)), "run") == by_hand(WORDS, counts, 2)
    near = {k: n for k, n in by_hand(WORDS, counts, 3).items() if k[:2] in ("ab", "aa") or k[1:] in ("ab", "aa")}
    assert added(runs.counter(3, near=["ab", "aa"])(batches(WORDS, counts)), "run") == near
    merges = [("aa", "Ȁ"), ("ab", "ȁ"), ("Ȁa", "Ȃ")]
    after = list(WORDS)
    for pair, result in merges:
        after = [w.replace(pair, result) for w in after]
    got = [w for b in runs.merger(merges)(batches(WORDS, counts)) for w in b.column("seq").to_pylist()]
    assert got == after
    first = [w.replace("aa", "Ȁ") for w in WORDS]
    want = by_hand(after, counts, 2)
    for k, n in by_hand(first, counts, 2).items():
        want[k] = want.get(k, 0) - n
    changes = runs.changer(merges[:1], merges[1:])(batches(WORDS, counts))
    assert added(changes, "pair") == {k: n for k, n in want.items() if n}


def test_cuts_of_many_words(monkeypatch):
    rng = random.Random(5)
    for dense in (1024, 0):
        monkeypatch.setattr(MergeTable, "DENSE", dense)
        for _ in range(30):
            symbols = [b"a", b"b", b"c"]
            merges = []
            for _ in range(rng.randrange(12)):
                pair = (rng.choice(symbols), rng.choice(symbols))
                merges.append(pair)
                symbols.append(pair[0] + pair[1])
            words = ["".join(rng.choice("abc") for _ in range(rng.randrange(14))) for _ in range(60)] + ["a" * 700, "é", ""]
            ranks = MergeRanks(merges)
            got, sizes = MergeTable(ranks).cut(pa.array(words, pa.string()).slice(1))
            ends = np.cumsum(sizes)
            cut = [got[e - n : e].tolist() for e, n in zip(ends, sizes)]
            assert cut == [ranks.cut(w.encode()) for w in words[1:]]


def test_slices_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(encode, "MOST_PIECES", 3)
    ids = {bytes([i]): i for i in range(256)} | {b"<e>": 256, b"ab": 257}
    encoder = PieceEncoder([(b"a", b"b")], ids, ["<e>"])
    rows = [["ab", "<e>", "ab", "b", "abab"], [], ["<e>"], ["c"], [""], ["ab"] * 4, []]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["pieces"]).slice(0)
    parts = list(_shorter(batch, "pieces"))
    got = [r for p in parts for r in _encode_batch(p.column("pieces"), encoder).to_pylist()]
    assert got == [[257, 256, 257, 98, 257, 257], [], [256], [99], [], [257] * 4, []]
    assert len(parts) > 3 and all(p.num_rows == 1 or len(p.column("pieces").flatten()) <= 3 for p in parts)
    assert encoder.ids("<e>") == [256]
