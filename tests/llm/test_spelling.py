"""Spelling variants against a search over all pairs."""

import random
import re
import zlib

import pytest

from conftest import SMALL
from pairloom.llm import queries, spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(vocab, times=5):
    rows = {}
    for word, n in vocab.items():
        close = sorted((-vocab[v], v) for v in vocab if near(word, v))
        form = close[0][1] if close and -close[0][0] >= times * n else None
        rows[word] = [form, None, n, len(close), vocab[form] if form else None]
    for word, row in rows.items():
        root = word
        while rows[root][0]:
            root = rows[root][0]
        row[1] = root
    return {w: tuple(r) for w, r in rows.items()}


def brute_vocab(docs, one_in=199):
    counts = {}
    for doc_id, text in docs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % one_in == 0 else run
            counts[word] = counts.get(word, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def shown(frame):
    rows = frame.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_query_equals_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert shown(queries.op12_spelling_machines(spark, SMALL)) == brute_forms(brute_vocab(docs))


@pytest.mark.parametrize("most_words", [2, 7, 20_000])
def test_dense_vocabulary_in_partitions_of_any_size(spark, most_words):
    """Words over two letters, so that most are near each other; small partitions are cut down to one code point."""
    rng = random.Random(most_words)
    words = {"".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 5, 6, 7, 8]))) for _ in range(160)} | {"x" * 500, "x" * 501, "x" * 499 + "y"}
    vocab = {w: rng.choice([5, 5, 26, 130, 700]) for w in words}
    frame = spark.createDataFrame(list(vocab.items()), "word string, n long")
    assert shown(spelling.variants(frame, most_words=most_words)) == brute_forms(vocab)


def test_pairs_come_once(spark):
    vocab = spark.createDataFrame([(w, 5) for w in ("aaaaaa", "aaaaaaa", "aaabaaa", "abaaaa")], "word string, n long")
    rows = [(r["word"], r["near"]) for r in spelling.near_words(vocab).collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == {(a, b) for a in ("aaaaaa", "aaaaaaa", "aaabaaa", "abaaaa") for b in ("aaaaaa", "aaaaaaa", "aaabaaa", "abaaaa") if near(a, b)}


def test_states_are_shared():
    words = sorted(a + b for a in ("in", "un", "re") for b in ("do", "done", "doing"))
    states, start = spelling.minimised(words)
    assert len(states) < sum(len(w) for w in words) / 2

    def accepted(state, read=""):
        final, arcs = states[state]
        return ([read] if final else []) + [w for c, p in arcs for w in accepted(p, read + c)]

    assert sorted(accepted(start)) == words
    assert spelling.minimised([]) == ([(False, ())], 0)
    assert accepted(spelling.minimised([""])[1]) is not None


def test_odd_documents(spark):
    docs = [(None, "Abcdef abcdef"), (None, "abcdef ABCDEF abcdef abcdeg"), (1, None), (2, ""), (2, "Étéabc " * 5 + "abcdef" * 4000)]
    frame = spark.createDataFrame([(*d, "w") for d in docs], "doc_id long, text string, word string")
    runs = spelling.mistyped_runs(frame, one_in=3)
    assert shown(spelling.variants(spelling.vocabulary(runs))) == brute_forms(brute_vocab(docs, 3))
    assert spelling.variants(spelling.vocabulary(spelling.mistyped_runs(frame.limit(0)))).count() == 0


def test_chains_of_forms(spark):
    vocab = {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abcihg": 625, "abjihg": 3125, "akjihg": 15625, "qqqqqq": 10**12}
    frame = spark.createDataFrame(list(vocab.items()), "word string, n long")
    found = shown(spelling.variants(frame))
    assert found == brute_forms(vocab) and found["abcdef"][1] == "akjihg"
