"""The pipeline's near-copy stage against brute force: five-word similarity of 0.8 or more."""

import numpy as np
import random

import corpus_pipeline
from conftest import SMALL
from pairloom.llm import copies, simhash


def runs(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_survivors(rows):
    """Positions of the rows that stay: of each component the first by id, nulls last."""
    sets = [runs(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or (a and b and min(len(a), len(b)) * 5 >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b)):
                group[root(i)] = root(j)
    first = {}
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0)):
        first.setdefault(root(k), k)
    return set(first.values())


def planted(rng):
    """Texts of 200 words with some changed, so that pairs lie on both sides of 0.8, and a chain of small steps."""
    word = lambda: f"w{rng.randrange(10_000)}"
    out = []
    for changes in (1, 2, 3, 4, 5, 6, 8) * 4:
        base = [word() for _ in range(200)]
        out += [" ".join(base), " ".join(word() if k in range(3, 3 + 24 * changes, 24) else w for k, w in enumerate(base))]
    chain = [word() for _ in range(200)]
    for k in range(12):
        chain = [word() if j == 16 * k else w for j, w in enumerate(chain)]
        out.append(" ".join(chain))
    return out


def test_stage_links_at_four_fifths(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(10_000 + k, t) for k, t in enumerate(planted(random.Random(3)))]
    kept = {r["doc_id"] for r in corpus_pipeline.copies_stage(spark, spark.createDataFrame(rows, docs.schema), SMALL).collect()}
    want = {rows[k][0] for k in brute_survivors(rows)}
    assert kept == want and len([i for i in want if i >= 10_000]) < 60


def test_stage_on_null_and_repeated_ids(spark):
    word = " ".join(f"w{k}" for k in range(100))
    rows = [(None, word), (5, word + " end"), (7, "start " + word), (7, "start " + word), (8, "other words here"), (8, "quite another text"),
            (9, None), (10, ""), (None, "no id here at all"), (None, "no id here at all")]
    found = corpus_pipeline.copies_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SMALL).collect()
    want = [(5, word + " end"), (8, "other words here"), (8, "quite another text"), (9, None), (None, "no id here at all")]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_texts_around_one_passage(spark):
    """Many texts hold one passage and little else: alike in part, linked only where they are similar enough."""
    rng = np.random.default_rng(8)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for i in range(400):
        own = [f"w{x}" for x in rng.integers(0, 100_000, int(rng.integers(1, 40)))]
        rows.append((i, f"{' '.join(own)} {passage}"))
        if i % 10 == 0:
            rows.append((1000 + i, f"{' '.join(own[:-1])} {passage} z{i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"] for r in copies.keep_first(docs).collect()}
    assert got == {rows[k][0] for k in brute_survivors(rows)} and len(got) > 100


def test_stage_compares_texts_of_near_fingerprints(spark):
    """The first links come from fingerprints of five-word shingles, with equal ones met by one node."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [r["text"] for r in docs.collect()] + planted(random.Random(4))
    prints = [copies.fingerprint(copies.shingles(t)) for t in texts]
    assert prints[:50] == [simhash.majority([copies.shingles(t)]) for t in texts[:50]]
    nodes = list(enumerate([*prints, *prints[:3]]))
    frame = spark.createDataFrame(nodes, "node long, fp long")
    got = {frozenset(r) for r in copies.near_prints(frame).collect()}
    least = {}
    for node, fp in nodes:
        least.setdefault(fp, node)
    mask = (1 << 64) - 1
    want = {frozenset((a, b)) for x, a in least.items() for y, b in least.items() if a < b and ((x ^ y) & mask).bit_count() <= simhash.MAX_BITS}
    assert got == want | {frozenset((least[fp], n)) for n, fp in nodes if least[fp] != n} and len(want) >= 5


def test_sketches_part_no_similar_sets():
    """Sketches differ in no more bits than sets in shingles, and tell most sets at 0.7 apart from those at 0.8."""
    rng = np.random.default_rng(6)
    apart = 0
    for k in range(200):
        base = np.unique(rng.integers(0, 1 << 63, 300, np.uint64))
        n = int(rng.integers(0, 60))
        other = np.concatenate([base[n:], rng.integers(0, 1 << 63, n, np.uint64)])
        bits = sum(int(x).bit_count() for x in (copies.parities(base) ^ copies.parities(np.sort(other))).view(np.uint64))
        assert bits <= len(np.setxor1d(base, other))
        far = np.concatenate([base[55:], rng.integers(0, 1 << 63, 55, np.uint64)])  # 245 of 355 in common
        bits = sum(int(x).bit_count() for x in (copies.parities(base) ^ copies.parities(far)).view(np.uint64))
        apart += bits > 600 / 9
    assert apart > 180
