"""Operators on documents against brute force, and their edges."""

import random
from collections import Counter, defaultdict
from math import log2

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from pairloom.llm import findings, language, mixing, packing, quality, queries, simhash, tokens

LONG = "lorem ipsum dolor sit amet, " * 8000
ODD = "doc_id long, text string, lang string, source string, n_tokens string, fp string, score string, quality_score string, _mix string, start string"


@pytest.fixture(scope="module")
def docs(spark):
    cached = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    yield cached
    cached.unpersist()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows and columns whose names clash."""
    rows = [(1, None, "en", "a1"), (2, "", "en", "a1"), (3, LONG, "en", "a1"), (4, "two words", None, None), (4, "two words", None, None),
            (None, "no id here", "de", "b2"), (7, "x" * 50_000, "de", "b2"), (8, " \n\t ", None, "b2"), (9, "1234 !!", "fr", None)]
    return spark.createDataFrame([(*r, "c", "c", "c", "c", "c", "c") for r in rows], ODD)


def empty(odd):
    return odd.filter("false")


# --- token counts ---------------------------------------------------------------


@pytest.fixture(scope="module")
def hf():
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    return lambda text: known.encode(text, add_special_tokens=False).ids


def test_every_prefix_has_its_exact_count(hf):
    rng, count = random.Random(1), tokens.counter(queries.vocabulary("byte_bpe_50k.json"))
    bits = ["'ll", "'re", "'", "s", " ", "  ", "\n", "\t", "é", "the", " word", "123", "!!", "<|endoftext|>", "<|endof", "日本", "😀", "\x1c", "\x85", "'l"]
    for _ in range(250):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(0, 11)))
        assert list(np.cumsum(count.steps(text))) == [len(hf(text[:i])) for i in range(1, len(text) + 1)], text


def test_prefix_table(spark, docs, odd, hf):
    path = queries.vocabulary("byte_bpe_50k.json")
    for frame in (docs, odd):
        texts = Counter((r["doc_id"], r["text"]) for r in frame.collect())
        found = tokens.prefix_table(frame, path, budgets=(5,)).withColumn("half", tokens.tokens_in_prefix("steps", (F.col("n_chars") / 2).cast("int")))
        found = found.withColumn("fit", tokens.longest_prefix("steps", 5)).collect()
        got = Counter((r["doc_id"], r["n_bytes"], r["n_chars"], r["n_tokens"]) for r in found)
        assert got == Counter({(i, len((t or "").encode()), len(t or ""), len(hf(t or ""))): n for (i, t), n in texts.items()})
        by_id = {i: t for i, t in texts}
        for r in found[:40]:
            text = by_id[r["doc_id"]] or ""
            assert r["half"] == len(hf(text[: len(text) // 2])) and r["fit"] == r["fit_5"] and len(hf(text[: r["fit"]])) <= 5
    assert tokens.prefix_table(empty(odd), path).count() == 0


# --- quality ---------------------------------------------------------------------


def test_accuracies_are_recovered():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.7
    right = np.array([0.95, 0.8, 0.7, 0.9])
    votes = np.where(rng.random((20_000, 4)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.2] = quality.ABSTAIN
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.estimate(patterns, counts.astype(float))
    assert np.abs(model.accuracies - right).max() < 0.05 and abs(model.prior - 0.7) < 0.05


def test_quality_agrees_with_the_labels(spark):
    folder = SMALL.replace("0.001", "0.01")
    found = queries.op2_weak_label_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    wrong = {r["quality"]: (r["n"], r["bad"]) for r in found.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("keep").cast("int") != F.col("quality")).cast("int")).alias("bad")).collect()}
    assert wrong[1][1] <= 0.005 * wrong[1][0] + 1 and wrong[0][1] <= 0.1 * wrong[0][0]


def test_quality_of_odd_rows(odd):
    scorer = quality.fit(odd)
    got = {(r["doc_id"]): r["quality_score"] for r in quality.score(odd, scorer).collect()}
    assert got[1] == got[2] == got[8] == 0.0 and all(0 <= x <= 1 for x in got.values())
    assert quality.keep_good(odd, 0.0).count() == odd.count() and quality.keep_good(odd).columns == odd.columns
    assert quality.keep_good(empty(odd)).count() == 0


# --- mixing ----------------------------------------------------------------------


def brute_mix(rows, share, weights, epochs, seed):
    """Budgets by repeated filling: what a full child leaves is shared out anew among the others."""
    import hashlib

    leaves = defaultdict(list)
    for i, d, la, s, n in rows:
        leaves[d, la, s].append((i, n))

    def cap(prefix):
        return sum(epochs * sum(n for _, n in v) for k, v in leaves.items() if k[: len(prefix)] == prefix)

    def fill(prefix, budget):
        if len(prefix) == 3:
            return {prefix: budget}
        kids = sorted({k[: len(prefix) + 1] for k in leaves if k[: len(prefix)] == prefix})
        given, left, open_ = {}, budget, set(kids)
        while open_:
            total = sum(weights(k) for k in open_)
            full = {k for k in open_ if cap(k) <= left * weights(k) / total}
            if not full:
                given |= {k: left * weights(k) / total for k in open_}
                break
            for k in full:
                given[k] = cap(k)
            left -= sum(cap(k) for k in full)
            open_ -= full
        return {leaf: b for k in kids for leaf, b in fill(k, given[k]).items()}

    taken = {}
    for leaf, budget in fill((), float(int(sum(r[4] for r in rows) * share))).items():
        size, budget = sum(n for _, n in leaves[leaf]), int(budget + 1e-6)
        whole = min(epochs, budget // size) if size else 0
        rest = budget - whole * size if whole < epochs else 0
        order = sorted(leaves[leaf], key=lambda x: (int(hashlib.md5(f"{seed}:{whole}:{x[0]}".encode()).hexdigest()[:15], 16), x[0]))
        for i, n in order:
            part = min(n, rest)
            rest -= part
            if whole or part:
                taken[i] = whole * n + part
    return taken


@pytest.mark.parametrize("share,epochs", [(0.3, 1), (0.9, 1), (2.5, 4), (9.0, 4)])
def test_mixture(spark, docs, share, epochs):
    rows = docs.select("doc_id", queries.domain(), "lang", "source", mixing.word_count("text")).collect()
    domains = {"d0": 4.0, "d1": 3.0, "d2": 2.0}

    def weight(k):
        return domains.get(k[0], 1.0) if len(k) == 1 else (3.0 if k[1] == "en" else 1.0) if len(k) == 2 else 2.0 if k[2] == "src0" else 1.0

    want = brute_mix([tuple(r) for r in rows], share, weight, epochs, mixing.SEED)
    got = {r["doc_id"]: r["taken"] for r in mixing.mix(docs, share, queries.mixture(), queries.domain(), epochs).collect()}
    # a leaf's budget may differ by one token where rounding of the same share differs
    assert sum(abs(got.get(i, 0) - want.get(i, 0)) for i in got.keys() | want.keys()) <= len({tuple(r)[1:4] for r in rows})


def test_mixture_of_odd_rows(odd):
    got = mixing.mix(odd, 1.0, {}, F.col("lang"), 1).collect()
    assert sum(r["taken"] for r in got) == odd.agg(F.sum(mixing.word_count("text"))).first()[0]
    kept = mixing.keep_mixed(odd, 0.5, {"lang": F.when(F.col("lang") == "de", 0.0).otherwise(1.0)}, F.lit(None))
    assert kept.columns == odd.columns and "de" not in {r["lang"] for r in kept.collect()}
    assert mixing.mix(empty(odd), 0.5, {}, F.col("lang")).count() == 0 and mixing.keep_mixed(empty(odd), 0.5, {}, F.col("lang")).count() == 0


def test_mixing_stays_native(docs):
    plan = mixing.keep_mixed(docs, 0.5, queries.mixture(), queries.domain())._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


# --- language --------------------------------------------------------------------


def test_code_lengths_are_exact(spark):
    rows = spark.createDataFrame([("x", "abab abc"), ("y", "zz top")], "lang string, text string")
    trees = language.fit(rows, order=2)
    counts = defaultdict(Counter)
    for word in ("abab", "abc"):
        shown = f" {word} "
        for at in range(1, len(shown)):
            for begin in range(max(0, at - 2), at + 1):
                counts[shown[begin:at]][shown[at]] += 1

    def bits(context, byte):
        total = 0.0
        for begin in range(max(0, len(context) - 2), len(context) + 1):
            node = counts.get(context[begin:])
            if node is None:
                continue
            n, kinds = sum(node.values()), len(node)
            if byte in node:
                return total - log2(node[byte] / (n + kinds))
            total -= log2(kinds / (n + kinds))
        return total + 8

    for text in ("abba", "abc cab", "qqq"):
        want = sum(bits(f" {w} "[:at], f" {w} "[at]) for w in text.split() for at in range(1, len(w) + 2))
        assert abs(language.Scorer(trees).lengths(text)[trees.languages.index("x")] - want) < 1e-9


def test_languages_held_out(spark):
    folder = SMALL.replace("0.001", "0.01")
    found = queries.op6_ppm_language(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    n, right = found.filter("held_out").agg(F.count(F.lit(1)), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 150 and right >= 0.98 * n


def test_language_of_odd_rows(odd):
    trees = language.fit(odd)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(odd, trees).collect()}
    assert got[1] == got[2] == got[8] == got[9] == ("und", 0.0) and got[3][0] == "en" and got[7][0] == "de"
    nothing = language.fit(empty(odd))
    assert {r["lang_pred"] for r in language.predict(odd, nothing).collect()} == {"und"}
    assert language.predict(empty(odd), trees).count() == 0


# --- packing ---------------------------------------------------------------------


def test_non_negative_least_squares():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a, b = rng.random((6, 9)), rng.random(6) - 0.2
        x = packing.non_negative(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-6 and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-6  # optimality


def test_combinations_fill_the_window():
    found = packing.combinations(12, 4)
    assert len(found) == len(set(found)) == 34 and all(sum(c) == 12 and list(c) == sorted(c, reverse=True) for c in found)


def check_packed(rows, window, ids_of):
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    import zlib

    for i, own in pieces.items():
        at, ids = 0, ids_of(i)
        for start, length, crc, total in sorted(set(own)):
            assert start == at and total == len(ids) and crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    padding = 0
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
        padding += window - at
    return padding, sum(r["length"] for r in rows)


def test_packing(spark, docs, hf):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    padding, total = check_packed(queries.op8_histogram_packing(spark, SMALL).collect(), 2048, lambda i: [*hf(texts[i] or ""), 1])
    assert padding <= 0.02 * total


def test_packing_of_odd_rows(odd, hf):
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    path = queries.vocabulary("byte_bpe_50k.json")
    rows = packing.pack_documents(odd, path).collect()
    check_packed(rows, 2048, lambda i: [*hf(texts[i] or ""), 1])
    assert sum(r["doc_id"] == 4 for r in rows) == 2 * len(packing.cut(len(hf("two words")) + 1, 2048, 64))
    assert packing.pack_documents(empty(odd), path).count() == 0


# --- near copies -----------------------------------------------------------------


def test_chains_lose_no_pair(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(60)]
    prints = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(0, 5))) for b in base for _ in range(6)}
    signed = {p - (1 << 64) if p >> 63 else p: k for k, p in enumerate(sorted(prints))}
    frame = spark.createDataFrame([(k, p) for p, k in signed.items()], "node long, fp long")
    want = {frozenset((a, b)) for p, a in signed.items() for q, b in signed.items() if a < b and ((p ^ q) & (2**64 - 1)).bit_count() <= 3}
    assert {frozenset(r) for r in simhash.links(frame).collect()} == want and len(want) > 100


def plain_print(text):
    import re

    import xxhash

    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """``prints``: (id, print) rows; smallest id reachable over links of at most 3 bits."""
    best = {}
    for i, p in prints:
        best[p] = min(best.get(p, i), i)
    changed = True
    near = {p: [q for q in best if (p ^ q).bit_count() <= 3] for p in best}
    while changed:
        changed = False
        for p, some in near.items():
            least = min(best[q] for q in some)
            if least < best[p]:
                best[p], changed = least, True
    return best


def test_a_cut_within_rows_of_one_id(spark):
    """50 rows of id 1 and 50 without id: the budget is met to the token, and one row is cut."""
    rows = [(1, "a b c d e f g h i j", "en", "s", "x")] * 50 + [(None, f"{k} b c d e f g h i j", "en", "s", "x") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n string")
    for share, want in ((0.3, 300), (0.755, 755), (1.0, 1000)):
        taken = [r["taken"] for r in mixing.mix(docs, share, {}, F.lit("d")).collect()]
        assert sum(taken) == want and sum(t not in (0, 10) for t in taken) == (want % 10 > 0)
    kept = mixing.keep_mixed(docs, 0.3, {}, F.lit("d"))
    assert kept.count() == 30 and kept.columns == docs.columns


def test_near_copies(spark, docs):
    rows = [(r["doc_id"], plain_print(r["text"])) for r in docs.collect()]
    extra = [(10_000 + k, " ".join(w if j != k * 7 % 90 else "changed" for j, w in enumerate(LONG.split()[:600]))) for k in range(12)]
    more = spark.createDataFrame(extra, "doc_id long, text string")
    rows += [(i, plain_print(t)) for i, t in extra]
    best = brute_components(rows)
    got = simhash.near_copies(docs.select("doc_id", "text").unionByName(more)).collect()
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == Counter((i, p, best[p]) for i, p in rows)
    kept = {r["doc_id"] for r in simhash.keep_first(docs.select("doc_id", "text").unionByName(more)).collect()}
    assert kept == {i for i, p in rows if best[p] == i}


def test_rows_without_id_link_others(spark, monkeypatch):
    """A chain of steps of three bits over a row without id: both ends get the smallest id."""
    prints = [(1, 0), (None, 0b111), (3, 0b111111), (9, 0x0F0F0F0F << 32), (None, -1)]
    frame = spark.createDataFrame(prints, "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *rest: docs)
    found = {(r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_copies(frame).collect()}
    assert found == {(1, 0, 1), (None, 0b111, 1), (3, 0b111111, 1), (9, 0x0F0F0F0F << 32, 9), (None, -1, None)}


def test_near_copies_of_odd_rows(odd):
    got = [(r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_copies(odd).collect()]
    assert len(got) == odd.count() and {c for i, f, c in got if f == 0} == {1} and sum(i == 4 for i, _, _ in got) == 2
    kept = [r["doc_id"] for r in simhash.keep_first(odd).collect()]
    assert kept.count(4) == 2 and None in kept and 2 not in kept and 8 not in kept
    assert simhash.near_copies(empty(odd)).count() == 0 and simhash.keep_first(empty(odd)).count() == 0


# --- secrets ---------------------------------------------------------------------


def test_forest_learns_an_interaction():
    rng = np.random.default_rng(7)
    x = rng.random((1500, 5))
    y = (x[:, 0] > 0.5) ^ (x[:, 3] > 0.5)
    forest = findings.Forest().fit(x[:1000], y[:1000])
    assert ((forest.predict(x[1000:]) >= 0.5) == y[1000:]).mean() > 0.9


def test_planted_secrets_are_found(spark):
    import re

    folder = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = Counter((r["doc_id"], m.start(1)) for r in docs.collect() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', r["text"]))
    got = Counter((r["doc_id"], r["start"]) for r in queries.op10_secret_forest(spark, folder).filter("is_secret").collect())
    assert got == want and len(want) > 5
    clean = findings.redact(docs, findings.fit(docs))
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert not any(re.search(r'(?i)token = "[0-9a-f]{40}"', r["text"]) for r in clean.collect())
    assert clean.exceptAll(docs).count() == len({i for i, _ in want})


def test_secrets_of_odd_rows(odd):
    detector = findings.fit(odd)
    assert findings.redact(odd, detector).exceptAll(odd).count() == 0
    assert {r["doc_id"] for r in findings.scan(odd, detector).collect()} == {7}
    assert findings.scan(empty(odd), findings.fit(empty(odd))).count() == 0
