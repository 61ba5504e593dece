import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairloom.functions.draws import hashed_unit
from pairloom.operators import nexttoken, scoring
from pairloom.plans import generate


def long_form(spark, rows):
    flat = [(i, c, float(v)) for i, values in enumerate(rows) for c, v in enumerate(values)]
    return spark.createDataFrame(flat, "row_id long, class_id int, logit double")


def close(got, want):
    assert got == pytest.approx(want, abs=1e-6)


def test_golden_distribution(spark):
    logits = long_form(spark, [[2, 1, 0, -1]])
    probs = scoring.softmax(logits).cache()
    close([r["prob"] for r in probs.orderBy("class_id").collect()], [0.643914, 0.236883, 0.087144, 0.032059])
    half = scoring.top_p_filter(probs, 0.5).collect()
    assert [(r["class_id"], r["nucleus_prob"]) for r in half] == [(0, 1.0)]
    most = scoring.top_p_filter(probs, 0.9).orderBy("class_id").collect()
    close([r["nucleus_prob"] for r in most], [0.665241, 0.244728, 0.090031])
    targets = spark.createDataFrame([(0, 1)], "row_id long, target int")
    close(scoring.cross_entropy(logits, targets).first()["loss"], 1.44019)
    arrays = spark.createDataFrame([([2.0, 1.0, 0.0, -1.0], t) for t in range(3)], "v array<double>, t int")
    losses = arrays.select(scoring.cross_entropy_array(F.col("v"), F.col("t")).alias("loss")).collect()
    close([r["loss"] for r in losses], [0.44019, 1.44019, 2.44019])
    vector = spark.createDataFrame([([3.0, 4.0],)], "v array<float>")
    close(vector.select(scoring.rms_normalize(F.col("v"))).first()[0], [0.848528, 1.13137])
    weighted = scoring.rms_normalize(F.col("v"), F.array(F.lit(2.0), F.lit(0.0)))
    close(vector.select(weighted).first()[0], [1.697056, 0.0])


def test_extreme_logits(spark):
    rows = [[1000.0, 1000.0], [-1000.0, 0.0], [5000.0, -5000.0, 4999.0], [255.9, 256.1]]
    probs = scoring.softmax(long_form(spark, rows)).collect()
    for i, row in enumerate(rows):
        top = max(row)
        total = sum(math.exp(v - top) for v in row)
        got = [r["prob"] for r in sorted((p for p in probs if p["row_id"] == i), key=lambda p: p["class_id"])]
        close(got, [math.exp(v - top) / total for v in row])


def test_long_and_array_forms_agree(spark):
    rng = random.Random(1)
    rows = [[rng.gauss(0, 6) for _ in range(50)] for _ in range(40)]
    long = scoring.softmax(long_form(spark, rows)).collect()
    arrays = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "row_id long, v array<double>")
    wide = {r["row_id"]: r["p"] for r in arrays.select("row_id", scoring.softmax_array(F.col("v")).alias("p")).collect()}
    assert all(abs(r["prob"] - wide[r["row_id"]][r["class_id"]]) < 1e-12 for r in long)
    assert all(abs(sum(p) - 1) < 1e-9 for p in wide.values())


def test_nucleus_is_minimal_and_heavy_enough(spark):
    rng = random.Random(2)
    probs = scoring.softmax(long_form(spark, [[rng.gauss(0, 2) for _ in range(30)] for _ in range(50)])).cache()
    for p in (1e-9, 0.3, 0.95, 1.0):
        kept = scoring.top_p_filter(probs, p).collect()
        by_row: dict = {}
        for r in kept:
            by_row.setdefault(r["row_id"], []).append(r)
        assert len(by_row) == 50
        for rows in by_row.values():
            masses = sorted((r["prob"] for r in rows), reverse=True)
            assert sum(masses) >= min(p, 1 - 1e-9) - 1e-9
            assert sum(masses[:-1]) <= p + 1e-9
            close(sum(r["nucleus_prob"] for r in rows), 1.0)


def test_ties_keep_the_smaller_class(spark):
    probs = scoring.softmax(long_form(spark, [[1, 1, 1, 1]]))
    assert sorted(r["class_id"] for r in scoring.top_p_filter(probs, 0.4).collect()) == [0, 1]


def test_draws_follow_the_nucleus(spark):
    n = 4000
    logits = spark.range(n).select(
        F.col("id").alias("row_id"), F.posexplode(F.array(F.lit(2.0), F.lit(1.0), F.lit(0.0), F.lit(-1.0))).alias("class_id", "logit")
    )
    nucleus = scoring.top_p_filter(scoring.softmax(logits), 0.9).cache()
    drawn = scoring.top_p_sample(nucleus, seed=4).collect()
    shares = Counter(r["class_id"] for r in drawn)
    assert len(drawn) == n and set(shares) == {0, 1, 2}
    for c, want in enumerate((0.665241, 0.244728, 0.090031)):
        assert abs(shares[c] / n - want) < 0.03
    again = scoring.top_p_sample(nucleus.repartition(3), seed=4).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, drawn))


def test_lookup_keeps_every_token_row(spark):
    tokens = spark.createDataFrame([(1, p, p % 2) for p in range(10)], "doc_id long, pos int, token_id int")
    vectors = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "token_id int, embedding array<float>")
    got = {r["pos"]: r["embedding"] for r in scoring.embedding_lookup(tokens, vectors).collect()}
    assert got == {p: [1.0 + p % 2] for p in range(10)}


def sequences(spark):
    rng = random.Random(8)
    rows = [(i, rng.choices(range(6), weights=[5, 4, 3, 2, 1, 1], k=rng.randint(0, 40))) for i in range(60)]
    return rows, spark.createDataFrame(rows, "doc_id long, ids array<int>")


@pytest.mark.parametrize("width", [1, 2])
def test_next_token_counts_and_loss(spark, width):
    rows, frame = sequences(spark)
    want = Counter()
    for _, ids in rows:
        for i in range(width, len(ids)):
            want[tuple(ids[i - width : i]), ids[i]] += 1
    table = nexttoken.next_token_table(frame, width, smoothing=0.5).cache()
    got = table.collect()
    assert {(tuple(r["context"]), r["next"]): r["cnt"] for r in got} == want
    assert all(abs(r["logit"] - math.log(r["cnt"] + 0.5)) < 1e-12 for r in got)
    held_out = [(0, [0, 1, 2, 5, 5, 9, 1]), (1, [3])]
    steps = [(tuple(ids[i - width : i]), ids[i]) for _, ids in held_out for i in range(width, len(ids))]
    totals = Counter()
    for (context, _), n in want.items():
        totals[context] += n
    losses = [-math.log((want[s] + 0.5) / (totals[s[0]] + 0.5 * 10)) for s in steps]
    asked = spark.createDataFrame(held_out, "doc_id long, ids array<int>")
    found = nexttoken.validate_sequences(asked, table, 10, width, 0.5).first()
    assert found["n_tokens"] == len(losses)
    close(found["loss"], sum(losses) / len(losses))


def plain_generation(spark, rows, prompts, temperature, top_p, max_tokens, seed, end):
    counts: dict = {}
    for _, ids in rows:
        for a, b in zip(ids, ids[1:]):
            counts.setdefault(a, Counter())[b] += 1
    draws = {
        (r["id"], r["step"]): r["u"]
        for r in spark.createDataFrame([(p, s) for p, _ in prompts for s in range(max_tokens)], "id long, step int")
        .select("id", "step", hashed_unit(seed, F.col("id"), F.col("step")).alias("u"))
        .collect()
    }
    out = {}
    for key, ids in prompts:
        ids = list(ids)
        for step in range(max_tokens):
            if not ids or ids[-1] not in counts:
                break
            weights = {b: math.exp(math.log(n + 1) / (temperature + 1e-8)) for b, n in counts[ids[-1]].items()}
            total = sum(weights.values())
            order = sorted(((w / total, -b) for b, w in weights.items()), reverse=True)
            kept, before = [], 0.0
            for p, b in order:
                if before > top_p:
                    break
                kept.append((before + p, -b))
                before += p
            chosen = next(b for passed, b in kept if passed > draws[key, step] * before)
            if chosen == end:
                break
            ids.append(chosen)
        out[key] = ids
    return out


@pytest.mark.parametrize("top_p", [1e-9, 0.9])
def test_generation_equals_a_plain_loop(spark, top_p):
    rows, frame = sequences(spark)
    prompts = [(i, ids[:3]) for i, ids in rows] + [(900, [77]), (901, [])]
    sampler = generate.sampler_table(nexttoken.next_token_table(frame), 0.8, top_p)
    asked = spark.createDataFrame(prompts, "prompt_id long, ids array<int>")
    got = generate.generate_batch(asked, sampler, 12, seed=3, end_id=5, steps_per_table=4).collect()
    want = plain_generation(spark, rows, prompts, 0.8, top_p, 12, 3, 5)
    assert {r["prompt_id"]: r["ids"] for r in got} == want
    for r in got:
        first = len(dict(prompts)[r["prompt_id"]])
        assert r["n_new"] == len(r["ids"]) - first <= 12
        assert 5 not in r["ids"][first:]


@pytest.mark.parametrize("top_p", [0.5, 0.9, 1.0])
def test_smoothed_generation_equals_the_whole_vocabulary(spark, top_p):
    rows = [(0, [0, 1, 0, 1, 4, 0, 1]), (1, [4, 5, 4, 5, 0]), (2, [1, 1, 1])]
    size = 9  # 2, 3, 6, 7 and 8 are never seen
    table = nexttoken.next_token_table(spark.createDataFrame(rows, "doc_id long, ids array<int>"), smoothing=0.5)
    counts = {(r["context"][0], r["next"]): r["cnt"] for r in table.collect()}
    whole = [([a], b, math.log(counts.get((a, b), 0) + 0.5)) for a in range(size) for b in range(size)]
    full = generate.sampler_table(spark.createDataFrame(whole, "context array<int>, next int, logit double"), 0.8, top_p)
    short = generate.smoothed_sampler(table, size, 0.8, top_p, 0.5)
    prompts = [(i, [i % size]) for i in range(60)] + [(900, [])]
    asked = spark.createDataFrame(prompts, "prompt_id long, ids array<int>")
    want, got = (
        {r["prompt_id"]: (r["ids"], r["n_new"]) for r in generate.generate_batch(asked, s, 10, seed=5, end_id=7, steps_per_table=4).collect()}
        for s in (full, short)
    )
    assert got == want and got[900] == ([], 0)
    drawn = {(a, b) for ids, _ in got.values() for a, b in zip(ids, ids[1:])}
    assert drawn - set(counts)


def test_smoothed_sampler_refuses_ids_outside_the_vocabulary(spark):
    table = nexttoken.next_token_table(spark.createDataFrame([(0, [0, 5])], "doc_id long, ids array<int>"))
    with pytest.raises(Exception, match="outside the vocabulary"):
        generate.smoothed_sampler(table, 5).collect()
