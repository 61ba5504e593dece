"""Keys that hold most rows: split joins, scores, generation; and vocabulary files of a million tokens."""

import pytest
from pyspark.sql import functions as F

from pairloom.operators import joins, nexttoken
from pairloom.plans import generate
from pairloom.sources import artifacts


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("shares", [2, 50, 4096])
def test_split_join_equals_join(spark, how, shares):
    left = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("k"))
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 60, 2)], "k string, v int")
    want = sorted(map(tuple, left.join(right, "k", how).select("id", "k", "v").collect()), key=str)
    got = joins.split_join(left, right, ["k"], how, shares=shares)
    assert sorted(map(tuple, got.select("id", "k", "v").collect()), key=str) == want
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = {r["k"] for r in joins.hot_keys(counts, ["k"], shares).collect()}
    assert "hot" in hot and len(hot) < max(shares, 42)


def test_null_keys_stay_on_the_left(spark):
    left = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "id long, k string")
    right = spark.createDataFrame([("a", 5)], "k string, v int")
    got = {r["id"]: r["v"] for r in joins.split_join(left, right, ["k"], "left", shares=2).collect()}
    assert got == {1: None, 2: 5, 3: None}


def _rows_per_task(frame, column):
    """Rows in each partition of a frame that were joined for the column's value 'hot'."""
    parts = frame.filter(F.col(column) == "hot").groupBy(F.spark_partition_id().alias("p")).count().collect()
    return [r["count"] for r in parts]


def test_rows_of_a_hot_key_are_not_gathered(spark):
    left = spark.range(0, 8000, 1, 8).select("id", F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = left.select("k").distinct().withColumn("v", F.length("k"))
    sizes = _rows_per_task(joins.split_join(left, right, ["k"]), "k")
    assert sum(sizes) == 7200 and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


def test_scores_with_one_step_in_every_document(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.array(F.lit(1), F.lit(2), (F.col("id") % 50 + 3).cast("int"), F.lit(1), F.lit(2)).alias("ids"))
    table = nexttoken.next_token_table(docs)
    got = {r["doc_id"]: (r["n_tokens"], r["loss"]) for r in nexttoken.score_documents(docs, table, 60).collect()}
    own = nexttoken.count_steps(docs, 1, "ids", ["doc_id"])
    losses = nexttoken.step_losses(own.groupBy("context", "next").agg(F.sum("cnt").alias("cnt")), table, 60).drop("cnt")
    want = own.join(losses, ["context", "next"]).groupBy("doc_id").agg(F.sum("cnt").alias("n"), (F.sum(F.col("cnt") * F.col("loss")) / F.sum("cnt")).alias("loss"))
    for r in want.collect():
        assert got[r["doc_id"]][0] == r["n"] == 4 and abs(got[r["doc_id"]][1] - r["loss"]) < 1e-9
    assert len(got) == 400


def test_large_sampler_gives_the_same_texts(spark, monkeypatch):
    """All prompts at one context and a sampler above the broadcast size: the same ids as with a small one."""
    docs = spark.createDataFrame([(i, [1, 2 + i % 3, 5, 1, 6, 2, 1, 7]) for i in range(30)], "doc_id long, ids array<int>")
    table = nexttoken.next_token_table(docs)
    prompts = spark.createDataFrame([(i, [9, 1]) for i in range(200)] + [(900, [4, 5]), (901, [])], "prompt_id long, ids array<int>")
    for sampler in (generate.sampler_table(table, 1.0, 0.9), generate.smoothed_sampler(table, 12, 1.0, 0.9)):
        monkeypatch.setattr(generate, "SAMPLER_BYTES", 64 << 20)
        want = sorted(map(str, generate.generate_batch(prompts, sampler, 4, seed=3).collect()))
        monkeypatch.setattr(generate, "SAMPLER_BYTES", 0)
        assert sorted(map(str, generate.generate_batch(prompts, sampler, 4, seed=3).collect())) == want


def test_vocabulary_of_a_million_tokens(spark, tmp_path):
    path = f"file:{tmp_path}/vocab"
    vocab = spark.range(1_000_000).select(F.col("id").cast("int").alias("token_id"), F.encode(F.concat(F.lit('"\\é'), F.col("id").cast("string")), "ISO-8859-1").alias("token"))
    artifacts.write_vocab(vocab.repartition(8), path)
    back = artifacts.read_vocab(spark, path).select("token_id", "token")
    assert back.count() == 1_000_000 and back.exceptAll(vocab).isEmpty()
    (file,) = tmp_path.glob("vocab/part-*.txt")
    import json

    assert list(json.loads(file.read_text(encoding="utf-8")))[:3] == ["0", "1", "2"]


def test_vocabularies_without_tokens_or_with_repeated_ids(spark, tmp_path):
    empty = spark.createDataFrame([], "token_id int, token binary")
    artifacts.write_vocab(empty, f"file:{tmp_path}/none")
    assert artifacts.read_vocab(spark, f"file:{tmp_path}/none").count() == 0
    twice = spark.createDataFrame([(1, bytearray(b"a")), (1, bytearray(b"b"))], "token_id int, token binary")
    with pytest.raises(ValueError, match="make no vocabulary"):
        artifacts.write_vocab(twice, f"file:{tmp_path}/twice")
