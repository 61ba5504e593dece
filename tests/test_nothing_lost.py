"""Rows never vanish: unknown ids, missing targets, odd files and layouts."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from pairloom.operators import counts, encode, nexttoken, scoring, stream, vocab, windows
from pairloom.plans import train
from pairloom.session import settle
from pairloom.sources import artifacts, corpus
from pairloom.streaming import encode as streaming

END = "<|endoftext|>"


@pytest.fixture(scope="module")
def bytes_only(spark):
    return encode.Tokenizer(vocab.merged_vocab(spark, [], [END]), vocab.merges_table(spark, []), (END,))


def test_lookup_of_an_unknown_id(spark):
    tokens = spark.createDataFrame([(0,), (7,)], "token_id int")
    vectors = spark.createDataFrame([(0, [1.0])], "token_id int, embedding array<float>")
    with pytest.raises(Exception, match="without a vector"):
        scoring.embedding_lookup(tokens, vectors).collect()
    for most in (0, 1 << 20):
        found = scoring.embedding_lookup(tokens, vectors, on_unknown="null", most_broadcast=most).collect()
        assert {r["token_id"]: r["embedding"] for r in found} == {0: [1.0], 7: None}


def test_target_without_a_logit(spark):
    logits = spark.createDataFrame([(1, 0, 0.5), (1, 1, 0.5)], "row_id int, class_id int, logit double")
    targets = spark.createDataFrame([(1, 0), (1, 5)], "row_id int, target int")
    with pytest.raises(Exception, match="without a logit"):
        scoring.cross_entropy(logits, targets).collect()
    with pytest.raises(Exception, match="without a logit"):
        spark.range(1).select(scoring.cross_entropy_array(F.array(F.lit(0.5), F.lit(0.5)), F.lit(5))).collect()
    null = spark.createDataFrame([(1, None)], "row_id int, target int")
    assert [r["loss"] for r in scoring.cross_entropy(logits, null).collect()] == [None]


@pytest.mark.parametrize("p", [0.6, 0.7])
def test_nucleus_does_not_depend_on_the_layout(spark, p):
    probs = spark.range(10).select(F.lit(1).alias("row_id"), F.col("id").cast("int").alias("class_id"), F.lit(0.1).alias("prob"))
    array = spark.range(1).select(F.explode(scoring.top_p_array(F.array(*[F.lit(0.1)] * 10), p)).alias("k")).select("k.class_id", "k.nucleus_prob")
    want = sorted(map(tuple, array.collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 3, 4, 7):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            assert sorted(map(tuple, scoring.top_p_filter(probs, p).select("class_id", "nucleus_prob").collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(want) == round(p * 10) + 1


def test_array_nucleus_needs_no_shuffle(spark):
    frame = spark.range(3).select("id", scoring.top_p_array(F.array(F.lit(0.5), F.lit(0.3), F.lit(0.2)), 0.6).alias("k"))
    drawn = frame.select(scoring.top_p_sample_array(F.col("k"), 1, F.col("id")))
    assert "Exchange" not in drawn._jdf.queryExecution().executedPlan().toString()
    assert {r[0] for r in drawn.collect()} <= {0, 1}


def test_resume_with_a_smaller_size(spark, tmp_path):
    table = counts.count_pretokens(spark.read.parquet(f"{SMALL}/benchmark.parquet")).cache()
    state = f"file:{tmp_path}/state"
    whole = train.train_bpe(table, 256 + 6, state_path=state)
    assert train.resume_training(spark, state, 256 + 3).merges == whole.merges[:3]


def test_merges_with_any_line_end_and_one_file(spark, tmp_path):
    (tmp_path / "m.txt").write_bytes(b"a b\r\nab c\rd e\n")
    rows = artifacts.read_merges(spark, f"file:{tmp_path}/m.txt").collect()
    assert [(bytes(r["l"]), bytes(r["r"])) for r in sorted(rows)] == [(b"a", b"b"), (b"ab", b"c"), (b"d", b"e")]
    (tmp_path / "n.txt").write_text("x y\n")
    with pytest.raises(ValueError):
        artifacts.read_merges(spark, f"file:{tmp_path}")


def test_null_pretoken_has_no_ids(spark, bytes_only):
    frame = spark.createDataFrame([("ab", 1), (None, 2)], "pretoken string, cnt long")
    assert {r["cnt"]: r["ids"] for r in encode.encode_pretokens(frame, bytes_only).collect()} == {1: [97, 98], 2: []}


def test_stream_of_lines_without_a_last_feed(spark, bytes_only, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.txt").write_text(f"a\nb{END}c")
    ids = streaming.encode_stream(streaming.text_stream(spark, f"file:{folder}"), bytes_only, keys=("file_path",))
    streaming.write_encoded(ids, f"file:{tmp_path}/ids", f"file:{tmp_path}/cp").awaitTermination()
    assert sorted(r["ids"] for r in spark.read.parquet(f"file:{tmp_path}/ids").collect()) == [[97, 10], [98, 256, 99]]


def test_stream_of_a_corpus_file_equals_the_encoded_file(spark, bytes_only, tmp_path):
    """Files of several sizes keep their order, and the end id stands where the file has the delimiter."""
    contents = {"a.txt": f"x{END}", "b.txt": f"{'y' * 3000}{END}zz{END}", "c.txt": f"q{END}"}
    for name, value in contents.items():
        (tmp_path / name).write_text(value)
    keys = ("file_path", "block_start", "doc_id")
    docs = corpus.read_corpus(spark, f"file:{tmp_path}/*.txt")
    ids = encode.encode_documents(docs, bytes_only, keys=keys, end_token=END)
    blocks = stream.flatten_token_stream(ids, order=keys, block_size=64).orderBy("block_id").collect()
    want = [256 if part == END else b for value in contents.values() for part in value.replace(END, f"\0{END}\0").split("\0") for b in ([END] if part == END else part.encode())]
    want = [256 if w == END else w for w in want]
    assert [i for r in blocks for i in r["ids"]] == want


def test_compressed_files_are_not_shuffled(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "d.txt.gz", "wb") as out:
        out.write(b"one")
    (tmp_path / "e.txt").write_text("two")
    plan = corpus.read_corpus(spark, f"file:{tmp_path}")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "Exchange" in corpus.read_corpus(spark, f"file:{tmp_path}", partitions=3)._jdf.queryExecution().executedPlan().toString()


def test_windows_open_only_their_files(spark, tmp_path):
    """The manifest names the files of the drawn blocks; the others are not in the plan."""
    ids = spark.range(100).select((F.col("id") * 10).alias("doc_id"), F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (F.col("id") * 10 + i).cast("int")).alias("ids"))
    path = f"file:{tmp_path}/s"
    artifacts.write_token_stream(stream.flatten_token_stream(ids, block_size=7).repartitionByRange(9, "block_id"), path)
    stored = artifacts.open_token_stream(spark, path)
    files = stored.manifest.collect()
    assert sum(f["n_ids"] for f in files) == 1000 == stream.stream_length(stored) and len(files) > 3
    starts = spark.createDataFrame([(0, 5), (1, 985)], "sample_id long, start_pos long")
    found = windows.windows_at(stored, starts, 9, 7)
    assert {r["sample_id"]: r["x"] for r in found.collect()} == {0: list(range(5, 14)), 1: list(range(985, 994))}
    read = stored.blocks_of([0, 1, 140, 142]).inputFiles()
    assert 0 < len(read) <= 2 < len(files)
    assert windows.sample_windows(stored, 50, 9, 3, 7).exceptAll(windows.sample_windows(stored.blocks, 50, 9, 3, 7)).isEmpty()
    many = spark.range(0, 980).select(F.col("id").alias("sample_id"), F.col("id").alias("start_pos"))
    assert all(r["x"] == list(range(r["start_pos"], r["start_pos"] + 9)) for r in windows.windows_at(stored, many, 9, 7).collect())


def _exchanges_of_ids(frame):
    """Shuffles in a plan that carry an array of ids."""
    lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line for line in lines if "Exchange" in line]


def test_ids_are_shuffled_once(spark, tmp_path, monkeypatch):
    """The layout has the one shuffle of ids; blocks are cut without, and written without."""
    plans = {}
    monkeypatch.setattr(stream, "settle", lambda frame, name: plans.setdefault(name, _exchanges_of_ids(frame)) and None or settle(frame, name))
    ids = spark.range(50).select(F.col("id").alias("doc_id"), F.array_repeat(F.col("id").cast("int"), 40).alias("ids"))
    blocks = stream.flatten_token_stream(ids, block_size=64)
    assert len(plans["layout"]) == 1 and "rangepartitioning" in plans["layout"][0]
    cut = [line for line in plans["pieces"] if "BroadcastExchange" not in line]
    assert not any("ids" in line for line in cut)
    # the rest of the plan shuffles only the parts of blocks at the ends of stretches
    whole = blocks._jdf.queryExecution().optimizedPlan().toString()
    assert whole.count("Aggregate [block_id") == 1 and len(_exchanges_of_ids(blocks)) == 1
    assert blocks.count() == 32


def test_stretches_of_any_kind_give_the_same_blocks(spark):
    """Rows in any number of runs, in files read by other tasks than wrote them, empty documents between."""
    rows, at = [], 0
    for n in [3, 0, 5, 1, 0, 0, 12, 7, 2, 30, 1]:
        rows.append((at, list(range(at, at + n))))
        at += n
    frame = spark.createDataFrame(rows, "at long, ids array<int>")
    for parts in (1, 2, 3, 11):
        pieces = stream.cut_blocks(frame.repartition(parts), 4)
        blocks = {r["block_id"]: r["ids"] for r in stream.gather_blocks(pieces, 4).collect()}
        assert blocks == {b: list(range(b * 4, min(b * 4 + 4, at))) for b in range((at + 3) // 4)}
        assert all(len(r["ids"]) <= 4 for r in pieces.collect())
    empty = spark.createDataFrame([], "doc_id long, ids array<int>")
    assert stream.flatten_token_stream(empty).count() == 0


def test_documents_without_a_step_stay(spark):
    rows = spark.createDataFrame([(1, [1, 2, 1, 2]), (2, [3]), (3, [])], "doc_id long, ids array<int>")
    table = nexttoken.next_token_table(rows)
    found = {r["doc_id"]: r for r in nexttoken.score_documents(rows, table, 4).collect()}
    assert found[1]["n_tokens"] == 3 and found[2]["loss"] is None and found[3]["n_tokens"] == 0
    assert abs(found[1]["perplexity"] - (2 * 2 * (5 / 2)) ** (1 / 3)) < 1.0
