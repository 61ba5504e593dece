import random

import plain
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from pairloom.functions.bpe import MergeRanks
from pairloom.operators import decode, encode, nexttoken, vocab
from pairloom.plans import generate
from pairloom.streaming import encode as streaming

END = "<|endoftext|>"


@pytest.fixture(scope="module")
def merges(spark):
    from pairloom.operators.counts import count_pretokens

    rows = count_pretokens(spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()
    return [(l, r) for l, r, _ in plain.train({r["pretoken"]: r["cnt"] for r in rows}, 120)]


@pytest.fixture(scope="module")
def tok(spark, merges):
    return encode.Tokenizer(vocab.merged_vocab(spark, merges, [END]), vocab.merges_table(spark, merges), (END,))


def test_cut_takes_the_lowest_rank_first():
    rng = random.Random(3)
    for _ in range(300):
        pool = [bytes([b]) for b in b"abc"]
        merges = []
        for _ in range(rng.randint(1, 10)):
            pair = (rng.choice(pool), rng.choice(pool))
            if pair not in merges:
                merges.append(pair)
                pool.append(pair[0] + pair[1])
        rng.shuffle(merges)
        ranks = MergeRanks(merges)
        word = "".join(rng.choices("abc", k=rng.randint(1, 14)))
        got = [ranks.symbols[s] for s in ranks.cut(word.encode())]
        assert got == plain.encode_piece(word, {p: i for i, p in enumerate(merges)}), (merges, word)


def test_very_long_word_is_quick():
    ranks = MergeRanks([(b"a", b"a"), (b"aa", b"aa"), (b"a", b"b")])
    symbols = [ranks.symbols[s] for s in ranks.cut(b"a" * 300_001 + b"b")]
    assert symbols == [b"aaaa"] * 75_000 + [b"ab"]


def test_repeated_pair_has_its_last_rank():
    ranks = MergeRanks([(b"a", b"b"), (b"b", b"c"), (b"a", b"b")])
    assert [ranks.symbols[s] for s in ranks.cut(b"abc")] == [b"a", b"bc"]


def test_documents_match_the_plain_encoder(spark, tok, merges):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet").select(
        "conv_id", "turn", F.concat("role", F.lit(END), "text").alias("text")
    )
    ids = encode.encode_documents(turns, tok, keys=("conv_id", "turn", "text")).collect()
    ranks = {p: i for i, p in enumerate(merges)}
    token_id = {**{bytes([b]): b for b in range(256)}, **{l + r: 257 + i for i, (l, r) in enumerate(merges)}}
    for row in ids:
        want = []
        for piece in plain.cut_text(row["text"], (END,)):
            want += [256] if piece == END else [token_id[s] for s in plain.encode_piece(piece, ranks)]
        assert row["ids"] == want


def test_same_ids_for_any_partitioning(spark, tok):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    one = encode.encode_documents(docs.repartition(1), tok)
    many = encode.encode_documents(docs.repartition(13, "source"), tok)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_encoding_does_not_shuffle(spark, tok, tmp_path):
    # a table of its own, as another test may have cached the sample
    spark.read.parquet(f"{SMALL}/documents.parquet").write.parquet(f"file:{tmp_path}/documents")
    plan = encode.encode_documents(spark.read.parquet(f"file:{tmp_path}/documents"), tok)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_line_units_cut_white_space_runs(spark, tok):
    docs = spark.createDataFrame([(1, "a\n\n\nb")], "doc_id long, text string")
    lines = encode.encode_lines(docs, tok).orderBy("line_no").collect()
    assert [r["ids"] for r in lines] == [[97, 10], [10], [10], [98]]
    whole = encode.encode_documents(docs, tok, unit="line").first()["ids"]
    assert whole == [i for r in lines for i in r["ids"]]


def test_stream_equals_batch(spark, tok, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    source = spark.readStream.schema(docs.schema).option("pathGlobFilter", "documents.parquet").parquet(SMALL)
    out = f"file:{tmp_path}/out"
    streaming.write_encoded(streaming.encode_stream(source, tok), out, f"file:{tmp_path}/state").awaitTermination()
    got, want = spark.read.parquet(out), encode.encode_documents(docs, tok)
    assert got.count() == docs.count() and got.exceptAll(want).isEmpty()
    with pytest.raises(ValueError):
        streaming.encode_stream(docs, tok)


def test_stream_of_lines_continues_after_a_restart(spark, tok, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def run():
        lines = streaming.text_stream(spark, f"file:{folder}")
        ids = streaming.encode_stream(lines, tok, keys=("file_path",))
        streaming.write_encoded(ids, f"file:{tmp_path}/ids", f"file:{tmp_path}/cp").awaitTermination()
        return sorted(r["ids"] for r in spark.read.parquet(f"file:{tmp_path}/ids").collect())

    (folder / "one.txt").write_text(f"a\nb{END}\n")
    assert run() == [[97, 10], [98, 256, 10]]
    (folder / "two.txt").write_text("c\n")
    assert run() == [[97, 10], [98, 256, 10], [99, 10]]


def test_missing_vocabulary_entry_is_an_error(spark):
    tok = encode.Tokenizer(vocab.base_vocab(spark).filter("token_id <> 97"), vocab.merges_table(spark, []))
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(Exception, match="lacks a token"):
        encode.encode_documents(docs, tok).collect()


def test_decode_joins_bytes_before_decoding(spark, tok):
    rows = [(1, [0xE2, 0x82, 0xAC]), (2, [0xE2, 0x82]), (3, []), (4, None), (5, [97, 256])]
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in decode.decode(frame, tok.vocab).collect()}
    assert got == {1: "€", 2: "�", 3: "", 4: None, 5: f"a{END}"}


def test_decode_of_random_bytes_equals_python(spark, tok):
    rng = random.Random(5)
    rows = [(i, [rng.choice([rng.randrange(256), 0xE2, 0x82, 0xF0, 0x9F, 97]) for _ in range(12)]) for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in decode.decode(frame, tok.vocab).collect()}
    assert all(got[i] == bytes(ids).decode("utf-8", errors="replace") for i, ids in rows)


def test_unknown_id(spark, tok):
    frame = spark.createDataFrame([(1, [97, 99999])], "doc_id long, ids array<int>")
    assert decode.decode(frame, tok.vocab, on_unknown="null").first()["text"] is None
    with pytest.raises(Exception, match="id without a token"):
        decode.decode(frame, tok.vocab).collect()


def test_roundtrip(spark, tok):
    texts = ["", "a\r\n b", " \u0085x", "\U0001f600é", f"{END}{END} y", "\x00\x01", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert decode.roundtrip_audit(docs, tok).isEmpty()


def test_roundtrip_returns_what_differs(spark, tok, monkeypatch):
    texts = ["ab", "cd", "ab", None, "cd"]
    docs = spark.createDataFrame([(None if i == 4 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    right = decode.encode_documents

    def wrong(*args):
        ids = F.when(F.coalesce("doc_id", F.lit(1)) == 1, F.array(F.lit(120))).otherwise(F.col("ids"))
        return right(*args).withColumn("ids", ids)

    monkeypatch.setattr(decode, "encode_documents", wrong)
    found = sorted(decode.roundtrip_audit(docs, tok).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    assert [tuple(r) for r in found] == [(1, "cd", "x"), (None, "cd", "x")]


def test_texts_go_on_as_ids_do(spark, tok, monkeypatch):
    docs = spark.createDataFrame([(1, "abcabcabd"), (2, "bcab abd")], "doc_id long, text string")
    sampler = generate.sampler_table(nexttoken.next_token_table(encode.encode_documents(docs, tok, end_token=END)), 0.8, 0.9)
    prompts = spark.createDataFrame([(1, "ab"), (2, "zz"), (3, None), (4, " b")], "prompt_id long, text string")
    got = {r["prompt_id"]: (r["text"], r["n_new"]) for r in generate.continue_texts(prompts, tok, sampler, 6, END, seed=2).collect()}
    monkeypatch.setattr(generate, "SAMPLER_BYTES", -1)
    ids = generate.generate_batch(encode.encode_documents(prompts, tok, keys=("prompt_id",)), sampler, 6, seed=2, end_id=tok.id_of(END))
    want = {r["prompt_id"]: (r["text"], r["n_new"]) for r in decode.decode(ids, tok.vocab).collect()}
    assert got == want and got[2] == ("zz", 0) and got[3] == ("", 0)
    assert got[1][0].startswith("ab") and got[4][0].startswith(" b")
