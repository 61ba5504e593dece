import gzip
import json

import pytest
from pyspark.sql import functions as F

from pairloom.operators import vocab
from pairloom.sources import artifacts, corpus

END = "<|endoftext|>"


def texts(frame):
    return [r["text"] for r in frame.orderBy("file_path", "block_start", "doc_id").collect()]


def test_documents_of_a_file(spark, tmp_path):
    (tmp_path / "c.txt").write_bytes(f"a b\r\nc{END}\nd{END}{END}e\n".encode())
    path = f"file:{tmp_path}/c.txt"
    assert texts(corpus.read_corpus(spark, path)) == ["a b\r\nc", "\nd", "e\n"]
    assert texts(corpus.read_corpus(spark, path, drop_empty=False)) == ["a b\r\nc", "\nd", "", "e\n"]
    assert texts(corpus.read_corpus(spark, path, normalize_newlines=True))[0] == "a b\nc"


def test_documents_across_splits(spark, tmp_path):
    docs = [f"document {i} " + "x" * (i * 37 % 500) for i in range(2000)]
    (tmp_path / "c.txt").write_text(END.join(docs))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        frame = corpus.read_corpus(spark, f"file:{tmp_path}/c.txt")
        assert frame.rdd.getNumPartitions() > 5
        assert texts(frame) == docs
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gzip(spark, tmp_path):
    with gzip.open(tmp_path / "d.txt.gz", "wb") as out:
        out.write(f"one{END}two\n".encode())
    assert sorted(r["text"] for r in corpus.read_corpus(spark, f"file:{tmp_path}/d.txt.gz").collect()) == ["one", "two\n"]


def test_invalid_bytes(spark):
    raw = [b"ok", b"a\xff\xfeb", "a�".encode() + b"\xe2\x82", b"", None]
    frame = spark.createDataFrame([(i, bytearray(b) if b is not None else None) for i, b in enumerate(raw)], "i int, raw binary")
    for mode in ("ignore", "replace"):
        got = {r["i"]: r["t"] for r in frame.select("i", corpus.decode_text(F.col("raw"), mode).alias("t")).collect()}
        assert got == {i: None if b is None else b.decode("utf-8", errors=mode) for i, b in enumerate(raw)}
    with pytest.raises(Exception, match="INVALID_UTF8"):
        frame.select(corpus.decode_text(F.col("raw"), "strict")).collect()
    with pytest.raises(ValueError):
        corpus.decode_text(F.col("raw"), "other")


MERGES = [(b"a", b"b"), (b" ", b"\xe2\x82"), (b'"', b"\\"), (b"\n", b"\x00"), (b"ab", b"]")]


def test_files_of_a_tokenizer(spark, tmp_path):
    table, merges = vocab.merged_vocab(spark, MERGES, [END, "é"]), vocab.merges_table(spark, MERGES)
    artifacts.write_vocab(table, f"file:{tmp_path}/v")
    artifacts.write_merges(merges, f"file:{tmp_path}/m")
    again = artifacts.read_vocab(spark, f"file:{tmp_path}/v"), artifacts.read_merges(spark, f"file:{tmp_path}/m")
    assert vocab.verify_tokenizer(table, merges, *again).isEmpty()
    (part,) = (tmp_path / "v").glob("part-*")
    plain = {int(k): v.encode("latin-1") for k, v in json.loads(part.read_text(encoding="utf-8")).items()}
    assert plain == {r["token_id"]: bytes(r["token"]) for r in table.collect()}
    (part,) = (tmp_path / "m").glob("part-*")
    lines = [json.loads(x) for x in part.read_text(encoding="utf-8").splitlines()]
    assert [(a.encode("latin-1"), b.encode("latin-1")) for a, b in lines] == MERGES


def test_other_file_forms(spark, tmp_path):
    (tmp_path / "v.json").write_text(json.dumps({"a": 0, "é": 1, "5": 2}), encoding="utf-8")
    got = artifacts.read_vocab(spark, f"file:{tmp_path}/v.json").collect()
    assert {r["token_id"]: bytes(r["token"]) for r in got} == {0: b"a", 1: b"\xe9", 2: b"5"}
    (tmp_path / "w.json").write_text(json.dumps({"0": "5", "x": "a", "7": "ÿ"}, indent=2), encoding="utf-8")
    got = artifacts.read_vocab(spark, f"file:{tmp_path}/w.json").collect()
    assert {r["token_id"]: bytes(r["token"]) for r in got} == {0: b"5", 7: b"\xff"}
    (tmp_path / "m.txt").write_text('["a", "b"]\nx y z\n\nlonely\n["a"]\n1 2\n["\\u00e2", "q"]\n', encoding="utf-8")
    got = artifacts.read_merges(spark, f"file:{tmp_path}/m.txt").orderBy("rank").collect()
    assert [(r["rank"], bytes(r["l"]), bytes(r["r"])) for r in got] == [
        (0, b"a", b"b"), (1, b"x", b"y z"), (2, b"1", b"2"), (3, b"\xe2", b"q"),
    ]
