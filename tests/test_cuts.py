"""Pieces cut on flat arrays are those of the regular expression."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pairloom.functions import bpe, cuts, patterns
from pairloom.operators import encode

END = patterns.END_OF_TEXT
CHARS = ["'", "'", "s", "d", "l", "l", "v", "e", "r", "é", "ß", "中", "𝒜", "1", "٣", "²", " ", " ", "\n", "\t", "\r", " ", " ", "\u0085",
         "᠎", "​", ".", "!", "€", "😀", "́", "_"]


def texts():
    rng = random.Random(5)
    return ["", " ", "  ", "'", "'s", " 's", "\n's", "a's", "'lll", "'s's", "''s", "don't've", "x  ", "x \n y"] + [
        "".join(rng.choice(CHARS) for _ in range(rng.randrange(1, 30))) for _ in range(4000)]


def test_pieces_are_those_of_the_pattern(spark):
    every = texts()
    frame = spark.createDataFrame(list(enumerate(every)), "id int, text string")
    whole = F.regexp_extract_all("text", F.lit(patterns.UNICODE_CLASSES + patterns.PRETOKEN_PATTERN), F.lit(0))
    rows = frame.select("id", whole.alias("want"), patterns.pretokens(F.col("text")).alias("fast")).collect()
    want = {r["id"]: r["want"] for r in rows}
    assert all(r["fast"] == r["want"] for r in rows)
    marked = np.array([k % 7 == 3 for k in range(len(every))])
    array = pa.array(["lost", *every, "lost"]).slice(1, len(every))
    pieces, n = cuts.cut(array, cuts.kinds(spark).value, marked)
    upto, shown = np.concatenate([[0], np.cumsum(n)]), pieces.to_pylist()
    for k, text in enumerate(every):
        assert shown[upto[k] : upto[k + 1]] == (([text] if text else []) if marked[k] else want[k])


def test_every_code_point_has_its_kind(spark):
    points = [p for p in range(cuts.POINTS) if not 0xD800 <= p < 0xE000]
    frame = spark.createDataFrame([(c, "".join(map(chr, points[c : c + 4096]))) for c in range(0, len(points), 4096)], "id int, text string").repartition(8)
    old = F.regexp_extract_all("text", F.lit(patterns.UNICODE_CLASSES + patterns.PRETOKEN_PATTERN), F.lit(0))
    assert frame.filter(old != patterns.pretokens(F.col("text"))).count() == 0
    rows = frame.select("text", old.alias("want")).collect()
    pieces, _ = cuts.cut(pa.array([r["text"] for r in rows]), cuts.kinds(spark).value, np.zeros(len(rows), bool))
    assert pieces.to_pylist() == [p for r in rows for p in r["want"]]


def test_texts_are_encoded_in_slices_and_pieces_remembered(spark, monkeypatch):
    """A text's pieces do not come as one row each piece, a slice is bounded by bytes, and what a task remembers is bounded."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array([["aaaa"], [], ["b", "c"], ["dddd"], ["e"]])], ["id", "parts"])
    monkeypatch.setattr(encode, "MOST_BYTES", 6)
    assert [s.column("id").to_pylist() for s in encode._slices(batch, "parts")] == [[0, 1, 2], [3, 4]]
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    ids = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"<e>": 257}
    encoder = bpe.PieceEncoder([(b"a", b"b")], ids, ["<e>"])
    for words in (["ab", "<e>", "abab"], ["x", "ab", "<e>", "ba"], ["ba", "x" * 70, "abab"], []):
        got, sizes = encoder.encode(pa.array(words, pa.string()))
        fresh, fresh_sizes = bpe.PieceEncoder([(b"a", b"b")], ids, ["<e>"]).encode(pa.array(words, pa.string()))
        assert got.tolist() == fresh.tolist() and sizes.tolist() == fresh_sizes.tolist()
    assert len(encoder._known) == 3


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, f"a{END}b's{END}{END}"), (4, "no end"), (5, END)]
    frame = spark.createDataFrame(rows, "id int, text string").unionByName(
        spark.range(6, 7).select(F.col("id").cast("int"), F.decode(F.unhex(F.lit("C3A9")), "ISO-8859-1").alias("text")))
    frame = frame.unionByName(spark.range(7, 8).select(F.col("id").cast("int"), F.unhex(F.lit("61FF62E282")).cast("string").alias("text")))
    from pairloom.operators.vocab import base_vocab, merges_table

    tok = encode.Tokenizer(base_vocab(spark, (END,)).select("token_id", "token"), merges_table(spark, []), (END,))
    for unit in ("document", "line"):
        cut = {"document": patterns.pieces, "line": patterns.line_pieces}[unit](F.col("text"), (END,))
        want = encode.encode_pieces(frame.select("id", cut.alias("pieces")), tok, "pieces")
        got = encode.encode_documents(frame, tok, keys=("id",), unit=unit)
        assert {r["id"]: r["ids"] for r in got.collect()} == {r["id"]: r["ids"] for r in want.collect()}
