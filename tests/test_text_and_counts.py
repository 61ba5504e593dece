import plain
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from pairloom.functions import patterns
from pairloom.functions.symbols import Alphabet, bracketed, holds_any
from pairloom.operators import counts, merges, text

END = patterns.END_OF_TEXT


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def cut(spark, value, specials=(), keep=True):
    frame = docs_of(spark, value)
    rows = text.pretokenize(frame, specials, keep_special=keep).orderBy("pos").collect()
    return [r["pretoken"] for r in rows]


def test_pattern_golden(spark):
    value = "I'll don't  pay 12€\n\n x'S\t\n"
    want = ["I", "'ll", " don", "'t", " ", " pay", " 12", "€", "\n\n", " x", "'", "S", "\t\n"]
    assert cut(spark, value) == want == plain.cut_text(value)


@pytest.mark.parametrize(
    "value",
    ["", "   ", "aaaa", "a\r\nb", "x  y", "a\u0085 b", "\U0001f600\U0001f600 ok", "é́ñ", "a\n\n\nb", END, END * 3, f"hi  {END}\n{END}x "],
)
def test_cuts_like_the_pattern(spark, value):
    assert cut(spark, value, (END,)) == plain.cut_text(value, (END,))


def test_null_text_has_no_pretokens(spark):
    assert cut(spark, None, (END,)) == []


def test_cut_is_lossless(spark):
    for name, column in (("documents", "text"), ("pages", "html"), ("conversations", "text")):
        frame = spark.read.parquet(f"{SMALL}/{name}.parquet").select(F.col(column).alias("text"))
        joined = F.concat_ws("", patterns.pieces(F.col("text"), (END,)))
        assert frame.filter(joined != F.col("text")).count() == 0


def test_longest_special_token_wins(spark):
    specials = ["<a>", "<a><b>"]
    rows = text.split_special(docs_of(spark, "x<a><b>y<a><a>"), specials).orderBy("seg_pos").collect()
    assert [(r["segment"], r["is_special"]) for r in rows] == [
        ("x", False), ("<a><b>", True), ("y", False), ("<a>", True), ("<a>", True),
    ]
    assert cut(spark, "x<a><b>y", specials) == plain.cut_text("x<a><b>y", specials)


def test_special_tokens_with_pattern_characters(spark):
    specials = [r"\Q$1.*\E", "(x|y)+"]
    value = r"a\Q$1.*\Eb(x|y)+c"
    assert cut(spark, value, specials) == plain.cut_text(value, specials)


def test_empty_special_token_is_refused(spark):
    with pytest.raises(ValueError):
        cut(spark, "a", [""])


def test_lines_keep_their_feed(spark):
    rows = text.split_lines(docs_of(spark, "a\n\nb", "c\n", "")).orderBy("doc_id", "line_no").collect()
    assert [(r["doc_id"], r["line"]) for r in rows] == [(0, "a\n"), (0, "\n"), (0, "b"), (1, "c\n")]


def test_counts_add_up_over_shards(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    whole = counts.count_pretokens(docs)
    shards = [counts.count_pretokens(docs.filter(F.col("doc_id") % 3 == i)) for i in range(3)]
    assert counts.merge_pretoken_counts(*shards).exceptAll(whole).isEmpty()


def test_pairs_count_every_position(spark):
    words = counts.to_byte_symbols(spark.createDataFrame([("aaa", 5), ("ab", 2)], "pretoken string, cnt long"))
    found = {(r["l"], r["r"]): r["cnt"] for r in counts.count_pairs(words).collect()}
    assert found == {("61", "61"): 10, ("61", "62"): 2}
    top = counts.top_pairs(spark.createDataFrame([("61", "7A", 3), ("62", "61", 3), ("63", "61", 1)], "l string, r string, cnt long"))
    assert [(r["l"], r["r"]) for r in top.collect()] == [("62", "61")]


def test_merge_is_greedy_from_the_left(spark):
    alphabet = Alphabet()
    packed = merges.pack_merges([(b"a", b"a"), (b"aa", b"a")], alphabet)
    words = counts.to_byte_symbols(spark.createDataFrame([("aaaaa", 1)], "pretoken string, cnt long"))
    seq = merges.apply_merges(words, packed[:1]).select(alphabet.hex_sequence(F.col("seq"))).first()[0]
    assert seq == "<6161><6161><61>"
    seq = merges.apply_merges(words, packed).select(alphabet.hex_sequence(F.col("seq"))).first()[0]
    assert seq == "<6161><616161>"


def test_merges_at_once_equal_a_chain(spark):
    learned = [(l, r) for l, r, _ in plain.train({"abcabcabd": 3, "bcabcd": 2, "dcbaabc": 5}, 12)]
    assert len(learned) == 12
    alphabet = Alphabet()
    packed = merges.pack_merges(learned, alphabet)
    words = counts.to_byte_symbols(spark.createDataFrame([("abcabcabd", 1), ("ddcba", 1)], "pretoken string, cnt long"))
    at_once = merges.apply_merges(words, packed)
    step = words
    for merge in packed:
        step = merges.apply_merges(step, [merge])
    assert at_once.exceptAll(step).isEmpty()


def test_delta_equals_a_recount(spark):
    words = counts.to_byte_symbols(counts.count_pretokens(spark.read.parquet(f"{SMALL}/documents.parquet")))
    alphabet = Alphabet()
    packed = merges.pack_merges([(b"e", b"r")], alphabet)
    old = counts.count_pairs(words, alphabet)
    new = counts.count_pairs(merges.apply_merges(words, packed), alphabet)
    delta = merges.pair_count_delta(words, b"e", b"r", alphabet)
    updated = old.unionByName(delta.withColumnRenamed("delta", "cnt")).groupBy("l", "r").agg(F.sum("cnt").alias("cnt"))
    assert updated.filter("cnt <> 0").exceptAll(new).isEmpty() and new.exceptAll(updated).isEmpty()


def test_finding_pairs_of_any_characters(spark):
    awkward = ["]^", "a-", "\\E", "&&", "\n\x00", "\x85 ", "\U00012345\u0100", "[a"]
    frame = spark.createDataFrame([(p, f"x{p}y") for p in awkward] + [("none", "xyzab&E-^")], "name string, seq string")
    found = frame.filter(holds_any(F.col("seq"), awkward)).collect()
    assert sorted(r["name"] for r in found) == sorted(awkward)


def test_symbols_beyond_the_basic_plane(spark):
    alphabet = Alphabet(i.to_bytes(3, "big") for i in range(70_000))
    late = (69_999).to_bytes(3, "big")
    char = alphabet.char(late)
    assert ord(char) > 0xFFFF and alphabet.bytes_of(char) == late
    frame = spark.createDataFrame([(f"a{char}b{char}{char}", 1)], "seq string, cnt long")
    found = {(r["l"], r["r"]): r["cnt"] for r in counts.count_pairs(frame, alphabet).collect()}
    x = late.hex().upper()
    assert found == {("61", x): 1, (x, "62"): 1, ("62", x): 1, (x, x): 1}


def test_bracketed_bytes(spark):
    assert docs_of(spark, " é").select(bracketed(F.col("text"))).first()[0] == "<20><C3><A9>"
