import plain
import pytest

from conftest import SMALL
from pairloom.operators import counts, vocab
from pairloom.operators.encode import Tokenizer, encode_documents, segmented_words
from pairloom.operators.decode import decode
from pairloom.functions.symbols import Alphabet
from pairloom.plans import train
from pairloom.session import settle as real

END = "<|endoftext|>"
GOLDEN = (
    "low low low low low<|endoftext|>lower lower widest widest widest"
    "<|endoftext|>newest newest newest newest newest newest"
)


def table_of(spark, found):
    return spark.createDataFrame(list(found.items()), "pretoken string, cnt long")


def learned(training):
    return [(l, r, c) for (l, r), c in zip(training.merges, training.merge_counts)]


def test_golden_training_and_encoding(spark):
    docs = spark.createDataFrame([(1, GOLDEN)], "doc_id long, text string")
    trained = train.train_bpe(counts.count_pretokens(docs, [END]), 265, [END])
    assert learned(trained) == [
        (b"s", b"t", 9), (b"e", b"st", 9), (b"o", b"w", 7), (b"l", b"ow", 7),
        (b"w", b"est", 6), (b"n", b"e", 6), (b"ne", b"west", 6), (b" ", b"newest", 5),
    ]
    tok = Tokenizer(trained.vocab(), trained.merges_table(), (END,))
    asked = spark.createDataFrame([(1, f"lowest newer{END}low"), (2, None), (3, "")], "doc_id long, text string")
    ids = encode_documents(asked, tok)
    assert {r["doc_id"]: r["ids"] for r in ids.collect()} == {
        1: [260, 258, 32, 262, 119, 101, 114, 256, 260], 2: [], 3: [],
    }
    assert decode(ids, tok.vocab).filter("doc_id = 1").first()["text"] == f"lowest newer{END}low"
    shown = {r["pretoken"]: r["symbols"] for r in segmented_words(counts.count_pretokens(docs, [END]), tok).collect()}
    assert shown[" widest"] == "<20><77><69><64><657374>"


def test_long_training_equals_one_at_a_time(spark):
    table = counts.count_pretokens(spark.read.parquet(f"{SMALL}/benchmark.parquet")).cache()
    found = {r["pretoken"]: r["cnt"] for r in table.collect()}
    trained = train.train_bpe(table, 256 + 250)
    assert learned(trained) == plain.train(found, 250)
    assert trained.rounds < 250


def test_lowering_the_floor_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(train, "PAIRS_KEPT", 3)
    monkeypatch.setattr(train, "ROUNDS_PER_TABLE", 2)
    found = {"abcab": 40, "bcd": 21, "cabd": 13, "dd": 5, "zyx": 2, "xyzzy": 1}
    assert learned(train.train_bpe(table_of(spark, found), 400)) == plain.train(found, 144)


def test_equal_bytes_made_in_two_ways(spark):
    found = {"abc": 10, "xab": 9, "bcx": 12, "ab": 3, "yabcy": 4}
    assert learned(train.train_bpe(table_of(spark, found), 300)) == plain.train(found, 44)


def test_training_stops_when_no_pair_is_left(spark):
    trained = train.train_bpe(table_of(spark, {"ab": 2, "c": 9}), 1000)
    assert learned(trained) == [(b"a", b"b", 2)]
    assert train.train_bpe(table_of(spark, {"c": 9}), 300).merges == []


def test_vocabulary_too_small(spark):
    with pytest.raises(ValueError):
        train.train_bpe(table_of(spark, {"ab": 2}), 256, [END])


def test_resumed_equals_uninterrupted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(train, "ROUNDS_PER_TABLE", 2)
    table = counts.count_pretokens(spark.read.parquet(f"{SMALL}/benchmark.parquet")).cache()
    straight = train.train_bpe(table, 256 + 60)
    state = f"file:{tmp_path}/state"
    train.train_bpe(table, 256 + 25, state_path=state)
    resumed = train.resume_training(spark, state, 256 + 60)
    assert learned(resumed) == learned(straight)


def test_states_are_pruned_and_hold_their_settings(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(train, "ROUNDS_PER_TABLE", 1)
    table = counts.count_pretokens(spark.read.parquet(f"{SMALL}/benchmark.parquet"), [END]).cache()
    state = f"file:{tmp_path}/state"
    whole = train.train_bpe(table, 257 + 20, [END], state_path=state)
    steps = sorted(int(p.name.removeprefix("step=")) for p in (tmp_path / "state").iterdir())
    assert whole.rounds > 2 and len(steps) == 2 and steps[-1] == 20
    with pytest.raises(ValueError, match="special tokens"):
        train.resume_training(spark, state, 256 + 30)
    assert train.resume_training(spark, state, 257 + 20, [END]).merges == whole.merges


def test_low_floors_change_no_merge(spark, monkeypatch):
    monkeypatch.setattr(train, "PAIRS_KEPT", 40)
    table = counts.count_pretokens(spark.read.parquet(f"{SMALL}/benchmark.parquet")).cache()
    found = {r["pretoken"]: r["cnt"] for r in table.collect()}
    assert learned(train.train_bpe(table, 256 + 90)) == plain.train(found, 90)


def test_resume_needs_a_state(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        train.resume_training(spark, f"file:{tmp_path}/none", 300)


def test_vocab_order_and_missing_special_tokens(spark):
    merges = [(b"a", b"b"), (b"ab", b"c")]
    table = vocab.merged_vocab(spark, merges, [END])
    ids = {r["token_id"]: bytes(r["token"]) for r in table.collect()}
    assert ids[0] == b"\0" and ids[255] == b"\xff" and ids[256] == END.encode()
    assert ids[257] == b"ab" and ids[258] == b"abc" and len(ids) == 259
    more = vocab.with_special_tokens(table, [END, "<pad>", "<x>"])
    added = {r["token_id"]: bytes(r["token"]) for r in more.collect() if r["token_id"] > 258}
    assert added == {259: b"<pad>", 260: b"<x>"}
    doubled = table.unionByName(spark.createDataFrame([(900, bytearray(b"ab"), "merge")], vocab.VOCAB_SCHEMA))
    last = {bytes(r["token"]): r["token_id"] for r in vocab.vocab_lookup(doubled).collect()}
    assert last[b"ab"] == 900


def test_verify_reports_each_difference(spark):
    one, two = vocab.merged_vocab(spark, [(b"a", b"b")]), vocab.merged_vocab(spark, [(b"a", b"c")])
    m1, m2 = vocab.merges_table(spark, [(b"a", b"b")]), vocab.merges_table(spark, [(b"a", b"c")])
    assert vocab.verify_tokenizer(one, m1, one, m1).isEmpty()
    found = vocab.verify_tokenizer(one, m1, two, m2).collect()
    assert sorted((r["part"], r["side"]) for r in found) == [
        ("merges", "left"), ("merges", "right"), ("vocab", "left"), ("vocab", "right"),
    ]


@pytest.mark.parametrize("share, rounds, merges", [(0.0, 2, 128), (2.0, 1, 128), (2.0, 8, 7), (0.3, 8, 128)])
def test_index_and_cache_give_the_same_merges(spark, monkeypatch, share, rounds, merges):
    """Always cached, always indexed with new tables often or seldom, and the usual choice."""
    monkeypatch.setattr(train, "INDEXED_SHARE", share)
    monkeypatch.setattr(train, "ROUNDS_PER_TABLE", rounds)
    monkeypatch.setattr(train, "MERGES_PER_TABLE", merges)
    table = counts.count_pretokens(spark.read.parquet(f"{SMALL}/benchmark.parquet")).cache()
    found = {r["pretoken"]: r["cnt"] for r in table.collect()}
    assert learned(train.train_bpe(table, 256 + 120)) == plain.train(found, 120)


@pytest.mark.parametrize("share", [0.0, 2.0])
def test_few_tracked_pairs_and_equal_counts(spark, monkeypatch, share):
    """So few tracked pairs that equal counts are cut by the order of choice, pairs are let go and counted again."""
    monkeypatch.setattr(train, "INDEXED_SHARE", share)
    monkeypatch.setattr(train, "PAIRS_KEPT", 4)
    monkeypatch.setattr(train, "MOST_PAIRS", 6)
    monkeypatch.setattr(train, "MOST_TRACKED", 9)
    found = {a + b + c: 3 for a in "abcd" for b in "abcd" for c in "xy"} | {"aaaa": 5, "abab": 7, "dd": 1}
    assert learned(train.train_bpe(table_of(spark, found), 256 + 60)) == plain.train(found, 60)


def test_index_reads_only_what_is_asked_for(spark, monkeypatch):
    monkeypatch.setattr(train, "INDEXED_SHARE", 2.0)
    table = counts.count_pretokens(spark.read.parquet(f"{SMALL}/documents.parquet"))
    tables = train._Tables(counts.to_byte_symbols(table), Alphabet())
    last = max(tables.ranks, key=tables.ranks.get)
    rows = {r["seq"] for r in tables.touched([last]).collect()}
    assert rows == {r["seq"] for r in tables.words.collect() if last in r["seq"]}
    plan = tables.touched([last])._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" in plan and "rank" in plan.split("InMemoryTableScan")[1].split("InMemoryRelation")[0]
    assert "Exchange" not in plan.split("InMemoryRelation")[0]
    tables.close()


def test_ranges_hold_all_ranks():
    assert train.rank_ranges([5], 3) == [(5, 5)]
    assert train.rank_ranges([1, 2, 9, 10, 50], 3) == [(1, 2), (9, 10), (50, 50)]
    assert train.rank_ranges([1, 2, 9, 10, 50], 2) == [(1, 10), (50, 50)]


def test_saved_words_are_the_base_words(spark, tmp_path, monkeypatch):
    """With a state folder each word table is written once: it is the state."""
    monkeypatch.setattr(train, "ROUNDS_PER_TABLE", 1)
    written = []
    monkeypatch.setattr(train, "settle", lambda frame, name: written.append(name) or real(frame, name))
    table = counts.count_pretokens(spark.read.parquet(f"{SMALL}/benchmark.parquet")).cache()
    train.train_bpe(table, 256 + 40, state_path=f"file:{tmp_path}/state")
    assert written == ["words"]  # the table that training began with
    written.clear()
    resumed = train.resume_training(spark, f"file:{tmp_path}/state", 256 + 60)
    assert written == [] and len(resumed.merges) == 60
