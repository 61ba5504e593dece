import pytest

from pairloom.operators import decode


def test_decoding_takes_one_step_a_token(spark):
    vocab = spark.createDataFrame([(0, b"a"), (1, b"\xc3"), (2, b"\xa9"), (5, b"")], "token_id int, token binary")
    rows = [([0, 1, 2],), ([1],), ([],), (None,), ([0, 5, 0],)]
    frame = spark.createDataFrame(rows, "ids array<int>")
    back = decode.decode(frame, vocab)
    assert sorted(map(str, (r["text"] for r in back.collect()))) == sorted(["aé", "�", "", "None", "aa"])
    plan = back._jdf.queryExecution().analyzed().toString()
    assert plan.count("lambdafunction(") == 1
    for bad in ([3], [9], [0, -1], [0, None], [0, 3, 0]):
        unknown = spark.createDataFrame([(bad,)], "ids array<int>")
        assert decode.decode(unknown, vocab, on_unknown="null").first()["text"] is None
        with pytest.raises(Exception, match="id without a token"):
            decode.decode(unknown, vocab).collect()
