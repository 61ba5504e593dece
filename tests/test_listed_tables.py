from pairloom.operators import vocab

END = "<|endoftext|>"


def test_listed_tables_start_no_workers(spark):
    """A vocabulary from the driver goes by Arrow; other ways keep a second set of Python workers in every executor."""
    merges = [(b"a", b"b"), (b"\xff", b"\x00")]
    tables = [vocab.merges_table(spark, merges), vocab.merged_vocab(spark, merges, [END])]
    assert [tuple(r) for r in tables[0].collect()] == [(0, b"a", b"b"), (1, b"\xff", b"\x00")]
    assert [tuple(r) for r in tables[1].orderBy("token_id").collect()[256:]] == [(256, END.encode(), "special"), (257, b"ab", "merge"), (258, b"\xff\x00", "merge")]
    assert vocab.with_special_tokens(tables[1], [END, "<x>"]).count() == 260
    assert tables[0].schema.simpleString() == "struct<rank:int,l:binary,r:binary>" and vocab.merges_table(spark, []).collect() == []
    for table in tables:
        assert "PythonRDD" not in table._jdf.queryExecution().toRdd().toDebugString()
