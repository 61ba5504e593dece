import pytest
from pyspark.sql import functions as F

from pairloom.operators import running, stream, windows
from pairloom.sources import artifacts


@pytest.fixture(scope="module")
def encoded(spark):
    return (
        spark.range(300)
        .select(
            (F.col("id") * 7 % 300).alias("doc_id"),
            F.when(F.col("id") % 11 == 0, F.array().cast("array<int>"))
            .otherwise(F.transform(F.sequence(F.lit(1), F.col("id") % 97 + 1), lambda i: (i * 31 % 289).cast("int")))
            .alias("ids"),
        )
        .unionByName(
            spark.range(1).select(F.lit(1000).cast("long").alias("doc_id"), F.transform(F.sequence(F.lit(0), F.lit(9999)), lambda i: (i % 289).cast("int")).alias("ids"))
        )
        .cache()
    )


@pytest.fixture(scope="module")
def flat(encoded):
    return [i for r in encoded.orderBy("doc_id").collect() for i in r["ids"]]


@pytest.mark.parametrize("block_size", [1, 64, 4096, 10**6])
def test_blocks_hold_the_stream(encoded, flat, block_size):
    if block_size == 1:
        encoded = encoded.filter("doc_id < 20")
        flat = [i for r in encoded.orderBy("doc_id").collect() for i in r["ids"]]
    rows = stream.flatten_token_stream(encoded, block_size=block_size).orderBy("block_id").collect()
    assert [i for r in rows for i in r["ids"]] == flat
    assert [r["start_pos"] for r in rows] == list(range(0, len(flat), block_size))
    assert all(r["n_ids"] == block_size for r in rows[:-1])


def test_positions_follow_the_order_columns(spark):
    rows = [(2, 0, [1]), (1, 1, [2, 3]), (1, 0, [4, 5, 6]), (3, 0, [])]
    frame = spark.createDataFrame(rows, "doc_id long, line_no int, ids array<int>")
    at = stream.document_positions(frame, ("doc_id", "line_no")).collect()
    assert {(r["doc_id"], r["line_no"]): r["start_pos"] for r in at} == {(1, 0): 0, (1, 1): 3, (2, 0): 5, (3, 0): 6}


def test_running_total_of_one_hot_group(spark):
    """A group that fills most of the table spreads over tasks and still adds up."""
    frame = spark.range(5000).select(
        F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 10).alias("g"),
        (F.col("id") * 37 % 5003).alias("o"),
        (F.col("id") % 13).alias("v"),
    )
    got = running.running_total(frame, "v", [F.col("o")], ["g"]).collect()
    sums: dict = {}
    for row in sorted(got, key=lambda r: (r["g"], r["o"])):
        assert row["before"] == sums.get(row["g"], 0)
        sums[row["g"]] = sums.get(row["g"], 0) + row["v"]
    assert len(got) == 5000


def test_sampled_windows(encoded, flat):
    blocks = stream.flatten_token_stream(encoded, block_size=100).cache()
    drawn = windows.sample_windows(blocks, 400, 32, seed=9, block_size=100)
    rows = drawn.collect()
    assert sorted(r["sample_id"] for r in rows) == list(range(400))
    for r in rows:
        s = r["start_pos"]
        assert 0 <= s < len(flat) - 32
        assert r["x"] == flat[s : s + 32] and r["y"] == flat[s + 1 : s + 33]
    again = windows.sample_windows(blocks.repartition(5), 400, 32, seed=9, block_size=100)
    assert drawn.exceptAll(again).isEmpty()
    other = windows.sample_starts(blocks, 400, 32, seed=10)
    assert other.join(drawn, ["sample_id", "start_pos"]).count() < 40
    mean = sum(r["start_pos"] for r in rows) / len(rows)
    assert abs(mean / len(flat) - 0.5) < 0.06


def test_windows_at_the_ends(spark, encoded, flat):
    blocks = stream.flatten_token_stream(encoded, block_size=100)
    n = len(flat)
    starts = spark.createDataFrame([(0, 0), (1, n - 33), (2, n - 32), (3, -1), (4, 0)], "sample_id long, start_pos long")
    got = {r["sample_id"]: r for r in windows.windows_at(blocks, starts, 32, 100, on_short="null").collect()}
    assert set(got) == {0, 1, 2, 3, 4} and got[2]["x"] is got[3]["y"] is None
    with pytest.raises(Exception, match="outside the stream"):
        windows.windows_at(blocks, starts, 32, 100).collect()
    assert got[1]["y"] == flat[-32:] and got[0]["x"] == got[4]["x"] == flat[:32]


def test_stream_not_longer_than_the_context(spark):
    frame = spark.createDataFrame([(1, [1, 2, 3])], "doc_id long, ids array<int>")
    blocks = stream.flatten_token_stream(frame, block_size=2)
    with pytest.raises(ValueError):
        windows.sample_windows(blocks, 4, 3, block_size=2)
    (row,) = windows.sample_windows(blocks, 1, 2, block_size=2).collect()
    assert (row["x"], row["y"]) == ([1, 2], [2, 3])


def test_stream_file_checks_the_id_range(spark, encoded, tmp_path):
    blocks = stream.flatten_token_stream(encoded, block_size=100)
    path = f"file:{tmp_path}/stream"
    artifacts.write_token_stream(blocks, path, max_id=288)
    train, valid = artifacts.load_split(spark, path, path)
    assert train.drop("bucket").exceptAll(blocks).isEmpty() and valid.count() == blocks.count()
    with pytest.raises(Exception, match="outside"):
        artifacts.write_token_stream(blocks, f"file:{tmp_path}/bad", max_id=100)
