"""Files of lines in splits, with and without a last line feed."""

import pytest

from pairloom.operators import encode, vocab
from pairloom.streaming import encode as streaming

CONTENTS = {
    "a.txt": "one\ntwo\r\n\nthree é€\n",
    "b.txt": "no feed at the end",
    "c.txt": "",
    "d.txt": "\n",
    "e.txt": "".join(f"line {i} of a long file\n" for i in range(400)) + "the last without",
    "f.txt": "".join(f"row {i}\n" for i in range(300)),
    "g.txt": "x" * 5000,
    "h.txt": "short\n" + "y" * 4000 + "\n\n",
}


def lines_of(value):
    parts = value.split("\n")
    return [p + "\n" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for name, value in CONTENTS.items():
        (tmp_path / "in" / name).write_bytes(value.encode())
    return tmp_path


@pytest.mark.parametrize("split", [300, 1 << 20])
def test_lines_equal_the_files(spark, folder, split):
    tok = encode.Tokenizer(vocab.base_vocab(spark), vocab.merges_table(spark, []))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        streaming.encode_files(spark, f"file:{folder}/in", tok, f"file:{folder}/out", f"file:{folder}/state").awaitTermination()
        rows = spark.read.parquet(f"file:{folder}/out").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found, starts = {}, {}
    for r in sorted(rows, key=lambda r: (r["block_start"], r["line"])):
        name = r["file_path"].rsplit("/", 1)[1]
        found.setdefault(name, []).append(bytes(r["ids"]).decode())
        starts.setdefault(name, set()).add(r["block_start"])
    assert found == {n: lines_of(v) for n, v in CONTENTS.items() if v}
    assert (len(starts["e.txt"]) > 10) == (split == 300)


def test_new_files_are_added_once(spark, folder):
    tok = encode.Tokenizer(vocab.base_vocab(spark), vocab.merges_table(spark, []))

    def run():
        streaming.encode_files(spark, f"file:{folder}/in", tok, f"file:{folder}/out", f"file:{folder}/state").awaitTermination()
        return spark.read.parquet(f"file:{folder}/out").count()

    n = sum(len(lines_of(v)) for v in CONTENTS.values())
    assert run() == n
    (folder / "in" / "z.txt").write_text("late\nlast")
    assert run() == n + 2 == run()
