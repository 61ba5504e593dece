import numpy as np
from pyspark.sql import functions as F

from pairloom.functions import patterns
from pairloom.operators import counts

END = "<|endoftext|>"


def test_counts_of_slices_are_those_of_the_expression(spark, monkeypatch):
    """Texts are cut and counted in slices, so Spark adds up distinct pieces of slices and not every piece."""
    odd = ["", None, " ", "don't  stop\t\n", f"a{END}b{END}{END} c", f"{END}", "é😀 漢字 ١٢ x y", "w " * 3000, "<|endof", "  a\r\n"]
    rng = np.random.default_rng(1)
    odd += [" ".join(map(str, rng.integers(0, 50, int(n)))) for n in rng.integers(0, 80, 200)]
    docs = spark.createDataFrame([(t,) for t in odd], "text string").unionByName(spark.range(1).select(F.unhex(F.lit("61FF62C3")).cast("string").alias("text")))
    plain = docs.select(F.explode(patterns.pieces(F.col("text"), [END], keep_special=False)).alias("pretoken")).groupBy("pretoken").count()
    want = {tuple(r) for r in plain.collect()}
    found = counts.count_pretokens(docs, [END])
    assert {tuple(r) for r in found.collect()} == want and len(want) > 60
    assert dict(counts.count_pretokens(docs, [END], r"\S+").collect())["stop"] == 1
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    assert counts.count_pretokens(docs.limit(0), [END]).collect() == []
