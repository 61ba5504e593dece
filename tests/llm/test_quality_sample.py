"""The scorer's sample does not depend on how rows lie, and copies fill no places."""

import numpy as np
from pairloom.llm import quality


def test_sample_is_of_different_texts(spark):
    rows = [(i, f"the quick fox number {i} ran over the lazy dog and {'went ' * (i % 7)}home .") for i in range(400)]
    copies = [(1000 + i, rows[5][1]) for i in range(800)]
    one = spark.createDataFrame(rows + copies + [(None, None), (None, "")], "doc_id long, text string")
    first = quality.fit(one.repartition(1), sample=150)
    for parts in (3, 7):
        again = quality.fit(one.repartition(parts, "doc_id"), sample=150)
        assert np.array_equal(first.weights, again.weights) and first.bias == again.bias
    few = quality.fit(one, sample=1)
    assert few.weights.shape == first.weights.shape
