"""Recall of the neighbour search on vectors of other and of mixed norms."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from pairloom.llm import neighbours

FOLDER = SMALL.replace("0.001", "0.01")


@pytest.mark.parametrize("norms", [(1.5,), (1.0, 2.0, 4.0), (0.01,)])
def test_recall_does_not_depend_on_norms(spark, norms):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").toPandas().sort_values("vec_id")
    ids = rows["vec_id"].to_numpy()
    x = np.stack(rows["embedding"].to_numpy()).astype(float) * np.array([norms[i % len(norms)] for i in ids])[:, None]
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(frame, 10, F.col("vec_id") % 20 == 0).toPandas()
    hits = []
    for q, group in found.groupby("query_id"):
        apart = np.sqrt(((x - x[np.searchsorted(ids, q)]) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((ids, apart)) if ids[i] != q][:10]
        hits.append(len(set(ids[best]) & set(group["vec_id"])) / 10)
    print(norms, len(hits), np.mean(hits))
    assert len(hits) == (ids % 20 == 0).sum() and np.mean(hits) >= 0.9


def test_each_length_has_its_own_neighbours(spark, monkeypatch):
    """Vectors of every length are queries and candidates; small blocks split the rarer lengths too."""
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=(4, 4, 4, 3, 2)[i % 5])]) for i in range(1000)] + [(1000, [5.0] * 7)]
    found = defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, F.col("vec_id") % 25 < 5).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    hits = []
    for i, v in rows[:1000]:
        if i % 25 < 5:
            best = sorted((float(np.linalg.norm(np.subtract(v, w))), j) for j, w in rows if j != i and len(w) == len(v))[:5]
            hits.append(len({j for _, j in best} & set(found[i])) / 5)
            assert len(v) == 4 or found[i] == [j for _, j in best]
    assert np.mean(hits) >= 0.9 and 1000 not in found
