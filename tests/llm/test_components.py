import re

import numpy as np

from pairloom.llm import components as stars


def brute(edges):
    least = {}

    def root(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for a, b in edges:
        if None not in (a, b) and a != b:
            low, high = sorted((root(a), root(b)))
            least[high] = low
    return {x: root(x) for x in least}


def test_rounds_have_few_exchanges(spark, monkeypatch):
    """The plan of a round does not hold the round's parts over and over, as the driver keeps all plans; results are those of a plain version."""
    rng = np.random.default_rng(3)
    order = rng.permutation(40) + 1000
    edges = [*map(tuple, rng.integers(-60, 60, (50, 2)).tolist()), *((int(a), int(b)) for a, b in zip(order[:-1], order[1:], strict=True))]
    edges += [(500, 500 + k) for k in range(1, 90)] + [(600 + k, 600) for k in range(1, 9)] + [(7, None), (None, 8), (77, 77), (1, 2), (2, 1)]
    plans, settle = [], stars.settle

    def kept(frame, name):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return settle(frame, name)

    monkeypatch.setattr(stars, "settle", kept)
    got = [tuple(r) for r in stars.components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert dict(got) == brute(edges) and len(got) == len(dict(got))
    assert len(plans) > 2 and max(len(re.findall(r"\bExchange ", p)) for p in plans) <= 10
