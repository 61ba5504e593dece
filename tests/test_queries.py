"""Every registered query against its SQL on the smallest sample tables, without cross joins."""

import __spark_entry__ as entry
import compare
import pytest

from conftest import SMALL
from pairloom.plans import catalog

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) & set(SQL)))
def test_query_equals_sql(spark, duck, name):
    frame = entry.queries()[name](spark, SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert compare.difference(frame, duck, SQL[name]) is None


def test_long_training_begins_like_the_short_one(spark):
    """The one query without SQL; longer trainings are compared with brute force in test_training."""
    assert set(catalog.QUERIES) - set(SQL) == {"train_bpe_long"}
    rows = {r["rank"]: r for r in catalog.QUERIES["train_bpe_long"](spark, SMALL).collect()}
    assert sorted(rows) == list(range(catalog.MORE_MERGES))
    assert all(rows[r["rank"]] == r for r in catalog.QUERIES["train_bpe"](spark, SMALL).collect())
    assert all(rows[k]["cnt"] >= rows[k + 1]["cnt"] for k in range(len(rows) - 1))


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 4 and all(r["n_tokens"] > 0 for r in rows)
