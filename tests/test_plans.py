"""Plans of the registered queries."""

import __spark_entry__ as entry
import pytest

from conftest import SMALL

def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("name", "columns"),
    [("count_pretokens", "text:string"), ("encode_documents", "doc_id:bigint,text:string"), ("count_tokens", "lang:string")],
)
def test_scans_read_only_what_is_needed(spark, name, columns):
    assert columns in plan_of(entry.queries()[name](spark, SMALL))


def test_pretokens_are_added_up_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["count_pretokens"](spark, SMALL))
    assert "partial_count" in plan and plan.count("hashpartitioning") == 1
