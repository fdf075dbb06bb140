"""The registered queries against their SQL, over whole tables."""

import re

import oracle
import pytest

import __spark_entry__ as entry
from lakepipe.llm import queries

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, name):
    frame = queries.queries()[name](spark, SMALL)
    assert oracle.differences(frame, oracle.connect(SMALL), queries.oracle_sql()[name]) == []


def test_one_query_per_operator():
    named = [re.match(r"op(\d+)_", n) for n in queries.queries()]
    assert sorted(int(m[1]) for m in named) == list(range(1, 14))
    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())
    assert set(queries.oracle_sql()) <= set(entry.oracle_sql())
