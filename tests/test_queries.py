"""Every named query against the independent engine, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import oracle
from oracle import SMALL

from lakepipe import oracles, registry

QUERIES, ORACLES = registry.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SMALL)


def test_the_entry_lists_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, duck, name):
    assert oracle.differences(QUERIES[name](spark, SMALL), duck, ORACLES[name]) == []


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[0] == "event_date" and frame.count() == 30


@pytest.mark.parametrize("shuffles,ansi", [(1, "false"), (64, "true")])
@pytest.mark.parametrize("name", ["silver_events", "user_features", "daily_revenue", "metric_auc", "split_summary"])
def test_same_under_other_settings(spark, duck, conf, name, shuffles, ansi):
    conf("spark.sql.shuffle.partitions", str(shuffles))
    conf("spark.sql.ansi.enabled", ansi)
    assert oracle.differences(QUERIES[name](spark, SMALL), duck, ORACLES[name]) == []


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Tokyo"])
@pytest.mark.parametrize("name", ["silver_events", "daily_revenue"])
def test_same_in_other_time_zones(spark, duck, conf, name, zone):
    conf("spark.sql.session.timeZone", zone)
    assert oracle.differences(QUERIES[name](spark, SMALL), duck, ORACLES[name]) == []
